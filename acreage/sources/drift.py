"""What landed JSON holds beside its layout, or in another type than the layout's."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def family(kind: T.DataType) -> str:
    """What JSON writes a type as."""
    if isinstance(kind, NUMBERS):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.ArrayType):
        return "array"
    return "object" if isinstance(kind, (T.StructType, T.MapType)) else "string"


def family_of(value: Column) -> Column:
    """The same of a variant value."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.isin("VOID"), "null")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "STRING", "string")
        .otherwise("number")
    )


def read_variants(spark: SparkSession, folder: str) -> DataFrame:
    """``v``, each line of landed JSON as a variant, NULL if it is none; and the ``line``."""
    return spark.read.text(folder).select(F.try_parse_json("value").alias("v"), F.col("value").alias("line"))


def json_drift(spark: SparkSession, folder: str, layout: T.StructType) -> DataFrame:
    """Fields outside the layout and values of another kind than it says, a row per ``path`` and
    ``found`` kind: ``wanted`` (NULL outside the layout), ``n_values`` and an ``example`` as JSON.

    A path names nested fields by dots and elements of arrays by ``[]``. Kinds are those of JSON:
    string, number, boolean, object, array. NULL values drift nowhere. Lines that are no JSON are
    counted under path ``(line)`` and kind ``unreadable``. Lines are read once, counts are combined before
    the shuffle, and the result is as long as there are odd fields, whatever was landed.
    """
    lines = read_variants(spark, folder)
    found = [_walked(spark, lines.where(F.col("v").isNotNull()).select("v"), layout, "")]
    unread = lines.where(F.col("v").isNull() & (F.trim("line") != "")).select(
        F.lit("(line)").alias("path"), F.lit(None).cast("string").alias("wanted"), F.lit("unreadable").alias("found"), F.col("line").alias("example")
    )
    every = reduce(DataFrame.unionByName, [*found, unread])
    return every.groupBy("path", "wanted", "found").agg(F.count("*").alias("n_values"), F.min("example").alias("example"))


def _walked(spark: SparkSession, values: DataFrame, layout: T.StructType, prefix: str) -> DataFrame:
    """The odd fields of objects in ``v``, and of what lies in them."""
    fields = values.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("key", F.col("value").alias("v")).where("key IS NOT NULL")
    kinds = {f.name: f.dataType for f in layout}
    wanted = F.lit(None).cast("string")
    for name, kind in kinds.items():
        wanted = F.when(F.col("key") == name, family(kind)).otherwise(wanted)
    odd = fields.withColumns({"wanted": wanted, "found": family_of(F.col("v"))})
    odd = odd.where((F.col("found") != "null") & ~F.col("found").eqNullSafe(F.col("wanted")))
    parts = [odd.select(F.concat(F.lit(prefix), "key").alias("path"), "wanted", "found", F.to_json("v").alias("example"))]
    for name, kind in kinds.items():
        inside = fields.where((F.col("key") == name)).select("v")
        if isinstance(kind, T.StructType):
            parts.append(_walked(spark, inside.where(family_of(F.col("v")) == "object"), kind, f"{prefix}{name}."))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            elements = inside.where(family_of(F.col("v")) == "array").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
            parts.append(_walked(spark, elements.select(F.col("value").alias("v")), kind.elementType, f"{prefix}{name}[]."))
    return reduce(DataFrame.unionByName, parts)
