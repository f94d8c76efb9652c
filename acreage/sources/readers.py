from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.schemas import PARCEL_RESPONSE, SALES_FEED
from acreage.sources.writers import stored


def read_sales_csv(spark: SparkSession, folder: str, schema: T.StructType = SALES_FEED) -> DataFrame:
    """All files of a landing folder; a cell that does not fit its type becomes NULL.

    A file whose header names are not those of the layout, in its order, fails the read.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(folder)


CORRUPT = "_corrupt_record"


def read_sales_csv_checked(
    spark: SparkSession, folder: str, schema: T.StructType = SALES_FEED
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_sales_csv``, and a row for each cell of them that became NULL because it
    does not fit its type.

    Lost cells have ``column_name``, ``kind`` (the type that was wanted), ``cell`` (the text that
    stands there), ``record`` (the whole line), ``file_name`` and ``row`` (what could be read). A
    line with too few or too many cells, none of which is lost by itself, is one row without a
    column. Only lines the reader could not take as they are, which it marks, are read once more as
    text; empty cells are NULL and not lost. Cells hold no line feeds, as for ``read_sales_csv``.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(marked).option("header", True).option("enforceSchema", False)
    lines = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(folder)
    rows = lines.drop(CORRUPT)
    names = [f.name for f in schema]
    quoted = lambda n: f"`{n}`"
    texts = F.from_csv(CORRUPT, ", ".join(f"{quoted(n)} string" for n in names))
    bad = lines.where(F.col(CORRUPT).isNotNull()).select(
        CORRUPT, F.struct(*[F.col(quoted(n)) for n in names]).alias("row"), F.col("_metadata.file_name").alias("file_name"), texts.alias("texts")
    )

    def lost(field: T.StructField) -> Column:
        text = F.col(f"texts.{quoted(field.name)}")
        cell = F.struct(F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("kind"), text.alias("cell"))
        return F.when(text.isNotNull() & (text != "") & F.col(f"row.{quoted(field.name)}").isNull(), cell)

    cells = F.array_compact(F.array(*[lost(f) for f in schema if not isinstance(f.dataType, T.StringType)]))
    kind = "struct<column_name: string, kind: string, cell: string>"
    # A line whose cells all fit has the wrong number of them.
    cells = F.when(F.size(cells) > 0, cells).otherwise(F.array(F.lit(None).cast(kind)))
    each = bad.select(F.explode(cells).alias("lost"), F.col(CORRUPT).alias("record"), "file_name", "row")
    return rows, each.select("lost.column_name", "lost.kind", "lost.cell", "record", "file_name", "row")


def read_csv_inferred(
    spark: SparkSession,
    path: str,
    header: bool = True,
    infer_schema: bool = True,
    delimiter: str = ",",
    sample: float = 1.0,
) -> DataFrame:
    """A CSV file of unknown layout. Inference reads it once more; ``sample`` limits that."""
    return (
        spark.read.option("header", header)
        .option("inferSchema", infer_schema)
        .option("samplingRatio", sample)
        .option("delimiter", delimiter)
        .csv(path)
    )


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None
) -> DataFrame:
    """One row per ``row_tag`` element. A given schema saves the pass that infers one."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).load(path)


XSD_TYPES = {"bigint": "long", "int": "int", "double": "double", "string": "string", "boolean": "boolean", "date": "date"}


def xsd_of(row_tag: str, layout: T.StructType) -> str:
    """A schema file for elements of a layout: fields in its order, each of which may be missing."""

    def element(name: str, kind: T.DataType, many: str = "") -> str:
        if isinstance(kind, T.ArrayType):
            return element(name, kind.elementType, ' maxOccurs="unbounded"')
        if isinstance(kind, T.StructType):
            inner = "".join(element(f.name, f.dataType) for f in kind)
            return f'<xs:element name="{name}" minOccurs="0"{many}><xs:complexType><xs:sequence>{inner}</xs:sequence></xs:complexType></xs:element>'
        return f'<xs:element name="{name}" type="xs:{XSD_TYPES[kind.simpleString()]}" minOccurs="0"{many}/>'

    # The row's own element is the document: it is there once.
    root = element(row_tag, layout).replace(' minOccurs="0"', "", 1)
    return f'<?xml version="1.0" encoding="UTF-8"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{root}</xs:schema>'


def read_xml_validated(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType, xsd: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of elements that the schema file ``xsd`` allows, and ``record``, the whole text of
    each that it does not: with elements it does not name, in another order, or with values of another
    type. ``xsd`` is a path that every executor can open. Elements are parsed and checked once, when
    this is called, and both frames read what was stored then.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("rowValidationXSDPath", xsd)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(marked)
        .load(path)
    )
    rows, bad = stored(rows), F.col(CORRUPT).isNotNull()
    return rows.where(~bad).drop(CORRUPT), rows.where(bad).select(F.col(CORRUPT).alias("record"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_event_json(spark: SparkSession, folder: str) -> DataFrame:
    """Landed property responses, one JSON object per line."""
    return spark.read.schema(PARCEL_RESPONSE).json(folder)
