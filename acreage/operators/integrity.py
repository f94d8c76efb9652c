"""Whether a landed file and the table made from it agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.sources.readers import read_csv_inferred, read_xml

ROW_COUNT = "match_row_count_with_xml_csv_table"
SCHEMA = "match_schema_between_existing_table_and_file"


def same_layout(a: T.StructType, b: T.StructType) -> bool:
    """Equal names and types in order; whether a column may be NULL does not matter."""
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def compare_row_counts(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One result row: whether all frames have equally many rows."""
    counts = {name: df.agg(F.count("*")).scalar() for name, df in frames.items()}
    counted = spark.range(1).select(*[c.alias(name) for name, c in counts.items()])
    values = [F.col(name) for name in counts]
    same = F.least(*values) == F.greatest(*values)
    detail = F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in counts])
    return counted.select(F.lit(ROW_COUNT).alias("rule"), same.alias("passed"), detail.alias("detail"))


def check_integrity(
    spark: SparkSession,
    csv_path: str,
    table: str,
    rules: Sequence[str],
    *,
    file_schema: T.StructType | None = None,
    table_exists: bool = True,
    xml_path: str | None = None,
    row_tag: str | None = None,
    raise_on_failure: bool = False,
) -> DataFrame:
    """One row (rule, passed, detail) per rule; a missing table makes no schema row."""
    results = []
    for rule in rules:
        if rule == ROW_COUNT:
            frames = {
                "csv_rows": read_csv_inferred(spark, csv_path, infer_schema=False),
                "table_rows": spark.table(table),
            }
            if xml_path and row_tag:
                frames["xml_rows"] = read_xml(spark, xml_path, row_tag)
            results.append(compare_row_counts(spark, frames))
        elif rule == SCHEMA:
            if file_schema is None:
                raise ValueError("a schema rule needs file_schema")
            if table_exists:
                same = same_layout(spark.table(table).schema, file_schema)
                detail = "same columns" if same else "columns differ"
                results.append(spark.createDataFrame([(rule, same, detail)], "rule string, passed boolean, detail string"))
        else:
            raise ValueError(f"unknown integrity rule: {rule!r}" if rule else "no integrity rule given")
    if not results:
        return spark.createDataFrame([], "rule string, passed boolean, detail string")
    outcome = results[0]
    for more in results[1:]:
        outcome = outcome.unionByName(more)
    if raise_on_failure:
        failed = [row["rule"] for row in outcome.where(~F.col("passed")).collect()]
        if failed:
            raise ValueError(f"integrity check failed: {', '.join(failed)}")
    return outcome
