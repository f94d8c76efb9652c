"""From raw feed rows to typed, complete and audited domain rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.columns import all_present, named


def conform(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rename and cast in one projection; a cell that does not cast becomes NULL.

    ``mapping`` gives ``source: (target, type)``. Source columns it does not list are dropped.
    """
    return df.select(
        *[named(source).try_cast(kind).alias(target) for source, (target, kind) in mapping.items()]
    )


def with_audit(df: DataFrame, as_of: date, batch: int | Column) -> DataFrame:
    """Load columns taken from the arguments, so a repeated run gives the same rows."""
    moment = F.lit(as_of).cast("timestamp")
    batch = batch if isinstance(batch, Column) else F.lit(batch)
    return df.withColumns(
        {
            "load_date_dt": F.lit(as_of),
            "etl_nr": batch.cast("bigint"),
            "etl_recorded_gmts": moment,
            "record_inserted_ts": moment,
        }
    )


def split_good_bad(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column, and the distinct rest."""
    complete = all_present(required)
    return df.where(complete), df.where(~complete).distinct()


def distinct_addresses(df: DataFrame) -> DataFrame:
    return df.select(
        "prop_address_line_txt", "prop_city_nm", "prop_state_nm", "prop_zip_cd"
    ).distinct()


def trailing_months(
    df: DataFrame, as_of: date, months: int = 12, column: str = "prop_last_sale_dt", year: str | None = None
) -> DataFrame:
    """Rows of the last ``months`` months, both ends included.

    ``year`` names the column that holds the date's year, if the table is partitioned by it: then
    folders of other years are not read.
    """
    end = F.lit(as_of)
    start = F.add_months(end, -months)
    kept = df.where(F.col(column).between(start, end))
    return kept if year is None else kept.where(F.col(year).between(F.year(start), F.year(end)))


def row_counts(df: DataFrame) -> DataFrame:
    """One row: all rows and distinct rows, from a single aggregation."""
    return (
        df.groupBy(*[named(c) for c in df.columns])
        .agg(F.count("*").alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
            F.count("*").alias("n_distinct_rows"),
        )
    )
