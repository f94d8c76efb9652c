"""High-water marks, latest batches and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.columns import named
from acreage.session import fresh_path, remove_folder


def high_water_mark(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the largest value of each column, 0 where there is none."""
    return df.agg(*[F.coalesce(F.max(named(c)), F.lit(0)).cast("bigint").alias(c) for c in columns])


def marks(df: DataFrame, *columns: str) -> tuple[int, ...]:
    """The high-water marks as numbers; what a load needs before it can number its rows."""
    return tuple(high_water_mark(df, columns).first())


def latest_batch(df: DataFrame, column: str = "etl_nr") -> DataFrame:
    """Rows of the newest batch. The mark is a scalar subquery, so no row is joined or shuffled."""
    newest = df.agg(F.max(named(column))).scalar()
    return df.where(named(column) == newest)


def dense_surrogate_key(
    df: DataFrame, name: str, base: int, order: Sequence[str] | None = None
) -> DataFrame:
    """The rows of ``number``, for callers that keep its intermediate copy."""
    return number(df, name, base, order).rows


@dataclass
class Numbered:
    """Rows with their keys, the largest key given, and the copy the rows are read from."""

    rows: DataFrame
    top: int
    path: str

    def discard(self) -> None:
        """Remove the copy, once the rows have been written where they belong."""
        remove_folder(self.rows.sparkSession, self.path)


def number(df: DataFrame, name: str, base: int, order: Sequence[str] | None = None) -> Numbered:
    """Number rows ``base+1 … base+n``, in ``order`` if given, else as they happen to be stored.

    Rows are written once; a row's place in its file plus the sizes of the files before it is
    its number, so no window sees all rows and nothing depends on how often a task ran. With
    an ``order``, which must be a total order, rows are range-partitioned and sorted before.
    """
    placed, path = _in_files(df, order or ())
    offsets, top = _offsets(placed, F.max("_row") + 1, base)
    rows = placed.join(offsets, "_file").withColumn(name, F.col("_start") + F.col("_row") + 1)
    return Numbered(rows.drop("_file", "_row", "_start"), top, path)


def sums_before(df: DataFrame, amount: str, name: str, order: Sequence[str]) -> DataFrame:
    """Each row with the sum of ``amount`` over all rows before it in ``order``, found as numbers
    are: from the sums of the files before its own, and the rows before it in that."""
    return number_runs(df, amount, name, 0, order).rows


def number_runs(df: DataFrame, amount: str, name: str, base: int, order: Sequence[str] = ()) -> Numbered:
    """Rows that stand for ``amount`` numbers each, with the number before their first; see ``number``."""
    placed, path = _in_files(df, order)
    offsets, top = _offsets(placed, F.sum(named(amount)), base)
    earlier = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_within", F.coalesce(F.sum(named(amount)).over(earlier), F.lit(0)))
    rows = within.join(offsets, "_file").withColumn(name, F.col("_start") + F.col("_within"))
    return Numbered(rows.drop("_file", "_row", "_start", "_within"), top, path)


def _in_files(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, str]:
    """The rows, written in order, with ``_file`` and their ``_row`` in it; and where they lie."""
    path = fresh_path(df.sparkSession, "dense-key")
    by = [named(c) for c in order]
    (df.repartitionByRange(*by).sortWithinPartitions(*by) if by else df).write.option("compression", "zstd").parquet(path)
    placed = (
        df.sparkSession.read.schema(df.schema)
        .parquet(path)
        .select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    )
    return placed, path


def _offsets(placed: DataFrame, size: Column, base: int) -> tuple[DataFrame, int]:
    """Where each file's rows start, and where the last one's end."""
    # One row per written file; names start with the number of the range.
    sizes = placed.groupBy("_file").agg(size.alias("n")).collect()
    sizes.sort(key=lambda row: (int(row["_file"].split("-")[1]), row["_file"]))
    starts = accumulate((row["n"] for row in sizes), initial=base)
    offsets = [(row["_file"], start) for row, start in zip(sizes, starts)]
    start_of = placed.sparkSession.createDataFrame(offsets, "_file string, _start bigint")
    # As many rows as files, a hundred thousand of which stay far below a broadcast's limits.
    if len(offsets) <= 100_000:
        start_of = F.broadcast(start_of)
    return start_of, base + sum(row["n"] for row in sizes)
