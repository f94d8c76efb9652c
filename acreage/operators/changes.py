"""Inserts, updates and differences between two states of a table, as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.columns import all_present, named, row_hash
from acreage.sources.writers import stored

def zero(keys: Sequence[str]) -> Column:
    """0 for every row, which the optimizer does not know: a literal would be taken out of the
    join keys."""
    return F.pmod(F.hash(*[named(k) for k in keys]), F.lit(1)).cast("bigint")


def spread_null_keys(df: DataFrame, keys: Sequence[str], name: str = "_spread") -> DataFrame:
    """Add a join key that is 0 for whole keys and scatters the rows whose key has a NULL."""
    return df.withColumn(name, F.when(all_present(keys), zero(keys)).otherwise(row_hash(df).cast("bigint")))


def lookup_join(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a side that holds each whole key at most once.

    The extra key is computed after ``right`` has been reduced, so ``right`` is shuffled for the
    join itself. Adaptive execution splits a key that fills much of ``df`` only if both sides
    come straight from a shuffle; moving the reduced side once more is the price of that.
    """
    right = right.where(all_present(keys)).withColumn("_spread", zero(keys))
    return spread_null_keys(df, keys).join(right, [*keys, "_spread"], how).drop("_spread")


def require_unique(df: DataFrame, keys: Sequence[str], what: str, by: Sequence[str] | None = None) -> DataFrame:
    """Pass rows through, failing the job at the first repeated key.

    The window leaves rows partitioned and sorted by ``by``, which a join on the same columns
    uses as it is.
    """
    by = list(by or keys)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*by))
    clash = F.raise_error(F.concat(F.lit(f"{what}: repeated key "), F.to_json(F.struct(*keys)))).cast("boolean")
    return (
        df.withColumn("_place", place)
        .where(F.when((F.col("_place") == 1) | ~all_present(keys), F.lit(True)).otherwise(clash))
        .drop("_place")
    )


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per whole key, and every row whose key has a NULL.

    The row that comes first by ``order`` and then by its other columns stays, so the choice does
    not depend on where rows happen to be. It is made before the shuffle, like any minimum.
    """
    whole, keys = all_present(keys), list(keys)
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    if not rest:
        return df.where(whole).dropDuplicates(keys).unionByName(df.where(~whole))
    first = F.min(F.struct(*[named(c) for c in rest])).alias("_first")
    chosen = df.where(whole).groupBy(*[named(k) for k in keys]).agg(first)
    chosen = chosen.select(*[named(k) for k in keys], *[F.col(f"_first.`{c}`").alias(c) for c in rest])
    return chosen.select(*[named(c) for c in df.columns]).unionByName(df.where(~whole))


def insert_new(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], *, dedupe_batch: bool = False
) -> DataFrame:
    """Batch rows whose key the target does not hold.

    A key with a NULL counts as unseen. Copies inside the batch are kept unless
    ``dedupe_batch``.
    """
    keys = list(keys)
    if dedupe_batch:
        batch = one_per_key(batch, keys)
    # Only keys of the batch matter: a small batch is sent to the target, whose rows then stay where
    # they are. Distinct keys after that: one the target holds a million times is sent once per task.
    seen = target.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi").distinct()
    return lookup_join(batch, seen, keys, "left_anti").select(*batch.columns)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two states, tagged with ``_change_type``.

    Keys must be unique in each state. Rows are compared NULL-safely; a row whose own key has
    a NULL cannot be paired and shows as a delete and an insert.
    """
    keys, columns = list(keys), old.columns
    new = new.select(*columns)
    by = [*keys, "_spread"]

    def side(df: DataFrame, name: str) -> DataFrame:
        df = require_unique(spread_null_keys(df, keys), keys, f"{name} state", by)
        return df.select(*by, F.struct(*columns).alias(f"_{name}"))

    before, after = F.col("_old"), F.col("_new")

    def tagged(kind: str, row: Column) -> Column:
        return F.struct(row.alias("row"), F.lit(kind).alias("kind"))

    changes = (
        F.when(before.isNull(), F.array(tagged("insert", after)))
        .when(after.isNull(), F.array(tagged("delete", before)))
        .when(
            ~before.eqNullSafe(after),
            F.array(tagged("update_preimage", before), tagged("update_postimage", after)),
        )
    )
    return (
        side(old, "old")
        .join(side(new, "new"), by, "full_outer")
        .select(F.explode(changes).alias("_change"))
        .select("_change.row.*", F.col("_change.kind").alias("_change_type"))
    )


def arrivals(feed: DataFrame) -> DataFrame:
    """The rows of a change feed that hold new content."""
    return feed.where(F.col("_change_type").isin("insert", "update_postimage"))


def deleted_for_good(feed: DataFrame) -> DataFrame:
    """Distinct rows a feed deletes without inserting the same row again."""
    rows = feed.drop("_change_type")
    return rows.where(feed["_change_type"] == "delete").subtract(
        rows.where(feed["_change_type"] == "insert")
    )


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Matched target rows take ``update`` from the source; unmatched source rows are added.

    A target may hold a key many times, a source only once. The target is the split side of
    the join, so a key that fills much of it is no single task's work, and a small source is
    broadcast by the planner without moving the target at all. The source is stored once it has
    been checked, which runs it: a repeated key fails here.
    """
    keys, columns = list(keys), target.columns
    update = list(update) if update is not None else [c for c in columns if c not in keys]
    # Rows with a NULL key match nothing and are scattered before the check, which is made once.
    source = require_unique(spread_null_keys(source, keys), keys, "source", [*keys, "_spread"]).drop("_spread")
    source = stored(source)
    fresh = source.select(*keys, F.struct(*update).alias("_fresh"))
    joined = lookup_join(target, fresh, keys, "left")
    kept = joined.select(
        *[
            F.when(F.col("_fresh").isNotNull(), F.col(f"_fresh.{c}")).otherwise(F.col(c)).alias(c)
            if c in update
            else F.col(c)
            for c in columns
        ]
    )
    added = insert_new(source, target, keys)
    return kept.unionByName(added, allowMissingColumns=True).select(*columns)
