"""Changes of a table over many commits, and what they come to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.columns import all_present, named

KIND, VERSION, TIME = "_change_type", "_commit_version", "_commit_timestamp"
# Changes that show a row as it was, and as it is from then on.
BEFORE, AFTER = ("update_preimage", "delete"), ("insert", "update_postimage")


def net_changes(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a feed of several commits changes from before its first commit to after its last.

    Per key at most one insert, one delete, or one pair of pre- and postimage is left, with the
    version and time of the key's last commit: an insert that is updated is an insert of what it
    was updated to, an insert that is deleted is nothing, a delete and a later insert are an
    update if the row is another one and else nothing. Inside a commit a row goes before one
    comes.

    Only a key's first and last change count. They are found by an aggregate that is combined
    before the shuffle, so a key that changes in every commit is no more than a row per task. A
    key whose changes do not add up, such as one inserted twice, fails the job. Rows whose key
    has a NULL cannot be paired: each of their changes stays as it is.
    """
    keys, columns = list(keys), [c for c in feed.columns if c not in (KIND, VERSION, TIME)]
    whole = all_present(keys)
    comes = F.col(KIND).isin(*AFTER)
    order = F.struct(F.col(VERSION).alias("version"), comes.alias("comes"))
    row = F.struct(*[named(c) for c in columns])
    # What the first change shows was there before if that change takes it away.
    ends = feed.where(whole).groupBy(*[named(k) for k in keys]).agg(
        F.min(order).alias("_first"),
        F.max(order).alias("_last"),
        F.min_by(row, order).alias("_before"),
        F.max_by(row, order).alias("_after"),
        F.max_by(TIME, order).alias(TIME),
        F.sum(F.when(comes, 1).otherwise(-1)).alias("_more"),
    )
    was, is_ = ~F.col("_first.comes"), F.col("_last.comes")
    clash = F.raise_error(F.concat(F.lit("changes that do not add up: "), F.to_json(F.struct(*[named(k) for k in keys]))))
    adds_up = F.col("_more") == is_.cast("int") - was.cast("int")
    ends = ends.where(F.when(adds_up, F.lit(True)).otherwise(clash.cast("boolean")))

    def change(kind: str, row: str):
        return F.struct(F.col(row).alias("row"), F.lit(kind).alias("kind"))

    net = (
        F.when(~was & is_, F.array(change("insert", "_after")))
        .when(was & ~is_, F.array(change("delete", "_before")))
        .when(
            was & is_ & ~F.col("_before").eqNullSafe(F.col("_after")),
            F.array(change("update_preimage", "_before"), change("update_postimage", "_after")),
        )
    )
    folded = ends.select(F.explode(net).alias("_change"), F.col("_last.version").alias(VERSION), TIME).select(
        *[F.col(f"_change.row.`{c}`").alias(c) for c in columns], F.col("_change.kind").alias(KIND), VERSION, TIME
    )
    return folded.unionByName(feed.where(~whole).select(*[named(c) for c in columns], KIND, VERSION, TIME))
