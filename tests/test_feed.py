"""Feeds of many commits and snapshots in any order, against plain Python."""

import itertools
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from util import rows

from acreage.operators.changes import change_feed
from acreage.operators.feed import KIND, TIME, VERSION, net_changes
from acreage.operators.history import scd2_merge, scd2_splice
from acreage.sources.changelog import ChangeLog
from acreage.sources.writers import Lake

KV = "k int, v string"


def states(seed, n=8):
    rnd = random.Random(seed)
    return [{k: rnd.choice(["a", "b", None]) for k in range(7) if rnd.random() < 0.6} for _ in range(n)]


def frame(spark, state):
    return spark.createDataFrame(list(state.items()), KV)


def feed_of(spark, many):
    feed = None
    for version, (old, new) in enumerate(itertools.pairwise([{}, *many])):
        part = change_feed(frame(spark, old), frame(spark, new), ["k"])
        part = part.withColumn(VERSION, F.lit(version).cast("long")).withColumn(TIME, F.lit(datetime(2020, 1, 1) + timedelta(days=version)))
        feed = part if feed is None else feed.unionByName(part)
    return feed


def difference(old, new):
    out = {}
    for k in old.keys() | new.keys():
        if k not in old:
            out[k, new[k], "insert"] = 1
        elif k not in new:
            out[k, old[k], "delete"] = 1
        elif old[k] != new[k]:
            out[k, old[k], "update_preimage"] = out[k, new[k], "update_postimage"] = 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_net_changes_are_the_difference_of_the_ends(spark, seed):
    many = states(seed)
    feed = feed_of(spark, many)
    for first, last in ((0, 7), (2, 5), (3, 3)):
        net = net_changes(feed.where(F.col(VERSION).between(first, last)), ["k"])
        assert net.columns == feed.columns
        assert rows(net, "k", "v", KIND) == difference(many[first - 1] if first else {}, many[last])


def change(spark, *values):
    return spark.createDataFrame(
        [(k, v, kind, n, datetime(2020, 1, 1 + n)) for k, v, kind, n in values], f"{KV}, {KIND} string, {VERSION} long, {TIME} timestamp"
    )


def test_net_changes_of_each_kind(spark):
    feed = change(
        spark,
        (1, "a", "insert", 0), (1, "a", "update_preimage", 1), (1, "b", "update_postimage", 1),
        (2, "a", "insert", 0), (2, "a", "delete", 2),
        (3, "a", "delete", 0), (3, "c", "insert", 0),
        (4, "a", "delete", 0), (4, "a", "insert", 3),
        (5, None, "update_preimage", 1), (5, "x", "update_postimage", 1), (5, "x", "delete", 2),
        (None, "n", "insert", 0), (None, "n", "delete", 1),
    )
    assert rows(net_changes(feed, ["k"]), "k", "v", KIND, VERSION) == {
        (1, "b", "insert", 1): 1,
        (3, "a", "update_preimage", 0): 1, (3, "c", "update_postimage", 0): 1,
        (5, None, "delete", 2): 1,
        (None, "n", "insert", 0): 1, (None, "n", "delete", 1): 1,
    }
    assert net_changes(feed.limit(0), ["k"]).isEmpty()


def test_changes_that_do_not_add_up_fail(spark):
    with pytest.raises(Exception, match="do not add up"):
        net_changes(change(spark, (1, "a", "insert", 0), (1, "b", "insert", 1)), ["k"]).collect()


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    feed = spark.range(20_001).select(
        F.lit(1).alias("k"), F.col("id").cast("string").alias("v"), F.when(F.col("id") % 2 == 0, "insert").otherwise("delete").alias(KIND),
        F.col("id").alias(VERSION), F.timestamp_seconds("id").alias(TIME),
    )
    net = net_changes(feed, ["k"])
    assert rows(net, "k", "v", KIND, VERSION) == {(1, "20000", "insert", 20_000): 1}
    assert "partial_max_by" in net._jdf.queryExecution().executedPlan().toString()


def test_a_log_reads_the_commits_of_a_range_alone(spark, tmp_path):
    many = [{1: "a"}, {1: "a", 2: "b"}, {1: "a", 2: "b"}, {2: "c"}]
    log = ChangeLog(Lake(spark, str(tmp_path)), "s.t", frame(spark, {}).schema, ["k"])
    assert log.last() is None and log.between().isEmpty()
    for number, (old, new) in enumerate(itertools.pairwise([{}, *many])):
        assert log.commit(frame(spark, old), frame(spark, new), datetime(2020, 1, 1 + number)) == number
    assert rows(log.between(), "k", "v", KIND, VERSION) == {
        (1, "a", "insert", 0): 1, (2, "b", "insert", 1): 1, (1, "a", "delete", 3): 1,
        (2, "b", "update_preimage", 3): 1, (2, "c", "update_postimage", 3): 1,
    }
    # A commit without changes is a version all the same.
    assert log.last()[0] == 3 and log.between(2, 2).isEmpty()
    times = rows(log.between(1, 1), TIME)
    assert times == {(datetime(2020, 1, 2),): 1}
    with pytest.raises(ValueError):
        log.commit(frame(spark, many[3]), frame(spark, many[3]), datetime(2019, 1, 1))
    # Broken files of other commits are not opened, whether versions or times are given.
    for number in (0, 3):
        for part in tmp_path.rglob(f"commit_version={number}/**/*.parquet"):
            part.write_text("not a table")
    assert rows(log.between(1, 2), "k") == rows(log.between(since=datetime(2020, 1, 2), until=datetime(2020, 1, 3, 12)), "k") == {(2,): 1}


DIM = (
    "sk long, k string, n int, active_rec_ind boolean, start_timestamp timestamp, end_timestamp timestamp, load_date_dt date, seen_dts array<date>"
)


def versions_of(history):
    """What snapshots by day come to, in order of day."""
    out = {}
    for k in {k for snap in history.values() for k in snap}:
        last = None
        for day in sorted(history):
            if k in history[day] and (last is None or history[day][k] != last[0]):
                if last:
                    out[k, last[0], last[1], day] = 1
                last = (history[day][k], day)
        out[k, last[0], last[1], None] = 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_snapshots_in_any_order_give_the_same_versions(spark, seed):
    rnd = random.Random(seed)
    days = [date(2020, 1, 1) + timedelta(days=7 * i) for i in range(6)]
    order = rnd.sample(days, 6)
    dim, history = spark.createDataFrame([], DIM), {}
    for day in order:
        history[day] = {k: rnd.choice([1, 1, 2, None]) for k in "abcde" if rnd.random() < 0.7}
        snap = spark.createDataFrame(list(history[day].items()), "k string, n int")
        dim = scd2_splice(dim, snap, "k", ["n"], day, surrogate="sk")
        dim = spark.createDataFrame(dim.collect(), DIM)
        found = rows(dim.select("k", "n", F.to_date("start_timestamp"), F.to_date("end_timestamp")))
        assert found == versions_of(history)
        assert dim.where("active_rec_ind <> (end_timestamp is null) or sk is not null").isEmpty()
    assert sum(len(r["seen_dts"]) for r in dim.collect()) == sum(map(len, history.values()))


def test_in_order_it_is_the_usual_merge_and_keys_are_kept(spark):
    snaps = [{"a": 1, "b": 1, "c": 1}, {"a": 2, "b": 1}, {"a": 2, "b": 3, "d": 4}]
    usual = spark.createDataFrame([], DIM).drop("seen_dts")
    spliced = spark.createDataFrame([], DIM)
    for month, state in enumerate(snaps, 1):
        snap = spark.createDataFrame(list(state.items()), "k string, n int")
        usual = scd2_merge(usual, snap, "k", ["n"], date(2020, month, 1))
        spliced = scd2_splice(spliced, snap, "k", ["n"], date(2020, month, 1), "sk")
    shown = ["k", "n", "active_rec_ind", "start_timestamp", "end_timestamp", "load_date_dt"]
    assert rows(spliced, *shown) == rows(usual, *shown)
    numbered = spark.createDataFrame([r.asDict() | {"sk": i} for i, r in enumerate(sorted(spliced.collect(), key=str))], DIM)
    before = {(r["k"], r["start_timestamp"]): r["sk"] for r in numbered.collect()}
    late = scd2_splice(numbered, spark.createDataFrame([("b", 9), ("c", 1), ("e", 5)], "k string, n int"), "k", ["n"], date(2020, 1, 15), "sk")
    keys = {(r["k"], r["start_timestamp"].date()): r["sk"] for r in late.collect()}
    # b is cut at the 15th; its second part is seen again in February and needs a number.
    assert keys["b", date(2020, 1, 15)] is None and keys["b", date(2020, 2, 1)] is None and keys["e", date(2020, 1, 15)] is None
    assert {k: v for k, v in keys.items() if v is not None} == {(k, s.date()): v for (k, s), v in before.items()}
    with pytest.raises(Exception, match="repeated key"):
        scd2_splice(numbered, spark.createDataFrame([("b", 9), ("b", 1)], "k string, n int"), "k", ["n"], date(2020, 1, 15)).collect()
