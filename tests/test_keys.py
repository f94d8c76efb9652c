from pyspark.sql import functions as F
from util import plan

from acreage.operators.keys import dense_surrogate_key, high_water_mark, latest_batch, marks


def test_marks_default_to_zero(spark):
    empty = spark.createDataFrame([], "sk bigint, etl_nr bigint")
    assert tuple(high_water_mark(empty, ["sk", "etl_nr"]).first()) == (0, 0)
    df = spark.createDataFrame([(5, 1), (3, 2), (None, None)], empty.schema)
    assert marks(df, "sk", "etl_nr") == (5, 2)


def test_keys_are_dense_and_in_order(spark):
    # D1: the first new key is base + 1, never the base itself.
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    rows = dense_surrogate_key(df, "sk", 50, ["v"]).orderBy("v").collect()
    assert [(r["v"], r["sk"]) for r in rows] == [(i, 51 + i) for i in range(1000)]


def test_keys_are_dense_without_an_order_too(spark):
    df = spark.range(500).select(F.lit("copy").alias("v")).repartition(5)
    keys = sorted(r["sk"] for r in dense_surrogate_key(df, "sk", 0).collect())
    assert keys == list(range(1, 501))


def test_no_rows_get_no_keys(spark):
    assert dense_surrogate_key(spark.range(0), "sk", 0, ["id"]).isEmpty()


def test_numbering_needs_no_window(spark):
    numbered = dense_surrogate_key(spark.range(100), "sk", 0, ["id"])
    text = plan(numbered)
    assert "Window" not in text and "SinglePartition" not in text and "SortMergeJoin" not in text


def test_latest_batch_skips_other_batches_folders(spark, tmp_path):
    # D2
    path = str(tmp_path / "t")
    spark.range(100).withColumn("etl_nr", F.col("id") % 4).write.partitionBy("etl_nr").parquet(path)
    newest = latest_batch(spark.read.parquet(path))
    assert {r["etl_nr"] for r in newest.collect()} == {3}
    assert newest.count() == 25
    assert "PartitionFilters: [isnotnull(etl_nr" in plan(newest)
    assert latest_batch(spark.read.parquet(path).where("etl_nr > 9")).isEmpty()
