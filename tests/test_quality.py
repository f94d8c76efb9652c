import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_changes import SKEWED
from util import plan, ran, rows, settings

from acreage.operators.integrity import ROW_COUNT, SCHEMA, check_integrity
from acreage.operators.quality import check_quality, duplicated_rows, find_failures, quarantine

ROW = "pk int, a int, b string"
RULES = [
    {"rule_type": "not_null", "columns": ["a", "b"]},
    {"rule_type": "value_range", "column": "a", "min": 0, "max": 10},
    {"rule_type": "allowed_values", "column": "b", "allowed_values": ["x", "y"]},
    {"rule_type": "unique", "columns": ["a", "b"]},
]


def data(spark):
    return spark.createDataFrame(
        [(1, 1, "x"), (2, None, None), (3, 11, "z"), (4, 5, "y"), (5, 5, "y"), (6, None, None)], ROW
    )


def test_failures_by_hand(spark):
    found = find_failures(data(spark), RULES, "pk")
    assert rows(found, "pk", "rule_type", "failed_col_nm", "failed_col_value", "failed_record_detail") == {
        **{(pk, "not_null", c, None, f"Null in column {c}"): 1 for pk in (2, 6) for c in ("a", "b")},
        (3, "value_range", "a", "11", "Value outside range [0, 10]"): 1,
        (3, "allowed_values", "b", "z", "Disallowed value in column b"): 1,
        # D11: a key of several columns; D12: NULL passes the other rules and is no duplicate.
        **{(pk, "unique", "a,b", "5,y", "Duplicate on ['a', 'b']"): 1 for pk in (4, 5)},
    }
    record = {r["pk"]: json.loads(r["failed_record"]) for r in found.collect()}
    assert record[3] == {"pk": "3", "a": "11", "b": "z"} and record[2] == {"pk": "2"}


def test_row_rules_read_the_table_once(spark, tmp_path):
    data(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert plan(find_failures(df, RULES[:3], "pk")).count("FileScan") == 1


def test_filter_drops_every_row_of_a_failing_key(spark):
    kept, _ = check_quality(data(spark), RULES, "t", "pk")
    assert rows(kept) == {(1, 1, "x"): 1}
    df = spark.createDataFrame([(1, 1, "x"), (1, None, "x"), (None, None, "x")], ROW)
    kept, _ = check_quality(df, RULES[:1], "t", "pk")
    assert rows(kept) == {(None, None, "x"): 1}


@pytest.mark.parametrize("mode, left", [("stat", 6), ("filter_and_stat", 1)])
def test_stat_modes_store_failures(spark, tmp_path, mode, left):
    # D13: any table and key.
    store = str(tmp_path / "bad")
    for _ in range(2):
        kept, _ = check_quality(data(spark), RULES, "any.table", "pk", mode, as_of=date(2001, 8, 1), bad_records=store)
    stored = spark.read.parquet(store)
    assert kept.count() == left
    # Keys follow those the store holds already.
    assert sorted(r["brnz_bd_rec_sk"] for r in stored.collect()) == list(range(1, 17))
    assert "pk" not in stored.columns
    assert rows(stored, "tbl_nm", F.col("load_date").cast("string")) == {("any.table", "2001-08-01"): 16}


def test_mistakes_raise(spark):
    # D14, D15 and the unknown mode
    df = data(spark)
    for rules, mode in (
        (RULES, "warn"), ([{"rule_type": "regex"}], "filter"), ([{}], "filter"), ([], "filter"), (RULES, "stat"),
    ):
        with pytest.raises(ValueError):
            check_quality(df, rules, "t", "pk", mode)


def test_a_hot_duplicate_is_split(spark):
    df = spark.range(20000).repartition(16).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    with settings(spark, SKEWED):
        assert "skew=true" in ran(duplicated_rows(df, ["k"]))
    assert duplicated_rows(df, ["k"]).count() == 16000


def test_quarantine_layout(spark):
    failures = find_failures(data(spark), RULES[:1], "pk")
    out = quarantine(failures, "t", date(2001, 8, 1), 0, "pk")
    assert out.columns == [
        "brnz_bd_rec_sk", "tbl_nm", "pk", "failed_col_nm", "rule_type", "failed_record_detail",
        "failed_col_value", "failed_record", "load_date", "load_date_ts",
    ]


def test_integrity(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(5).withColumn("v", F.lit("a"))
    df.write.option("header", True).csv(path)
    df.createOrReplaceTempView("five")
    df.limit(4).createOrReplaceTempView("four")
    both = check_integrity(spark, path, "five", [ROW_COUNT, SCHEMA], file_schema=df.schema)
    assert rows(both, "rule", "passed") == {(ROW_COUNT, True): 1, (SCHEMA, True): 1}
    off = check_integrity(spark, path, "four", [ROW_COUNT, SCHEMA], file_schema=spark.range(1).schema)
    assert rows(off, "passed", "detail") == {(False, "csv_rows=5, table_rows=4"): 1, (False, "columns differ"): 1}
    with pytest.raises(ValueError, match="integrity check failed"):
        check_integrity(spark, path, "four", [ROW_COUNT], raise_on_failure=True)
    for rules in ([""], ["other"]):
        with pytest.raises(ValueError):
            check_integrity(spark, path, "five", rules)
    # A table that is not there yet has no schema to differ.
    assert check_integrity(spark, path, "five", [SCHEMA], file_schema=df.schema, table_exists=False).isEmpty()
