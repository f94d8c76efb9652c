"""What reaches the scan, and what no plan may contain."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from util import plan, ran, rows, settings

import __spark_entry__ as contract
from acreage.operators.matching import comps_sales
from acreage.plans import views
from acreage.plans.queries import ingest, loads
from acreage.schemas import TABLES
from acreage.sources.writers import stored, write_bucketed, write_partitioned

FOLDER = "/root/testdata/sf0.001"
LAZY = [
    "investor_profile", "condition_counts", "profile_json_parse", "latest_record_flag", "generic_upsert",
    "change_feed_diff", "insert_new_only", "bad_records", "valid_event_selection", "dq_all_failures",
    "conform_rename_cast", "latest_batch_scan", "comps_band_join", "silver_sales_e2e",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_in_the_engine(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    for unwanted in ("NestedLoop", "Cartesian", "Python", "Exchange SinglePartition, REPARTITION"):
        assert unwanted not in text, unwanted


def test_the_date_window_reaches_the_scan(spark):
    text = plan(contract.queries()["investor_profile"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_investor_match_joins_the_sales_once(spark, monkeypatch):
    """Profiles, counts and the match read stored sales; none makes the view's joins again."""
    made = []
    monkeypatch.setattr(views, "sales", lambda *a, _sales=views.sales, **k: made.append(a) or _sales(*a, **k))
    text = plan(contract.queries()["investor_match"](spark, FOLDER))
    assert len(made) == 1 and "stored-" in text and "lineitem.parquet" not in text


def test_unused_columns_are_not_read(spark):
    text = plan(views.sales(spark, FOLDER).select("prop_zip_cd"))
    lineitem = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in lineitem and "l_tax" not in lineitem


def test_parcels_have_their_own_layout():
    # D26
    assert len(TABLES["bronze.brnz_prcl_prop_sales_dtl"]) == 24
    assert len(TABLES) == 10


def test_a_join_of_bucketed_tables_shuffles_neither(spark, tmp_path):
    key, never = "brnz_prcl_prop_sales_dtl_sk", {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    parcels = spark.range(200).select(
        F.col("id").alias(key), F.lit("2001-01-01").cast("date").alias("prop_sale_dt"), F.col("id").cast("double").alias("prop_sale_amt"),
        F.lit("1.5").alias("prop_list_price_amt"),
    )
    pairs = spark.range(900).select((F.col("id") * 7 % 250).alias(key), F.col("id").alias("slvr_int_prop_sk"), (F.col("id") + 5).alias("slvr_int_prop_comps_sk"))
    plainly = rows(comps_sales(parcels, pairs))
    tables = [write_bucketed(df, f"bucketed_{n}", str(tmp_path / n), [key], 4) for n, df in (("a", parcels), ("b", pairs))]
    try:
        with settings(spark, never):
            joined = comps_sales(*tables)
            assert rows(joined) == plainly and "Exchange" not in ran(joined)
            assert "Exchange" in ran(comps_sales(parcels, pairs))
        # A bucket is one file, however many tasks made its rows.
        assert len(list((tmp_path / "b").glob("*.parquet"))) <= 4
    finally:
        for n in "ab":
            spark.sql(f"DROP TABLE bucketed_{n}")


def test_bucketed_pairs_are_neither_moved_nor_sorted(spark, tmp_path):
    """Tasks write what they make to every bucket, and pairs look their parcel up."""
    key, before = "brnz_prcl_prop_sales_dtl_sk", spark.conf.getAll
    parcels = spark.createDataFrame([(i, date(2001, 1, 1), 1.0 * i, "1.5") for i in [*range(60), 7]], f"{key} long, prop_sale_dt date, prop_sale_amt double, prop_list_price_amt string")
    pairs = spark.range(900, numPartitions=3).select((F.col("id") * 7 % 80).alias(key), F.col("id").alias("slvr_int_prop_sk"), (F.col("id") + 5).alias("slvr_int_prop_comps_sk"))
    plainly = rows(comps_sales(parcels, pairs))
    tables = [write_bucketed(parcels, "sold_c", str(tmp_path / "c"), [key], 4), write_bucketed(pairs, "sold_d", str(tmp_path / "d"), [key], 4, False)]
    try:
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
            joined = comps_sales(tables[0].hint("shuffle_hash"), tables[1])
            assert rows(joined) == plainly
            assert "Exchange" not in ran(joined) and "Sort " not in ran(joined) and "ShuffledHashJoin" in ran(joined)
        assert rows(tables[1]) == rows(pairs) and 4 < len(list((tmp_path / "d").glob("*.parquet"))) <= 12
        assert spark.conf.getAll == before
    finally:
        for n in "cd":
            spark.sql(f"DROP TABLE sold_{n}")


def test_widened_batches_are_made_from_the_columns_they_take(spark, monkeypatch):
    """What three batches are cut from is stored without the columns that none of them has."""
    kept = []
    monkeypatch.setattr(loads, "stored", lambda df: kept.append(df.columns) or stored(df))
    loads.type_widening(spark, FOLDER)
    assert len(kept) == 1 and len(kept[0]) == 9 and "prop_address_line_txt" not in kept[0]


def test_many_sales_are_written_where_their_joins_leave_them(spark, monkeypatch):
    """No shuffle by year of whole rows, and the same result; a small table is still gathered."""
    gathered = []

    def written(df, path, **how):
        gathered.append(how.get("gather", True))
        write_partitioned(df, path, **how)

    monkeypatch.setattr(ingest.writers, "write_partitioned", written)
    few = rows(ingest.partitioned_roundtrip(spark, FOLDER))
    monkeypatch.setattr(views, "LARGE", 0)
    assert rows(ingest.partitioned_roundtrip(spark, FOLDER)) == few and gathered == [True, False]
