from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from util import plan, rows

from acreage.operators.conform import trailing_months
from acreage.operators.synth import synth_sales
from acreage.plans import jobs
from acreage.schemas import PARCEL_RESPONSE, TABLES
from acreage.sources.writers import Lake

ONE, TWO = date(2001, 8, 1), date(2001, 9, 1)


def feed(spark, low, high):
    """Generated sales with real grades and few investors, so that some are active."""
    return synth_sales(spark.range(low, high), ONE).withColumns(
        {
            "Investor Name": F.concat(F.lit("I"), (F.crc32(F.col("APN").cast("binary")) % 9).cast("string")),
            "Property Class": F.lit("Good"),
            "Last Sale Date": F.lit("2001-05-01").cast("date"),
        }
    )


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    jobs.bronze_sales(lake, feed(spark, 0, 60), ONE)
    jobs.silver_sales(lake, ONE)
    jobs.investors(lake, ONE)
    return lake


def test_each_load_is_the_next_batch_with_the_next_keys(spark, lake):
    # D1, D2, D3
    again = feed(spark, 40, 90).withColumn("Zip", F.when(F.col("Bedrooms") == 6, None).otherwise(F.col("Zip")))
    jobs.bronze_sales(lake, again, TWO)
    bronze = jobs.table(lake, jobs.BRONZE_SALES)
    keys = sorted((r["etl_nr"], r["brnz_prps_prop_sales_dtl_sk"]) for r in bronze.collect())
    assert keys == [(1, k) for k in range(1, 61)] + [(2, k) for k in range(61, 111)]
    silver = jobs.silver_sales(lake, TWO)
    incomplete = again.where("Bedrooms = 6").count()
    known = again.where("Bedrooms <> 6").join(feed(spark, 0, 60), "APN", "left_semi").count()
    assert silver.count() == 60 + 50 - incomplete - known
    assert sorted(r["slv_prps_prop_pk"] for r in silver.collect()) == list(range(1, silver.count() + 1))
    assert lake.newest(jobs.BAD_SALES, TABLES[jobs.BAD_SALES]).count() == incomplete
    # Running a load that finds nothing new adds nothing.
    assert jobs.silver_sales(lake, TWO).count() == silver.count()
    profiles = lake.newest(jobs.PROFILES, TABLES[jobs.PROFILES])
    assert profiles.select("etl_nr").distinct().count() == 1


def test_investors_get_a_new_version_when_their_sales_change(spark, lake):
    before = jobs.dimension(lake)
    jobs.bronze_sales(lake, feed(spark, 200, 230), TWO)
    jobs.silver_sales(lake, TWO)
    after = jobs.investors(lake, TWO)
    assert after.where("active_rec_ind").groupBy("investor_company_nm_txt").count().where("count > 1").isEmpty()
    assert after.where("not active_rec_ind").count() > 0
    assert after.select("slvr_int_inv_dtl_sk").distinct().count() == after.count() > before.count()
    again = jobs.investors(lake, TWO)
    assert rows(again) == rows(after)
    # A day before the last one is not written as the newest.
    with pytest.raises(ValueError, match="later than"):
        jobs.investors(lake, ONE)
    assert rows(jobs.dimension(lake)) == rows(after)


def test_parcels_to_sales_detail(spark, lake):
    # D25: the two loads of the sales detail run one after the other and keep each other's rows.
    box = jobs.buy_boxes(jobs.current_rows(jobs.dimension(lake))).first()
    response = [
        (
            i, box["attr_br_cnt"], float(box["attr_bth_cnt"]), box["min_sqft"], box["min_year"] + 1, f"{i} A St", "C", "TX",
            "N", box["list_zips"][0], 30.0, -97.0,
            [("SALE", "SOLD", "2001-05-01", "O", 5.0), ("RENTAL", "DELISTED FOR RENT", "2001-04-01", "O", 3.0)],
        )
        for i in range(4)
    ]
    parcels = jobs.parcel_rows(spark.createDataFrame(response, PARCEL_RESPONSE))
    assert rows(parcels, "prop_acty_status_cd", "prop_acty_sub_status_cd") == {
        ("SALE", "SOLD"): 4, ("RENTAL", "DELISTED_FOR_RENT"): 4,
    }
    jobs.bronze_parcels(lake, parcels, TWO)
    matched = jobs.match(lake, TWO)
    assert matched.where("slvr_int_inv_dtl_sk is not null").count() >= 8
    assert rows(matched, "src_system_cd", "etl_nr").keys() == {("PAR", 1)}
    pairs = jobs.comparables(lake, TWO)
    assert pairs.count() == matched.count() * 8
    detail = jobs.parcel_sales(lake, TWO)
    assert detail.count() == pairs.count()
    merged = jobs.sales_history(lake, TWO)
    # D27: every batch that landed is taken, not the newest alone.
    landed = jobs.table(lake, jobs.BRONZE_SALES).count()
    assert lake.marks(jobs.BRONZE_SALES)["etl_nr"] == 3
    assert merged.count() == pairs.count() + landed
    assert sorted(r["slvr_int_prop_dtl_sk"] for r in merged.collect()) == list(range(1, merged.count() + 1))
    # Settled rows are not written again: the last load's folder holds the open ones only.
    folders = sorted(p.name for p in Path(lake.path(jobs.SALES_DETAIL)).iterdir() if p.is_dir())
    assert folders == ["v=000000", "v=000001"]
    assert spark.read.parquet(f"{lake.path(jobs.SALES_DETAIL)}/v=000001").count() == landed
    # Loads that find no new batch add nothing.
    before = rows(merged)
    for load in (jobs.match, jobs.comparables, jobs.parcel_sales, jobs.sales_history, jobs.silver_sales):
        load(lake, TWO)
    assert rows(jobs.sales_detail(lake)) == before
    assert jobs.table(lake, jobs.PROPERTIES).count() == matched.count()
    assert jobs.table(lake, jobs.COMPS).count() == pairs.count()
    # The same sales as a new batch: every row is kept, and ties are all the latest.
    jobs.bronze_sales(lake, feed(spark, 200, 230), TWO)
    flagged = jobs.sales_history(lake, TWO).where("usraddr is not null and latest_record_ind")
    assert flagged.count() == merged.where("usraddr is not null and latest_record_ind").count() + 30


def test_the_sales_detail_makes_sales_and_pairs_in_one_pass(spark, tmp_path):
    """No union hands on every pair before it is counted."""
    lake = Lake(spark, str(tmp_path))
    sale = spark.createDataFrame([(1, date(2001, 5, 1), 5.0, "A/C", False), (2, None, None, None, None)], "slvr_int_prop_dtl_sk long, prop_sale_dt date, prop_sale_amt double, usraddr string, latest_record_ind boolean")
    lists = spark.createDataFrame(
        [(2, 10, [7, 8], [(ONE, 1.0, None), (None, 2.0, 3.0)])], jobs.T.StructType([f for f in jobs.DETAIL_STORED if f.name in ("_first", "_comps", "_owners", "_parcels")])
    )
    lake.advance(jobs.SALES_DETAIL, sale.unionByName(lists, allowMissingColumns=True), jobs.DETAIL_STORED, F.lit(False))
    detail = jobs.sales_detail(lake)
    assert rows(detail, "slvr_int_prop_dtl_sk", "slvr_int_prop_sk", "slvr_int_prop_comps_sk", "prop_sale_dt", "prop_sale_amt", "prop_list_price_amt", "usraddr", "latest_record_ind") == {
        (1, None, None, date(2001, 5, 1), 5.0, None, "A/C", False): 1, (2, None, None, None, None, None, None, None): 1,
        (3, 7, 11, ONE, 1.0, None, None, True): 1, (4, 8, 12, ONE, 1.0, None, None, True): 1,
        (5, 7, 13, None, 2.0, 3.0, None, True): 1, (6, 8, 14, None, 2.0, 3.0, None, True): 1,
    }
    assert detail.where("slvr_int_prop_comps_sk is null").count() == 2 and detail.where("latest_record_ind").count() == 4
    assert "Union" not in plan(detail)


def test_parcels_that_land_between_loads_are_not_lost(spark, tmp_path):
    # D27
    lake = Lake(spark, str(tmp_path))
    jobs.bronze_sales(lake, feed(spark, 0, 60), ONE)
    jobs.silver_sales(lake, ONE)
    jobs.investors(lake, ONE)

    def parcels(*numbers):
        response = [
            (i, 3, 2.0, 1000, 1990, f"{i} A St", "C", "TX", "N", "1", 30.0, -97.0, [("SALE", "SOLD", "2001-05-01", "O", 5.0)])
            for i in numbers
        ]
        return jobs.parcel_rows(spark.createDataFrame(response, PARCEL_RESPONSE))

    jobs.bronze_parcels(lake, parcels(1, 2), ONE)
    jobs.bronze_parcels(lake, parcels(3), ONE)
    matched = jobs.match(lake, ONE)
    assert matched.select("brnz_prcl_prop_sales_dtl_sk").distinct().count() == 3
    pairs = jobs.comparables(lake, ONE)
    assert pairs.count() == matched.count() * 3
    # A batch that lands after the comparables does not part them from their parcels.
    jobs.bronze_parcels(lake, parcels(4), TWO)
    assert jobs.parcel_sales(lake, TWO).count() == pairs.count()
    assert jobs.match(lake, TWO).where("etl_nr = 2").select("brnz_prcl_prop_sales_dtl_sk").distinct().count() == 1


def test_the_profile_window_prunes_years_and_batches_prune_folders(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    old = feed(spark, 0, 20).withColumn("Last Sale Date", F.lit("1998-05-01").cast("date"))
    for part in (old, feed(spark, 20, 40)):
        jobs.bronze_sales(lake, part, ONE)
        jobs.silver_sales(lake, ONE)
    recent = trailing_months(jobs.table(lake, jobs.SILVER_SALES), ONE, year="year")
    text = plan(recent)
    filters = text.split("PartitionFilters")[1].split("]")[0]
    assert "isnotnull(year" in filters and "(year" in filters
    # Files of other years and batches may be broken without anyone noticing.
    for broken in ((tmp_path / "silver").rglob("year=1998/*.parquet"), (tmp_path / "bronze").rglob("etl_nr=1/**/*.parquet")):
        for part in list(broken):
            part.write_text("not a table")
    assert recent.count() == 20
    assert jobs.batches(lake, jobs.BRONZE_SALES, 1, 2).count() == 20
    assert lake.marks(jobs.SILVER_SALES) == {"load_nr": 2, "taken_nr": 2, "top_nr": 40}
    jobs.bronze_sales(lake, feed(spark, 40, 50), ONE)
    assert lake.marks(jobs.BRONZE_SALES) == {"etl_nr": 3, "top_nr": 50}


def test_a_batch_whose_append_failed_is_loaded_when_it_is_whole(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    jobs.bronze_sales(lake, feed(spark, 0, 20), ONE)
    jobs.silver_sales(lake, ONE)
    jobs.bronze_sales(lake, feed(spark, 20, 50), ONE)
    (mark,) = (tmp_path / "bronze" / "brnz_prps_prop_sales_dtl" / "batch=000002").rglob("_SUCCESS")
    mark.unlink()
    assert jobs.silver_sales(lake, ONE).count() == 20 and lake.marks(jobs.SILVER_SALES)["taken_nr"] == 1
    jobs.bronze_sales(lake, feed(spark, 20, 50), ONE)
    assert jobs.silver_sales(lake, ONE).count() == 50
    assert lake.marks(jobs.SILVER_SALES) == {"load_nr": 2, "taken_nr": 2, "top_nr": 50}


def test_a_load_that_finds_nothing_new_is_recorded(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    gaps = feed(spark, 0, 20).withColumn("Zip", F.when(F.col("Bedrooms") == 6, None).otherwise(F.col("Zip")))
    for part in (feed(spark, 0, 20), gaps):
        jobs.bronze_sales(lake, part, ONE)
        jobs.silver_sales(lake, ONE)
    assert lake.marks(jobs.SILVER_SALES) == {"load_nr": 2, "taken_nr": 2, "top_nr": 20}
    snapshots = sorted(p.name for p in Path(lake.path(jobs.BAD_SALES)).iterdir())
    for _ in range(2):
        assert jobs.silver_sales(lake, ONE).count() == 20
    assert sorted(p.name for p in Path(lake.path(jobs.BAD_SALES)).iterdir()) == snapshots
    # The quarantine of the next load holds that load's rows alone.
    jobs.bronze_sales(lake, feed(spark, 30, 40), ONE)
    assert jobs.silver_sales(lake, ONE).count() == 30
    assert lake.newest(jobs.BAD_SALES, TABLES[jobs.BAD_SALES]).isEmpty()
    # Parcels that match nothing known leave marks behind them as well.
    jobs.bronze_parcels(lake, spark.createDataFrame([], TABLES[jobs.BRONZE_PARCELS]), ONE)
    for load, name in ((jobs.match, jobs.PROPERTIES), (jobs.comparables, jobs.COMPS)):
        assert load(lake, ONE).isEmpty() and lake.marks(name)["taken_nr"] == 1
    assert lake.marks(jobs.COMPS)["parcels_nr"] == 1


def test_counts_are_taken_as_rows_pass(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    gaps = feed(spark, 10, 40).withColumn("Zip", F.when(F.col("Bedrooms") == 6, None).otherwise(F.col("Zip")))
    incomplete = gaps.where("Zip is null").count()
    for part in (feed(spark, 0, 20), gaps, gaps.limit(0)):
        jobs.bronze_sales(lake, part, ONE)
        jobs.silver_sales(lake, ONE)
    known = gaps.where("Zip is not null").join(feed(spark, 0, 20), "APN", "left_semi").count()
    assert rows(jobs.load_counts(lake)) == {
        (1, 20, 20, 0, 20): 1, (2, 30, 30 - incomplete, incomplete, 30 - incomplete - known): 1, (3, 0, 0, 0, 0): 1,
    }


def test_of_several_batches_the_first_keeps_a_key_and_nothing_is_shuffled_for_the_years(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "GATHERED_ROWS", 10)
    lake = Lake(spark, str(tmp_path / "lake"))
    for low, high in ((0, 40), (20, 60), (0, 60), (50, 80)):
        jobs.bronze_sales(lake, feed(spark, low, high), ONE)
    # The first batch alone, then the others at once.
    good = jobs.table(lake, jobs.BRONZE_SALES).where(jobs.all_present(jobs.REQUIRED_SALE_COLUMNS))
    first = jobs.silver_rows(good.where("etl_nr = 1"), None)[0]
    assert first.count() == 40
    alone, _ = jobs.silver_rows(good, None, several=True)
    rest, _ = jobs.silver_rows(good.where("etl_nr > 1"), first, several=True)
    assert alone.count() == 80 and rest.count() == 40
    assert rows(first.unionByName(rest)) == rows(alone)
    # Whole rows stay where they are unless the keys that lose some are many.
    assert "SortMergeJoin" not in plan(alone) and "hashpartitioning" not in plan(alone)
    assert jobs.silver_sales(lake, ONE).count() == 80
    assert sorted(r["slv_prps_prop_pk"] for r in jobs.table(lake, jobs.SILVER_SALES).collect()) == list(range(1, 81))
