from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from util import plan, rows

from acreage.functions.columns import (
    activity_flag,
    address_key,
    amount_if,
    geo_quantize,
    gross_yield,
    months_back,
    whole_baths,
)
from acreage.operators.conform import conform, row_counts, split_good_bad, trailing_months, with_audit

ADDRESS = "prop_address_line_txt string, prop_city_nm string, prop_state_nm string, prop_cnty_nm string, prop_zip_cd string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_conform_renames_casts_and_drops_in_one_projection(spark):
    raw = spark.createDataFrame(
        [("A", "3", 2.7, "TX", "x"), ("B", "n/a", -1.5, "12.5", "y")],
        "`Investor Name` string, Beds string, `No. Baths` double, State string, Unused string",
    )
    out = conform(
        raw,
        {
            "Investor Name": ("investor", "string"),
            "Beds": ("br", "int"),
            "No. Baths": ("bth", "int"),
            "State": ("price", "double"),
        },
    )
    assert out.columns == ["investor", "br", "bth", "price"]
    # D17: text that is no number becomes NULL instead of failing; fractions are cut off.
    assert rows(out) == rows(
        spark.createDataFrame([("A", 3, 2, None), ("B", None, -1, 12.5)], out.schema)
    )
    assert "PythonUDF" not in plan(out) and plan(out).count("Project") <= 1


def test_audit_columns_do_not_depend_on_the_clock(spark):
    # D20
    row = with_audit(spark.range(1), date(2001, 8, 1), 4).first()
    assert row["load_date_dt"] == date(2001, 8, 1)
    assert row["etl_nr"] == 4
    assert row["etl_recorded_gmts"] == row["record_inserted_ts"] == datetime(2001, 8, 1)


def test_split_covers_all_rows_and_dedupes_only_bad_ones(spark):
    # D21
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None)], "k int, v string"
    )
    good, bad = split_good_bad(df, ["k", "v"])
    assert sorted(map(tuple, good.collect())) == [(1, "a"), (1, "a")]
    assert rows(bad) == {(None, "b"): 1, (2, None): 1}
    assert set(rows(good)) | set(rows(bad)) == set(rows(df))


def test_address_key_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("1 A St", "C", "S", "N", "00001"), ("1 A St", "C", "S", "N", None)], ADDRESS)
    keys = [tuple(r) for r in df.select(address_key(), address_key(county=True)).collect()]
    assert keys == [("1 A St/C/S/00001", "1 A St/C/S/N/00001"), (None, None)]


def test_trailing_months_includes_both_ends(spark):
    days = ["2000-07-31", "2000-08-01", "2001-08-01", "2001-08-02", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    kept = trailing_months(df, date(2001, 8, 1), 12, "d")
    assert rows(kept.select(F.col("d").cast("string"))) == {("2000-08-01",): 1, ("2001-08-01",): 1}


@pytest.mark.parametrize(
    "day, months, expected",
    [("2024-08-31", 6, "2024-02-29"), ("2023-08-31", 6, "2023-02-28"), ("2024-01-15", 1, "2023-12-15")],
)
def test_months_back_keeps_the_day_where_it_exists(spark, day, months, expected):
    # D9
    assert str(one(spark, months_back(F.lit(day).cast("date"), months))) == expected


def test_coordinates_round_half_up_and_out_of_range_is_null(spark):
    assert str(one(spark, geo_quantize(F.lit(12.3456785)))) == "12.345679"
    assert str(one(spark, geo_quantize(F.lit(-12.3456785)))) == "-12.345679"
    assert one(spark, geo_quantize(F.lit(1234.5))) is None
    assert one(spark, whole_baths(F.lit(2.1))) == 3


def test_activity_flag_takes_blanks_and_underscores(spark):
    # D18
    cases = [
        ("SALE", "SOLD", True), ("SALE", "PRICE_CHANGE", False), ("LISTING", "PENDING SALE", True),
        ("RENTAL", "DELISTED FOR RENT", True), ("RENTAL", "SOLD", False), ("OTHER", "SOLD", False),
        (None, "SOLD", False), ("SALE", None, False),
    ]
    df = spark.createDataFrame(cases, "s string, sub string, want boolean")
    assert df.where(activity_flag(F.col("s"), F.col("sub")) != F.col("want")).isEmpty()


def test_amounts_and_yield(spark):
    assert one(spark, amount_if(F.lit("RENTAL"), "RENTAL", F.lit(5.0))) == 5.0
    assert one(spark, amount_if(F.lit("SALE"), "RENTAL", F.lit(5.0))) == 0.0
    assert one(spark, amount_if(F.lit(None).cast("string"), "RENTAL", F.lit(5.0))) == 0.0
    assert one(spark, gross_yield(F.lit(1000), F.lit(150000))) == 8.0
    assert one(spark, gross_yield(F.lit(1000), F.lit(0))) is None


def test_row_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert tuple(row_counts(df).first()) == (3, 2)
    assert tuple(row_counts(df.where("a > 5")).first()) == (0, 0)
