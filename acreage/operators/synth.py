"""Repeatable random feed rows, one per given id, made by expressions only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.columns import equity, gross_yield
from acreage.schemas import SALES_FEED, TABLES

INVESTORS = 10_000
# Kinds drawn for the sales feed.
CLASSES = ["Residential", "Commercial"]
TYPES = ["Single Family", "Multi-Family", "Townhouse"]


class Draws:
    """Numbers that depend only on a seed, the row's id and the name of the draw.

    Each draw is 32 bits of an MD5 digest, so it is the same on every run, in every partition
    and in any SQL engine.
    """

    def __init__(self, row_id: str, seed: int):
        self.row_id, self.seed = F.col(row_id), seed

    def number(self, name: str) -> Column:
        text = F.concat(F.lit(f"{self.seed}:{name}:"), self.row_id.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

    def whole(self, name: str, low: int, high: int) -> Column:
        return (self.number(name) % (high - low + 1) + low).cast("int")

    def cents(self, name: str, low: int, high: int) -> Column:
        """An amount between two whole amounts, to the cent."""
        return (self.number(name) % ((high - low) * 100 + 1) + low * 100) / 100

    def one_of(self, name: str, values: list[str]) -> Column:
        place = (self.number(name) % len(values) + 1).cast("int")
        return F.element_at(F.array(*[F.lit(v) for v in values]), place)

    def chance(self, name: str, percent: int) -> Column:
        return self.number(name) % 100 < percent

    def day(self, name: str, end: date, years: int) -> Column:
        return F.date_sub(F.lit(end), self.whole(name, 0, years * 365))

    def padded(self, name: str, count: int, width: int) -> Column:
        return F.lpad((self.number(name) % count).cast("string"), width, "0")


def synth_sales(ids: DataFrame, as_of: date, seed: int = 42, row_id: str = "id") -> DataFrame:
    """Sales feed rows: 10,000 investors, ten years of sales, values in the feed's ranges."""
    draw = Draws(row_id, seed)
    basic = ids.select(
        F.col(row_id),
        F.concat(F.lit("Investor "), draw.padded("investor", INVESTORS, 5)).alias("Investor Name"),
        F.concat(draw.whole("house", 1, 9999).cast("string"), F.lit(" Street "), draw.padded("street", 1000, 3)).alias("Address"),
        F.concat(F.lit("City "), draw.padded("city", 500, 3)).alias("City"),
        F.concat(F.lit("S"), draw.padded("state", 50, 2)).alias("State"),
        draw.padded("zip", 100_000, 5).alias("Zip"),
        F.concat(F.lit("County "), draw.padded("county", 300, 3)).alias("County"),
        F.md5(F.concat(F.lit(f"{seed}:apn:"), F.col(row_id).cast("string"))).alias("APN"),
        draw.one_of("occupied", ["Yes", "No"]).alias("Owner Occupied"),
        F.concat(draw.whole("mail_house", 1, 9999).cast("string"), F.lit(" Street "), draw.padded("mail_street", 1000, 3)).alias("Mailing Address"),
        F.concat(F.lit("City "), draw.padded("mail_city", 500, 3)).alias("Mailing City"),
        F.concat(F.lit("S"), draw.padded("mail_state", 50, 2)).alias("Mailing State"),
        draw.padded("mail_zip", 100_000, 5).alias("Mailing Zip"),
        draw.one_of("class", CLASSES).alias("Property Class"),
        draw.one_of("type", TYPES).alias("Property Type"),
        draw.whole("beds", 1, 6).alias("Bedrooms"),
        (draw.whole("baths", 10, 40) / 10).alias("Bathrooms"),
        draw.whole("sqft", 600, 5000).alias("Building Sqft"),
        draw.whole("built", 1950, 2023).alias("Year Built"),
        draw.whole("lot", 1000, 10000).alias("Lot Size Sqft"),
        draw.day("sale_day", as_of, 10).alias("Last Sale Date"),
        draw.cents("sale", 50_000, 1_000_000).alias("Last Sale Amount"),
        draw.whole("value_pct", 100, 150).alias("_value_pct"),
        draw.whole("rent_permille", 5, 10).alias("_rent_permille"),
    )
    sale, value, rent = F.col("Last Sale Amount"), F.col("`Est. Value`"), F.col("Monthly Rent")
    valued = basic.withColumn("Est. Value", F.floor(sale * F.col("_value_pct") / 100).cast("int"))
    rented = valued.withColumn("Monthly Rent", F.floor(value * F.col("_rent_permille") / 1000).cast("int"))
    full = rented.withColumn("Est. Equity", equity(value, sale).cast("float")).withColumn(
        "Gross Yield %", gross_yield(rent, value)
    )
    return full.select(*[F.col(f"`{name}`") for name in SALES_FEED.names])


def synth_parcels(ids: DataFrame, as_of: date, seed: int = 42, row_id: str = "id") -> DataFrame:
    """Parcel rows keyed by the id: a tenth without investor, a fifth without list price."""
    draw = Draws(row_id, seed)
    moment = F.lit(as_of).cast("timestamp")
    none = F.lit(None).cast("string")
    columns = {
        "brnz_prcl_prop_sales_dtl_sk": F.col(row_id).cast("bigint"),
        "load_date_dt": F.lit(as_of),
        "etl_nr": F.lit(1).cast("bigint"),
        "etl_recorded_gmts": moment,
        "record_inserted_ts": moment,
        "investor_company_nm_txt": F.when(
            ~draw.chance("no_investor", 10),
            F.concat(F.lit("Investor "), draw.padded("investor", INVESTORS, 5)),
        ),
        "prop_sale_dt": draw.day("sale_day", as_of, 2),
        "prop_sale_amt": draw.whole("sale", 50_000, 1_000_000).cast("double"),
        "prop_attr_br_cnt": draw.whole("beds", 1, 6),
        "prop_attr_bth_cnt": draw.whole("baths", 1, 4),
        "prop_attr_sqft_nr": draw.whole("sqft", 600, 5000),
        "prop_yr_blt_nr": draw.whole("built", 1950, 2023),
        "prop_address_line_txt": F.upper(
            F.concat(draw.whole("house", 1, 9999).cast("string"), F.lit(" Street "), draw.padded("street", 1000, 3))
        ),
        "prop_city_nm": F.upper(F.concat(F.lit("City "), draw.padded("city", 500, 3))),
        "prop_state_nm": F.concat(F.lit("S"), draw.padded("state", 50, 2)),
        "prop_cnty_nm": F.concat(F.lit("City "), draw.padded("county", 300, 3), F.lit(" County")),
        "prop_zip_cd": draw.padded("zip", 100_000, 5),
        "prop_list_price_amt": F.when(~draw.chance("no_price", 20), F.lit("0.0")),
        "prop_acty_status_cd": F.lit("SALE"),
        "prop_acty_status_dc": none,
        "prop_acty_sub_status_cd": F.lit("SOLD"),
        "prop_acty_sub_status_dc": none,
        "prop_latitude_val": (draw.whole("lat", -90_000_000, 90_000_000) / 1_000_000).cast("decimal(9,6)"),
        "prop_longitude_val": (draw.whole("lon", -180_000_000, 180_000_000) / 1_000_000).cast("decimal(9,6)"),
    }
    names = TABLES["bronze.brnz_prcl_prop_sales_dtl"].names
    return ids.select(*[columns[name].alias(name) for name in names])
