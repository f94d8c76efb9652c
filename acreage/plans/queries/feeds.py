"""Landing feeds made from the whole test tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.functions.columns import equity, gross_yield
from acreage.schemas import SALES_FEED

# Rows of a landed file. Compressed CSV files and XML files are each read whole by one task.
CSV_FILE_ROWS, XML_FILE_ROWS = 500_000, 50_000

SALE_ID_SQL = (
    "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || "
    "CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)"
)


def sale_id() -> F.Column:
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat_ws("-", *[F.col(k).cast("string") for k in keys])


def sales_feed(sales: DataFrame) -> DataFrame:
    """Sales under the feed's headers. Some cells do not fit their type: beds of one ZIP are
    'n/a', and the column stored as list price holds a state for six-bed properties."""
    sale = F.col("prop_last_sale_amt")
    value = F.floor(sale * 1.25).cast("int")
    rent = F.floor(value * 0.0075).cast("int")
    cells = {
        "Investor Name": F.col("investor_company_nm_txt"),
        "Address": F.col("prop_address_line_txt"),
        "City": F.col("prop_city_nm"),
        "State": F.col("prop_state_nm"),
        "Zip": F.col("prop_zip_cd"),
        "County": F.col("prop_cnty_nm"),
        "APN": sale_id(),
        "Owner Occupied": F.col("prop_ext_cnd_nm"),
        "Mailing Address": F.col("prop_bth_cnd_nm"),
        "Mailing City": F.col("prop_kth_cnd_nm"),
        "Mailing State": F.when(F.col("prop_attr_br_cnt") == 6, F.lit("TX")).otherwise(
            F.col("prop_list_price_amt").cast("string")
        ),
        "Mailing Zip": F.col("prop_zip_cd"),
        "Property Class": F.col("prop_tlt_cnd_nm"),
        "Property Type": F.col("prop_int_cnd_nm"),
        "Bedrooms": F.when(F.col("prop_zip_cd") == "00007", F.lit("n/a")).otherwise(
            F.col("prop_attr_br_cnt").cast("string")
        ),
        "Bathrooms": F.col("prop_attr_bth_cnt") + 0.7,
        "Building Sqft": F.col("prop_attr_sqft_nr"),
        "Year Built": F.col("prop_yr_blt_nr"),
        "Lot Size Sqft": F.col("prop_attr_sqft_nr") * 2,
        "Last Sale Date": F.col("prop_last_sale_dt"),
        "Last Sale Amount": sale,
        "Est. Value": value,
        "Est. Equity": equity(value, sale).cast("float"),
        "Monthly Rent": rent,
        "Gross Yield %": gross_yield(rent, value),
    }
    return sales.select(*[cells[name].alias(name) for name in SALES_FEED.names])


def land_csv(feed: DataFrame, folder: str) -> None:
    """Land a feed as files of bounded size, compressed fast: they are read once."""
    writer = feed.write.option("header", True).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("maxRecordsPerFile", CSV_FILE_ROWS).csv(folder)


# The domain rows that conforming the feed above must give.
CONFORMED_SQL = """
    SELECT investor_company_nm_txt, prop_last_sale_dt, prop_last_sale_amt,
           CASE WHEN prop_zip_cd = '00007' THEN NULL ELSE prop_attr_br_cnt END AS prop_attr_br_cnt,
           prop_attr_bth_cnt, prop_attr_sqft_nr, prop_yr_blt_nr, prop_address_line_txt,
           prop_city_nm, prop_state_nm, prop_cnty_nm, prop_zip_cd, prop_tlt_cnd_nm,
           prop_int_cnd_nm, prop_ext_cnd_nm, prop_bth_cnd_nm, prop_kth_cnd_nm,
           CASE WHEN prop_attr_br_cnt = 6 THEN NULL ELSE prop_list_price_amt END AS prop_list_price_amt
    FROM sales
"""


def investments(orders: DataFrame) -> DataFrame:
    """One investment per order, with one or two investors and one or two returns."""
    amount = F.col("o_totalprice")
    other = F.when(
        F.col("o_orderstatus") != "F",
        F.struct(
            F.col("o_orderkey").cast("int").alias("InvestorID"),
            F.col("o_orderpriority").alias("Name"),
            F.lit(40.5).alias("OwnershipPercentage"),
            F.lit("Fund").alias("Type"),
        ),
    )
    first = F.struct(
        F.col("o_custkey").cast("int").alias("InvestorID"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("Name"),
        F.lit(59.5).alias("OwnershipPercentage"),
        F.lit("Person").alias("Type"),
    )

    def returns(share: float, after: int) -> F.Column:
        return F.struct(
            F.floor(amount * share).cast("double").alias("Amount"),
            F.lit(share * 100).alias("ROI"),
            (F.year("o_orderdate") + after).alias("Year"),
        )

    late = F.when(F.col("o_orderstatus") == "O", returns(0.125, 2))
    return orders.select(
        F.col("o_orderkey").alias("InvestmentID"),
        F.col("o_orderstatus").alias("Status"),
        amount.alias("Amount"),
        F.struct(F.array_compact(F.array(first, other)).alias("Investor")).alias("Investors"),
        F.array_compact(F.array(returns(0.0625, 1), late)).alias("Returns"),
    )


def parcel_responses(events: DataFrame) -> DataFrame:
    """One landed response per parcel event, with one or two events in it."""
    parcel, price = F.col("parcl_property_id"), F.col("price")
    day = F.when(price % 50 == 0, F.lit("unknown")).otherwise(F.col("event_day").cast("string"))

    def event(name: F.Column, owner: F.Column, amount: F.Column) -> F.Column:
        return F.struct(
            F.col("event_type").alias("event_type"),
            name.alias("event_name"),
            day.alias("event_date"),
            owner.alias("entity_owner_name"),
            amount.cast("double").alias("price"),
        )

    second = F.when(
        price % 2 == 0, event(F.lit("PRICE CHANGE"), F.lit(None).cast("string"), price / 2)
    )
    owner = F.concat(F.lit("Owner "), F.col("event_id").cast("string"))
    return events.select(
        "parcl_property_id",
        (parcel % 6 + 1).cast("int").alias("bedrooms"),
        (parcel % 4 + 0.5).alias("bathrooms"),
        (600 + parcel % 44 * 100).cast("int").alias("square_footage"),
        (1950 + parcel % 74).cast("int").alias("year_built"),
        F.concat(parcel.cast("string"), F.lit(" Main Street")).alias("address"),
        F.concat(F.lit("City "), (parcel % 25).cast("string")).alias("city"),
        F.lit("TX").alias("state_abbreviation"),
        F.concat(F.lit("County "), (parcel % 5).cast("string")).alias("county"),
        F.lpad((parcel % 20).cast("string"), 5, "0").alias("zip_code"),
        (price / 7).alias("latitude"),
        (-price / 7).alias("longitude"),
        F.array_compact(F.array(event(F.col("event_name"), owner, price), second)).alias("events"),
    )


# The events that flattening the responses above must give.
FLATTENED_SQL = """
    SELECT parcl_property_id, event_id, pos AS event_pos,
           CAST(parcl_property_id % 6 + 1 AS INT) AS prop_attr_br_cnt,
           CAST(CEIL(parcl_property_id % 4 + 0.5) AS INT) AS prop_attr_bth_cnt,
           CAST(600 + parcl_property_id % 44 * 100 AS INT) AS prop_attr_sqft_nr,
           CAST(1950 + parcl_property_id % 74 AS INT) AS prop_yr_blt_nr,
           LPAD(CAST(parcl_property_id % 20 AS VARCHAR), 5, '0') AS prop_zip_cd,
           CAST(CAST(CAST(price AS DOUBLE) / 7 AS VARCHAR) AS DECIMAL(9,6)) AS prop_latitude_val,
           event_type AS prop_acty_status_cd,
           CASE pos WHEN 0 THEN event_name ELSE 'PRICE CHANGE' END AS prop_acty_sub_status_cd,
           CASE WHEN price % 50 = 0 THEN NULL ELSE event_day END AS prop_sale_dt,
           CASE pos WHEN 0 THEN 'Owner ' || CAST(event_id AS VARCHAR) END AS investor_company_nm_txt,
           CASE pos WHEN 0 THEN CAST(price AS DOUBLE) ELSE CAST(price AS DOUBLE) / 2 END AS prop_sale_amt
    FROM parcel_event, (VALUES (0), (1)) AS places(pos)
    WHERE pos = 0 OR price % 2 = 0
"""
