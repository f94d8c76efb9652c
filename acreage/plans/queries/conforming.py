from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.functions.columns import (
    activity_flag,
    address_key,
    equity,
    geo_quantize,
    gross_yield,
    iso_time,
    known_activity,
    months_back,
    whole_baths,
)
from acreage.operators.changes import insert_new
from acreage.operators.conform import (
    conform,
    distinct_addresses,
    row_counts,
    split_good_bad,
    trailing_months,
    with_audit,
)
from acreage.plans import views
from acreage.plans.jobs import silver_rows
from acreage.plans.queries.feeds import CONFORMED_SQL, SALE_ID_SQL, sale_id, sales_feed
from acreage.plans.registry import plain, query
from acreage.schemas import REQUIRED_SALE_COLUMNS, SALES_COLUMNS, SALES_MAPPING
from acreage.sources.writers import stored

KEYS = ", ".join(views.SALE_KEY)
ADDRESS_SQL = "prop_address_line_txt || '/' || prop_city_nm || '/' || prop_state_nm || '/' || prop_zip_cd"
GAPPED_SQL = "SELECT * REPLACE (NULLIF(prop_zip_cd, '00007') AS prop_zip_cd) FROM sales"
COMPLETE_SQL = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_SALE_COLUMNS)
SHOWN_SQL = ", ".join(
    "CAST(prop_last_sale_dt AS VARCHAR) AS prop_last_sale_dt" if c == "prop_last_sale_dt" else c
    for c in SALES_COLUMNS
)


def gapped_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales with one ZIP missing."""
    return views.sales(spark, folder).withColumn("prop_zip_cd", F.nullif("prop_zip_cd", F.lit("00007")))


@query(
    views.sql_with(
        "sales",
        then=f"""SELECT {SHOWN_SQL}, CAST(YEAR(prop_last_sale_dt) AS INT) AS year
                 FROM ({CONFORMED_SQL})""",
    )
)
def conform_rename_cast(spark: SparkSession, folder: str) -> DataFrame:
    rows = conform(sales_feed(views.sales(spark, folder)), SALES_MAPPING)
    return plain(rows.withColumn("year", F.year("prop_last_sale_dt")))


@query(
    views.sql_with(
        "sales",
        then=f"""SELECT {KEYS}, '2001-08-01' AS load_date_dt, CAST(7 AS BIGINT) AS etl_nr,
                        '2001-08-01 00:00:00' AS etl_recorded_gmts,
                        '2001-08-01 00:00:00' AS record_inserted_ts
                 FROM sales""",
    )
)
def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    return plain(with_audit(views.sales(spark, folder).select(*views.SALE_KEY), views.AS_OF, 7))


@query(views.sql_with("sales", then=f"SELECT {KEYS}, {ADDRESS_SQL} AS address_key FROM ({GAPPED_SQL})"), name="address_key")
def address_keys(spark: SparkSession, folder: str) -> DataFrame:
    return gapped_sales(spark, folder).select(*views.SALE_KEY, address_key().alias("address_key"))


@query(
    """SELECT event_id, CAST(CEIL(value / 100) AS INT) AS baths,
              CAST(CAST(CAST(value / 7 AS VARCHAR) AS DECIMAL(9,6)) AS VARCHAR) AS latitude,
              CAST(CAST(CAST(-value / 7 AS VARCHAR) AS DECIMAL(9,6)) AS VARCHAR) AS longitude,
              UPPER(event_type) AS event_type, STRFTIME(ts::TIMESTAMP, '%Y-%m-%dT%H:%M:%S.%f') AS taken_at
       FROM events""", name="geo_quantize")
def geo_quantized(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return plain(
        views.base(spark, folder, "events").select(
            "event_id",
            whole_baths(value / 100).alias("baths"),
            geo_quantize(value / 7).alias("latitude"),
            geo_quantize(-value / 7).alias("longitude"),
            F.upper("event_type").alias("event_type"),
            iso_time(F.col("ts")).alias("taken_at"),
        )
    )


@query(
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
              CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS half_year_back
       FROM orders""", name="months_back")
def months_before(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return plain(
        views.base(spark, folder, "orders").select(
            "o_orderkey", day.alias("day"), months_back(day, 6).alias("half_year_back")
        )
    )


@query(
    """SELECT *, round(CAST(monthly_rent * 12 AS DOUBLE) / est_value * 100, 2) AS gross_yield,
              round(est_value - sale_amount, 2) AS est_equity
       FROM (SELECT *, CAST(FLOOR(est_value * 0.0075) AS INT) AS monthly_rent
             FROM (SELECT o_orderkey, o_totalprice AS sale_amount,
                          CAST(FLOOR(o_totalprice * 1.25) AS INT) AS est_value FROM orders))"""
)
def yield_metrics(spark: SparkSession, folder: str) -> DataFrame:
    value, rent = F.col("est_value"), F.col("monthly_rent")
    return (
        views.base(spark, folder, "orders")
        .select("o_orderkey", F.col("o_totalprice").alias("sale_amount"))
        .withColumn("est_value", F.floor(F.col("sale_amount") * 1.25).cast("int"))
        .withColumn("monthly_rent", F.floor(value * 0.0075).cast("int"))
        .withColumn("gross_yield", gross_yield(rent, value))
        .withColumn("est_equity", F.round(equity(value, F.col("sale_amount")), 2))
    )


@query(
    views.sql_with(
        "sales",
        then=f"SELECT {KEYS}, prop_zip_cd, investor_company_nm_txt FROM ({GAPPED_SQL}) WHERE {COMPLETE_SQL}",
    )
)
def good_records(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = split_good_bad(gapped_sales(spark, folder), REQUIRED_SALE_COLUMNS)
    return good.select(*views.SALE_KEY, "prop_zip_cd", "investor_company_nm_txt")


@query(
    views.sql_with(
        "sales",
        then=f"""SELECT {SHOWN_SQL} FROM
                 (SELECT DISTINCT {", ".join(SALES_COLUMNS)} FROM ({GAPPED_SQL}) WHERE NOT ({COMPLETE_SQL}))""",
    )
)
def bad_records(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = split_good_bad(gapped_sales(spark, folder).select(*SALES_COLUMNS), REQUIRED_SALE_COLUMNS)
    return plain(bad)


# A load that delivers a quarter again: what was sold before April is known already.
INSERT_NEW_SQL = f"""
    keyed AS (SELECT *, {ADDRESS_SQL} AS address_key FROM ({GAPPED_SQL})),
    known AS (SELECT DISTINCT investor_company_nm_txt, address_key FROM keyed
              WHERE prop_last_sale_dt < DATE '2001-04-01'),
    fresh AS (SELECT * FROM keyed b WHERE prop_last_sale_dt >= DATE '2001-01-01' AND NOT EXISTS
              (SELECT 1 FROM known k WHERE k.investor_company_nm_txt = b.investor_company_nm_txt
                                       AND k.address_key = b.address_key))
"""


@query(views.sql_with("sales", then=f", {INSERT_NEW_SQL} SELECT {KEYS}, address_key FROM fresh"))
def insert_new_only(spark: SparkSession, folder: str) -> DataFrame:
    keyed = gapped_sales(spark, folder).withColumn("address_key", address_key())
    keyed = stored(keyed.select(*views.SALE_KEY, "investor_company_nm_txt", "address_key", "prop_last_sale_dt"))
    day = F.col("prop_last_sale_dt")
    batch, target = keyed.where(day >= "2001-01-01"), keyed.where(day < "2001-04-01")
    new = insert_new(batch, target, ["investor_company_nm_txt", "address_key"])
    return new.select(*views.SALE_KEY, "address_key")


@query(
    views.sql_with(
        "sales",
        then=f""", {INSERT_NEW_SQL},
        gaps AS (SELECT DISTINCT {", ".join(SALES_COLUMNS)} FROM keyed
                 WHERE prop_last_sale_dt >= DATE '2001-01-01' AND NOT ({COMPLETE_SQL}))
        SELECT 'new' AS outcome, investor_company_nm_txt, prop_address_line_txt, prop_zip_cd,
               CAST(prop_last_sale_dt AS VARCHAR) AS prop_last_sale_dt, prop_last_sale_amt,
               CAST(YEAR(prop_last_sale_dt) AS INT) AS year
        FROM fresh WHERE {COMPLETE_SQL}
        UNION ALL
        SELECT 'quarantine', investor_company_nm_txt, prop_address_line_txt, prop_zip_cd,
               CAST(prop_last_sale_dt AS VARCHAR), prop_last_sale_amt, CAST(YEAR(prop_last_sale_dt) AS INT)
        FROM gaps""",
    )
)
def silver_sales_e2e(spark: SparkSession, folder: str) -> DataFrame:
    sales = stored(gapped_sales(spark, folder).withColumn("year", F.year("prop_last_sale_dt")))
    day = F.col("prop_last_sale_dt")
    new, bad = silver_rows(sales.where(day >= "2001-01-01"), sales.where(day < "2001-04-01"))
    shown = [
        "investor_company_nm_txt", "prop_address_line_txt", "prop_zip_cd", "prop_last_sale_dt",
        "prop_last_sale_amt", "year",
    ]
    return plain(
        new.select(F.lit("new").alias("outcome"), *shown).unionByName(
            bad.select(F.lit("quarantine").alias("outcome"), *shown)
        )
    )


@query(
    views.sql_with(
        "sales",
        then="""SELECT DISTINCT prop_address_line_txt, prop_city_nm, prop_state_nm, prop_zip_cd FROM sales""",
    ), name="distinct_addresses")
def address_list(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_addresses(views.sales(spark, folder))


@query(
    """SELECT COUNT(*) AS n_rows,
              (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_distinct_rows
       FROM lineitem"""
)
def row_and_distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return row_counts(views.base(spark, folder, "lineitem"))


@query(
    views.sql_with(
        "sales",
        then=f"""SELECT {KEYS}, CAST(prop_last_sale_dt AS VARCHAR) AS prop_last_sale_dt FROM sales
                 WHERE prop_last_sale_dt BETWEEN DATE '2000-08-01' AND DATE '2001-08-01'""",
    )
)
def trailing_12m_filter(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        trailing_months(views.sales(spark, folder), views.AS_OF).select(*views.SALE_KEY, "prop_last_sale_dt")
    )


@query(
    views.sql_with(
        "parcel_event",
        then="""SELECT event_id, event_type, price FROM
                (SELECT *, CASE WHEN price < 5 THEN NULL WHEN price > 100 THEN 'AUCTION' ELSE event_type END AS kind
                 FROM parcel_event) WHERE kind IN ('SALE', 'LISTING', 'RENTAL')""",
    )
)
def activity_filter(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("price")
    events = views.parcel_events(spark, folder).withColumn(
        "kind", F.when(price > 100, F.lit("AUCTION")).when(price >= 5, F.col("event_type"))
    )
    return events.where(known_activity(F.col("kind"))).select("event_id", "event_type", "price")


# Fixed values in the rule below: the sub-codes that each activity code accepts.
@query(
    views.sql_with(
        "sales",
        "parcel_event",
        then=f"""SELECT 'sale ' || {SALE_ID_SQL} AS id, COALESCE({{rule}}, FALSE) AS flag_info FROM
            (SELECT *, prop_acty_status_cd AS kind, prop_acty_sub_status_cd AS sub FROM sales)
        UNION ALL SELECT 'event ' || CAST(event_id AS VARCHAR), COALESCE({{rule}}, FALSE) FROM
            (SELECT event_id, event_type AS kind, REPLACE(NULLIF(event_name, 'OTHER'), ' ', '_') AS sub
             FROM parcel_event)""".format(
            rule="""(kind = 'SALE' AND sub IN ('SOLD', 'NON_ARMS_LENGTH_TRANSFER',
                'SOLD_INTER_PORTFOLIO_TRANSFER', 'NON_ARMS_LENGTH_INTRA_PORTFOLIO_TRANSFER'))
             OR (kind = 'LISTING' AND sub IN ('LISTED_SALE', 'LISTING_REMOVED', 'OTHER', 'PENDING_SALE',
                'PRICE_CHANGE', 'RELISTED'))
             OR (kind = 'RENTAL' AND sub IN ('LISTED_FOR_RENT', 'PRICE_CHANGE', 'DELISTED_FOR_RENT',
                'LISTED_RENT'))"""
        ),
    ), name="activity_flag")
def activity_flags(spark: SparkSession, folder: str) -> DataFrame:
    sales = views.sales(spark, folder).select(
        F.concat(F.lit("sale "), sale_id()).alias("id"),
        activity_flag(F.col("prop_acty_status_cd"), F.col("prop_acty_sub_status_cd")).alias("flag_info"),
    )
    events = views.parcel_events(spark, folder).select(
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("id"),
        activity_flag(F.col("event_type"), F.nullif("event_name", F.lit("OTHER"))).alias("flag_info"),
    )
    return sales.unionByName(events)
