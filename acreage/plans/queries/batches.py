from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.operators import keys
from acreage.operators.changes import arrivals, change_feed, deleted_for_good
from acreage.plans import views
from acreage.plans.registry import query

KEYS = ", ".join(views.SALE_KEY)


@query(
    views.sql_with(
        "sales",
        then="""SELECT COALESCE(MAX(etl_nr), 0) AS etl_nr, COALESCE(MAX(l_orderkey), 0) AS l_orderkey
                FROM sales""",
    )
)
def high_water_mark(spark: SparkSession, folder: str) -> DataFrame:
    return keys.high_water_mark(views.sales(spark, folder), ["etl_nr", "l_orderkey"])


@query(
    views.sql_with(
        "sales",
        then=f"SELECT {KEYS}, etl_nr FROM sales WHERE etl_nr = (SELECT MAX(etl_nr) FROM sales)",
    )
)
def latest_batch_scan(spark: SparkSession, folder: str) -> DataFrame:
    return keys.latest_batch(views.sales(spark, folder)).select(*views.SALE_KEY, "etl_nr")


def two_states(spark: SparkSession, folder: str) -> list[DataFrame]:
    """What each investor bought before a day, and since: together all sales."""
    sales, early = views.sales(spark, folder), F.col("prop_last_sale_dt") < STATE_DAY
    return [
        part.groupBy("investor_company_nm_txt").agg(
            F.count("*").alias("n_sales"),
            F.max("prop_last_sale_amt").alias("top_amt"),
            F.nullif(F.min("prop_attr_br_cnt"), F.lit(1)).alias("min_beds"),
        )
        for part in (sales.where(early), sales.where(~early))
    ]


STATE_DAY = "1998-06-01"
STATE_SQL = """
    SELECT investor_company_nm_txt, COUNT(*) AS n_sales, MAX(prop_last_sale_amt) AS top_amt,
           NULLIF(MIN(prop_attr_br_cnt), 1) AS min_beds
    FROM sales WHERE prop_last_sale_dt {when} DATE '{day}'
    GROUP BY investor_company_nm_txt
"""
STATES_SQL = f"""
    before AS ({STATE_SQL.format(when="<", day=STATE_DAY)}),
    later AS ({STATE_SQL.format(when=">=", day=STATE_DAY)}),
    paired AS (SELECT b.investor_company_nm_txt AS bk, l.investor_company_nm_txt AS lk, b.n_sales AS bn,
                      l.n_sales AS ln, b.top_amt AS bt, l.top_amt AS lt, b.min_beds AS bm, l.min_beds AS lm
               FROM before b FULL OUTER JOIN later l ON b.investor_company_nm_txt = l.investor_company_nm_txt),
    differing AS (SELECT * FROM paired WHERE bn IS DISTINCT FROM ln OR bt IS DISTINCT FROM lt
                                          OR bm IS DISTINCT FROM lm)
"""


@query(
    views.sql_with(
        "sales",
        then=f""", {STATES_SQL}
        SELECT bk AS investor_company_nm_txt, bn AS n_sales, bt AS top_amt, bm AS min_beds,
               CASE WHEN lk IS NULL THEN 'delete' ELSE 'update_preimage' END AS change_type
        FROM differing WHERE bk IS NOT NULL
        UNION ALL
        SELECT lk, ln, lt, lm, CASE WHEN bk IS NULL THEN 'insert' ELSE 'update_postimage' END
        FROM differing WHERE lk IS NOT NULL""",
    )
)
def change_feed_diff(spark: SparkSession, folder: str) -> DataFrame:
    before, later = two_states(spark, folder)
    feed = change_feed(before, later, ["investor_company_nm_txt"])
    return feed.withColumnRenamed("_change_type", "change_type")


@query(
    views.sql_with(
        "sales",
        then=f""", {STATES_SQL}
        SELECT 'arrived' AS outcome, lk AS investor_company_nm_txt, ln AS n_sales
        FROM differing WHERE lk IS NOT NULL
        UNION ALL SELECT 'gone', bk, bn FROM differing WHERE lk IS NULL""",
    )
)
def change_type_filter(spark: SparkSession, folder: str) -> DataFrame:
    before, later = two_states(spark, folder)
    feed = change_feed(before, later, ["investor_company_nm_txt"])
    shown = ["investor_company_nm_txt", "n_sales"]
    return (
        arrivals(feed)
        .select(F.lit("arrived").alias("outcome"), *shown)
        .unionByName(deleted_for_good(feed).select(F.lit("gone").alias("outcome"), *shown))
    )


@query(
    views.sql_with(
        "sales",
        then=f"""SELECT {KEYS}, 1000 + ROW_NUMBER() OVER (ORDER BY {KEYS}) AS sale_sk FROM sales""",
    )
)
def dense_surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.sales(spark, folder).select(*views.SALE_KEY)
    return keys.dense_surrogate_key(rows, "sale_sk", 1000, views.SALE_KEY)
