"""Tables over seven commits: their change feed, its net effect, and snapshots that come late."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.operators.distinct import SKETCH, STATED_ERROR, distinct_counts, sketches
from acreage.operators.feed import KIND, TIME, VERSION, net_changes
from acreage.operators.history import SEEN, scd2_splice
from acreage.plans import views
from acreage.plans.registry import query
from acreage.session import fresh_path
from acreage.sources.changelog import ChangeLog
from acreage.sources.writers import Lake, stored

KEY = "investor_company_nm_txt"
COMMITS = 7
# The range that is read: not from the first commit and not to the last.
FIRST, LAST = 2, 5
STATE = ["n_sales", "top_amt", "min_beds"]
YEARS_SQL = """
    state AS (SELECT etl_nr - 1 AS v, investor_company_nm_txt AS k, COUNT(*) AS n_sales, MAX(prop_last_sale_amt) AS top_amt,
                     NULLIF(MIN(prop_attr_br_cnt), 1) AS min_beds
              FROM sales GROUP BY ALL)
"""
FEED_SQL = f"""
    {YEARS_SQL},
    paired AS (SELECT COALESCE(a.v, b.v) AS v, b.k AS bk, a.k AS ak, b.n_sales AS bn, a.n_sales AS an, b.top_amt AS bt,
                      a.top_amt AS nt, b.min_beds AS bm, a.min_beds AS am
               FROM state a FULL OUTER JOIN (SELECT v + 1 AS v, * EXCLUDE (v) FROM state) b ON a.v = b.v AND a.k = b.k),
    differing AS (SELECT * FROM paired WHERE v BETWEEN {FIRST} AND {LAST}
                  AND (bn IS DISTINCT FROM an OR bt IS DISTINCT FROM nt OR bm IS DISTINCT FROM am))
"""


def yearly(spark: SparkSession, folder: str) -> DataFrame:
    """What each investor bought in each year, with the year's number."""
    rows = views.sales(spark, folder).groupBy("etl_nr", KEY).agg(
        F.count("*").alias("n_sales"),
        F.max("prop_last_sale_amt").alias("top_amt"),
        F.nullif(F.min("prop_attr_br_cnt"), F.lit(1)).alias("min_beds"),
    )
    return stored(rows)


def investor_log(spark: SparkSession, folder: str) -> ChangeLog:
    """A lake whose table of investors went from year to year in seven commits."""
    years = yearly(spark, folder)
    state = years.drop("etl_nr")
    log = ChangeLog(Lake(spark, fresh_path(spark, "lake")), "silver.investor_years", state.schema, [KEY])
    for number in range(1, COMMITS + 1):
        before, now = (years.where(F.col("etl_nr") == n).drop("etl_nr") for n in (number - 1, number))
        log.commit(before, now, datetime(1994 + number, 1, 1))
    return log


def shown(feed: DataFrame) -> DataFrame:
    return feed.select(
        KEY, *STATE, F.col(KIND).alias("change_type"), F.col(VERSION).alias("commit_version"), F.col(TIME).cast("string").alias("commit_timestamp")
    )


MOMENT = "CAST(1995 + v AS VARCHAR) || '-01-01 00:00:00'"


@query(
    views.sql_with(
        "sales",
        then=f""", {FEED_SQL}
        SELECT bk AS {KEY}, bn AS n_sales, bt AS top_amt, bm AS min_beds,
               CASE WHEN ak IS NULL THEN 'delete' ELSE 'update_preimage' END AS change_type, v AS commit_version, {MOMENT} AS commit_timestamp
        FROM differing WHERE bk IS NOT NULL
        UNION ALL
        SELECT ak, an, nt, am, CASE WHEN bk IS NULL THEN 'insert' ELSE 'update_postimage' END, v, {MOMENT} FROM differing WHERE ak IS NOT NULL""",
    )
)
def change_feed_range(spark: SparkSession, folder: str) -> DataFrame:
    """The changes of four commits in the middle of seven, chosen by version and by time at once."""
    return shown(investor_log(spark, folder).between(FIRST, since=datetime(1994, 1, 1), until=datetime(1995 + LAST, 6, 1)))


@query(
    views.sql_with(
        "sales",
        then=f""", {FEED_SQL},
        newest AS (SELECT COALESCE(ak, bk) AS k, MAX(v) AS v FROM differing GROUP BY ALL),
        net AS (SELECT b.k AS bk, a.k AS ak, b.n_sales AS bn, a.n_sales AS an, b.top_amt AS bt, a.top_amt AS nt, b.min_beds AS bm,
                       a.min_beds AS am, n.v
                FROM newest n LEFT JOIN (SELECT * FROM state WHERE v = {FIRST - 1}) b ON b.k = n.k
                LEFT JOIN (SELECT * FROM state WHERE v = {LAST}) a ON a.k = n.k
                WHERE b.n_sales IS DISTINCT FROM a.n_sales OR b.top_amt IS DISTINCT FROM a.top_amt OR b.min_beds IS DISTINCT FROM a.min_beds)
        SELECT bk AS {KEY}, bn AS n_sales, bt AS top_amt, bm AS min_beds,
               CASE WHEN ak IS NULL THEN 'delete' ELSE 'update_preimage' END AS change_type, v AS commit_version, {MOMENT} AS commit_timestamp
        FROM net WHERE bk IS NOT NULL
        UNION ALL
        SELECT ak, an, nt, am, CASE WHEN bk IS NULL THEN 'insert' ELSE 'update_postimage' END, v, {MOMENT} FROM net WHERE ak IS NOT NULL""",
    )
)
def net_change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """What those commits come to for each investor."""
    return shown(net_changes(investor_log(spark, folder).between(FIRST, LAST), [KEY]))


# Years in the order their snapshots come in.
ARRIVAL = (4, 2, 7, 1, 6, 3, 5)
TRACKED = ["active_flg", "min_beds"]
DIMENSION = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("active_flg", T.BooleanType()),
        T.StructField("min_beds", T.IntegerType()),
        T.StructField("active_rec_ind", T.BooleanType()),
        T.StructField("start_timestamp", T.TimestampType()),
        T.StructField("end_timestamp", T.TimestampType()),
        T.StructField(SEEN, T.ArrayType(T.DateType())),
    ]
)


@query(
    views.sql_with(
        "sales",
        then=f""", {YEARS_SQL},
        sightings AS (SELECT k, v, n_sales >= 2 AS active_flg, min_beds,
                      LAG(v) OVER by_key IS NULL OR LAG(n_sales >= 2) OVER by_key IS DISTINCT FROM (n_sales >= 2)
                      OR LAG(min_beds) OVER by_key IS DISTINCT FROM min_beds AS begins
                      FROM state WINDOW by_key AS (PARTITION BY k ORDER BY v)),
        islands AS (SELECT *, SUM(begins::INT) OVER (PARTITION BY k ORDER BY v) AS island FROM sightings),
        versions AS (SELECT k, island, active_flg, min_beds, MIN(v) AS v, COUNT(*) AS n FROM islands GROUP BY ALL),
        ended AS (SELECT *, LEAD(v) OVER (PARTITION BY k ORDER BY v) AS until FROM versions)
        SELECT k AS {KEY}, active_flg, min_beds, until IS NULL AS active_rec_ind, CAST(1995 + v AS VARCHAR) || '-01-01' AS start_day,
               CAST(1995 + until AS VARCHAR) || '-01-01' AS end_day, n AS n_seen FROM ended""",
    )
)
def scd2_late_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Seven yearly snapshots that come in another order than they were taken in."""
    years = yearly(spark, folder)
    dim = spark.createDataFrame([], DIMENSION)
    for year in ARRIVAL:
        snapshot = years.where(F.col("etl_nr") == year).select(KEY, (F.col("n_sales") >= 2).alias("active_flg"), "min_beds")
        dim = stored(scd2_splice(dim, snapshot, KEY, TRACKED, date(1994 + year, 1, 1)))
    day = lambda c: F.to_date(c).cast("string")
    return dim.select(
        KEY, *TRACKED, "active_rec_ind", day("start_timestamp").alias("start_day"), day("end_timestamp").alias("end_day"), F.size(SEEN).cast("long").alias("n_seen")
    )


COUNTED = [KEY, "prop_zip_cd", "prop_address_line_txt", "prop_last_sale_amt"]


@query(
    views.sql_with(
        "sales",
        then=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {COMMITS} AS n_batches, COUNT(*) AS n_rows, COUNT(DISTINCT {c}) AS exact, TRUE AS within_bound FROM sales"
            for c in COUNTED
        ),
    )
)
def distinct_over_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct values of seven batches from a sketch of each, held against the exact numbers."""
    lake, sales = Lake(spark, fresh_path(spark, "lake")), stored(views.sales(spark, folder).select("etl_nr", *COUNTED))
    for number in range(1, COMMITS + 1):
        batch = sales.where(F.col("etl_nr") == number)
        lake.append("silver.sketches", sketches(batch, COUNTED, number), SKETCH, {"of": number})
    kept = lake.read("silver.sketches", SKETCH)
    about = distinct_counts(kept).join(kept.groupBy("column_name").agg(F.count_distinct("of").cast("int").alias("n_batches")), "column_name")
    # Each column's distinct values are found by themselves, not by copying the rows for every column.
    exact = None
    for c in COUNTED:
        one = sales.select(c).distinct().agg(F.count(c).alias("exact")).withColumn("column_name", F.lit(c))
        exact = one if exact is None else exact.unionByName(one)
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= F.ceil(F.col("exact") * STATED_ERROR)
    return about.join(exact, "column_name").select("column_name", "n_batches", "n_rows", "exact", off.alias("within_bound"))
