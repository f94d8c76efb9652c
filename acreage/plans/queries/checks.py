from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.operators import quality
from acreage.operators.integrity import ROW_COUNT, SCHEMA, check_integrity
from acreage.plans import views
from acreage.plans.registry import plain, query
from acreage.plans.queries.ingest import landed_xml
from acreage.session import fresh_path
from acreage.sources.writers import stored

# Customers with some segments missing, and line items whose number is not unique.
CUSTOMERS_SQL = "(SELECT * REPLACE (NULLIF(c_mktsegment, 'MACHINERY') AS c_mktsegment) FROM customer)"
ALLOWED = ["BUILDING", "HOUSEHOLD", "FURNITURE"]
ALLOWED_SQL = "c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD', 'FURNITURE')"
RANGE_SQL = "(c_acctbal < 0 OR c_acctbal > 9000)"
RULES = [
    {"rule_type": "not_null", "columns": ["c_mktsegment", "c_name"]},
    {"rule_type": "value_range", "column": "c_acctbal", "min": 0, "max": 9000},
    {"rule_type": "allowed_values", "column": "c_mktsegment", "allowed_values": ALLOWED},
    {"rule_type": "unique", "columns": ["c_nationkey", "c_mktsegment"]},
]
REPEATED_SQL = f"""(SELECT c_nationkey, c_mktsegment FROM {CUSTOMERS_SQL}
                    WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL
                    GROUP BY ALL HAVING COUNT(*) > 1)"""


def failure_sql(rule: str, column: str, value: str, detail: str, where: str, table: str = CUSTOMERS_SQL) -> str:
    detail = detail.replace("'", "''")
    return f"""SELECT c_custkey, '{rule}' AS rule_type, '{column}' AS failed_col_nm,
        {value} AS failed_col_value, '{detail}' AS failed_record_detail, c_name AS record_name
        FROM {table} WHERE {where}"""


NULL_SQL = failure_sql("not_null", "c_mktsegment", "CAST(NULL AS VARCHAR)", "Null in column c_mktsegment", "c_mktsegment IS NULL")
OUT_OF_RANGE_SQL = failure_sql("value_range", "c_acctbal", "CAST(c_acctbal AS VARCHAR)", "Value outside range [0, 9000]", RANGE_SQL)
DISALLOWED_SQL = failure_sql("allowed_values", "c_mktsegment", "c_mktsegment", "Disallowed value in column c_mktsegment", ALLOWED_SQL)
DUPLICATE_SQL = failure_sql(
    "unique",
    "c_nationkey,c_mktsegment",
    "CAST(c_nationkey AS VARCHAR) || ',' || c_mktsegment",
    "Duplicate on ['c_nationkey', 'c_mktsegment']",
    "TRUE",
    f"(SELECT * FROM {CUSTOMERS_SQL} SEMI JOIN {REPEATED_SQL} USING (c_nationkey, c_mktsegment))",
)
ALL_SQL = f"{NULL_SQL} UNION ALL {OUT_OF_RANGE_SQL} UNION ALL {DISALLOWED_SQL} UNION ALL {DUPLICATE_SQL}"
# With a unique rule that some customers break, as nearly every one breaks the other.
FEW_FAIL = [*RULES[:3], {"rule_type": "unique", "columns": ["c_nationkey", "c_balance_nr"]}]
FEW_DUPLICATES_SQL = failure_sql(
    "unique",
    "c_nationkey,c_balance_nr",
    "CAST(c_nationkey AS VARCHAR) || ',' || CAST(FLOOR(c_acctbal / 10) AS VARCHAR)",
    "Duplicate on ['c_nationkey', 'c_balance_nr']",
    """(c_nationkey, FLOOR(c_acctbal / 10)) IN
       (SELECT (c_nationkey, FLOOR(c_acctbal / 10)) FROM customer GROUP BY ALL HAVING COUNT(*) > 1)""",
)
FEW_FAIL_SQL = f"{NULL_SQL} UNION ALL {OUT_OF_RANGE_SQL} UNION ALL {DISALLOWED_SQL} UNION ALL {FEW_DUPLICATES_SQL}"
PASSING_SQL = f"SELECT c_custkey, c_name FROM {CUSTOMERS_SQL} WHERE c_custkey NOT IN (SELECT c_custkey FROM ({FEW_FAIL_SQL}))"
STORE_SQL = f"""SELECT rule_type AS outcome, 2 * COUNT(*) AS n_rows FROM ({FEW_FAIL_SQL}) GROUP BY rule_type
    UNION ALL SELECT 'distinct keys', 2 * COUNT(*) FROM ({FEW_FAIL_SQL})
    UNION ALL SELECT 'last key', 2 * COUNT(*) FROM ({FEW_FAIL_SQL})"""


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return views.base(spark, folder, "customer").withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY"))
    ).withColumn("c_balance_nr", F.floor(F.col("c_acctbal") / 10))


def shown(failures: DataFrame) -> DataFrame:
    """Failures with one field of the stored record in place of its text."""
    return failures.withColumn("record_name", F.get_json_object("failed_record", "$.c_name")).select(
        "c_custkey", "rule_type", "failed_col_nm", "failed_col_value", "failed_record_detail", "record_name"
    )


def failures_of(spark: SparkSession, folder: str, *rules: dict) -> DataFrame:
    return shown(quality.find_failures(customers(spark, folder), rules, "c_custkey"))


@query(NULL_SQL)
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return failures_of(spark, folder, RULES[0])


@query(OUT_OF_RANGE_SQL)
def dq_value_range(spark: SparkSession, folder: str) -> DataFrame:
    return failures_of(spark, folder, RULES[1])


@query(DISALLOWED_SQL)
def dq_allowed_values(spark: SparkSession, folder: str) -> DataFrame:
    return failures_of(spark, folder, RULES[2])


@query(
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
              CAST(l.l_orderkey AS VARCHAR) || ',' || CAST(l.l_linenumber AS VARCHAR) AS failed_col_value,
              'Duplicate on [''l_orderkey'', ''l_linenumber'']' AS failed_record_detail
       FROM lineitem l
       JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1) d
         ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber"""
)
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.base(spark, folder, "lineitem")
    rule = {"rule_type": "unique", "columns": ["l_orderkey", "l_linenumber"]}
    failures = quality.find_failures(rows, [rule], "l_partkey")
    record = {c: F.get_json_object("failed_record", f"$.{c}") for c in ("l_orderkey", "l_linenumber")}
    return failures.select(
        record["l_orderkey"].cast("bigint").alias("l_orderkey"),
        record["l_linenumber"].cast("int").alias("l_linenumber"),
        "l_partkey",
        "failed_col_value",
        "failed_record_detail",
    )


@query(ALL_SQL)
def dq_all_failures(spark: SparkSession, folder: str) -> DataFrame:
    return failures_of(spark, folder, *RULES)


@query(
    f"""SELECT 500 + ROW_NUMBER() OVER (ORDER BY c_custkey, rule_type, failed_col_nm) AS brnz_bd_rec_sk,
               'bronze.customers' AS tbl_nm, *, '2001-08-01' AS load_date, '2001-08-01 00:00:00' AS load_date_ts
        FROM ({ALL_SQL})"""
)
def dq_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    failures = quality.find_failures(customers(spark, folder), RULES, "c_custkey")
    stored = quality.quarantine(failures, "bronze.customers", views.AS_OF, 500, "c_custkey")
    return plain(
        stored.withColumn("record_name", F.get_json_object("failed_record", "$.c_name")).drop("failed_record")
    )


@query(PASSING_SQL)
def dq_filter_good(spark: SparkSession, folder: str) -> DataFrame:
    kept, _ = quality.check_quality(customers(spark, folder), FEW_FAIL, "bronze.customers", "c_custkey")
    return kept.select("c_custkey", "c_name")


def with_store(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    """Two runs on one bad-record table: what goes on, what it holds per rule, and its keys."""
    store = fresh_path(spark, "bad-records")
    for _ in range(2):
        kept, _ = quality.check_quality(
            customers(spark, folder), FEW_FAIL, "bronze.customers", "c_custkey", mode, as_of=views.AS_OF, bad_records=store
        )
    bad, key = spark.read.parquet(store), "brnz_bd_rec_sk"
    rows = bad.groupBy(F.col("rule_type").alias("outcome")).agg(F.count("*").alias("n_rows"))
    for outcome, df, value in (
        ("kept", kept, F.count("*")), ("distinct keys", bad, F.count_distinct(key)), ("last key", bad, F.coalesce(F.max(key), F.lit(0))),
    ):
        rows = rows.unionByName(df.agg(value.alias("n_rows")).withColumn("outcome", F.lit(outcome)))
    return rows


@query(
    f"""{STORE_SQL} UNION ALL SELECT 'kept', COUNT(*) FROM customer"""
)
def dq_stat(spark: SparkSession, folder: str) -> DataFrame:
    return with_store(spark, folder, "stat")


@query(
    f"""{STORE_SQL} UNION ALL SELECT 'kept', COUNT(*) FROM ({PASSING_SQL})"""
)
def dq_filter_and_stat(spark: SparkSession, folder: str) -> DataFrame:
    return with_store(spark, folder, "filter_and_stat")


def landed_orders(spark: SparkSession, folder: str) -> tuple[str, str, DataFrame]:
    """All orders as a CSV folder and as a table of the session, and the frame both were made from."""
    orders = views.base(spark, folder, "orders")
    landing = fresh_path(spark, "landing")
    orders.write.option("header", True).csv(landing)
    # A name of this call alone, so that two queries of a session do not meet.
    name = f"orders_{uuid.uuid4().hex}"
    stored(orders).createOrReplaceTempView(name)
    return landing, name, orders


@query(
    """SELECT 'match_row_count_with_xml_csv_table' AS rule, TRUE AS passed,
              'csv_rows=' || COUNT(*) || ', table_rows=' || COUNT(*) || ', xml_rows=' || COUNT(*) AS detail FROM orders
       UNION ALL
       SELECT 'match_row_count_with_xml_csv_table', COUNT(*) = COUNT(*) FILTER (o_orderstatus <> 'F'),
              'csv_rows=' || COUNT(*) || ', table_rows=' || COUNT(*) FILTER (o_orderstatus <> 'F') FROM orders"""
)
def integrity_row_count(spark: SparkSession, folder: str) -> DataFrame:
    """A table that agrees with a CSV and an XML landing, and one that lacks some of the rows."""
    landing, name, orders = landed_orders(spark, folder)
    orders.where("o_orderstatus <> 'F'").createOrReplaceTempView("acreage_open_orders")
    documents = {"xml_path": landed_xml(spark, folder), "row_tag": "Investment"}
    whole = check_integrity(spark, landing, name, [ROW_COUNT], **documents)
    return whole.unionByName(check_integrity(spark, landing, "acreage_open_orders", [ROW_COUNT]))


@query(
    """SELECT 'match_schema_between_existing_table_and_file' AS rule, TRUE AS passed,
              'same columns' AS detail, COUNT(*) AS n_rows FROM orders
       UNION ALL
       SELECT 'match_schema_between_existing_table_and_file', FALSE, 'columns differ', COUNT(*) FROM orders"""
)
def integrity_schema(spark: SparkSession, folder: str) -> DataFrame:
    landing, name, orders = landed_orders(spark, folder)
    outcome = check_integrity(spark, landing, name, [SCHEMA], file_schema=orders.schema)
    other = orders.withColumnRenamed("o_orderkey", "o_key").schema
    outcome = outcome.unionByName(check_integrity(spark, landing, name, [SCHEMA], file_schema=other))
    return outcome.withColumn("n_rows", spark.table(name).agg(F.count("*")).scalar())
