"""The test tables seen as sales, properties and parcel events.

A table's name in braces is filled with a frame for Spark and with the name itself for the
SQL engine results are checked with; the rest of the text runs unchanged in both.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AS_OF = date(2001, 8, 1)
EARLIER = date(2000, 8, 1)
TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]

# A total order of the sales view.
SALE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _grade(code: str) -> str:
    return (
        f"CASE {code} % 5 WHEN 0 THEN 'Good' WHEN 1 THEN 'Average' WHEN 2 THEN 'Disrepair' "
        "WHEN 3 THEN 'Excellent' ELSE 'Poor' END"
    )


SALES = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
       c.c_name AS investor_company_nm_txt,
       CAST(o.o_orderdate AS DATE) AS prop_last_sale_dt,
       l.l_extendedprice AS prop_last_sale_amt,
       CAST(p.p_size % 6 + 1 AS INT) AS prop_attr_br_cnt,
       CAST(l.l_linenumber % 4 + 1 AS INT) AS prop_attr_bth_cnt,
       CAST(600 + l.l_quantity * 80 AS INT) AS prop_attr_sqft_nr,
       CAST(1950 + p.p_partkey % 74 AS INT) AS prop_yr_blt_nr,
       CAST(p.p_partkey AS STRING) || ' ' || p.p_name AS prop_address_line_txt,
       n.n_name AS prop_city_nm, r.r_name AS prop_state_nm, s.s_name AS prop_cnty_nm,
       LPAD(CAST(l.l_suppkey % 20 AS STRING), 5, '0') AS prop_zip_cd,
       {_grade("p.p_size")} AS prop_tlt_cnd_nm,
       {_grade("l.l_linenumber")} AS prop_int_cnd_nm,
       {_grade("CAST(l.l_quantity AS INT)")} AS prop_ext_cnd_nm,
       {_grade("l.l_suppkey")} AS prop_bth_cnd_nm,
       {_grade("l.l_orderkey")} AS prop_kth_cnd_nm,
       p.p_retailprice AS prop_list_price_amt,
       CASE l.l_returnflag WHEN 'A' THEN 'SALE' WHEN 'N' THEN 'LISTING' ELSE 'RENTAL' END AS prop_acty_status_cd,
       CASE WHEN l.l_linestatus = 'O' THEN 'OTHER' WHEN l.l_returnflag = 'A' THEN 'SOLD'
            WHEN l.l_returnflag = 'N' THEN 'PENDING_SALE' ELSE 'DELISTED_FOR_RENT' END AS prop_acty_sub_status_cd,
       CAST(YEAR(o.o_orderdate) - 1994 AS BIGINT) AS etl_nr
FROM {{lineitem}} l
JOIN {{orders}} o   ON l.l_orderkey = o.o_orderkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{part}} p     ON l.l_partkey = p.p_partkey
JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
JOIN {{nation}} n   ON s.s_nationkey = n.n_nationkey
JOIN {{region}} r   ON n.n_regionkey = r.r_regionkey
"""

PROPERTY = """
SELECT p_partkey AS slvr_int_prop_sk,
       CAST(p_size % 6 + 1 AS INT) AS prop_attr_br_cnt,
       CAST(CAST(SUBSTR(p_brand, 7) AS INT) % 4 + 1 AS INT) AS prop_attr_bth_cnt,
       CAST(600 + (p_partkey * 7919) % 4400 AS INT) AS prop_attr_sqft_nr,
       CAST(1950 + (p_partkey * 31) % 74 AS INT) AS prop_yr_blt_nr,
       LPAD(CAST(p_partkey % 20 AS STRING), 5, '0') AS prop_zip_cd,
       CASE p_partkey % 3 WHEN 0 THEN 'SALE' WHEN 1 THEN 'LISTING' ELSE 'RENTAL' END AS prop_acty_status_cd,
       p_retailprice AS prop_sale_amt
FROM {part}
"""

PARCEL_EVENT = """
SELECT event_id, user_id AS parcl_property_id, CAST(ts AS DATE) AS event_day, ts AS event_ts,
       CASE event_type WHEN 'purchase' THEN 'SALE' WHEN 'view' THEN 'LISTING' WHEN 'error' THEN 'LISTING' ELSE 'RENTAL' END AS event_type,
       CASE event_type WHEN 'purchase' THEN 'SOLD' WHEN 'view' THEN 'PENDING SALE' WHEN 'error' THEN 'OTHER'
                       WHEN 'signup' THEN 'DELISTED FOR RENT' ELSE 'LISTED FOR RENT' END AS event_name,
       CAST(FLOOR(value) AS INT) AS price
FROM {events}
"""

# The same joins for large tables: orders meet their buyers before the sales, which are then
# shuffled once less.
SALES_OF_LARGE = SALES.replace(
    "JOIN {orders} o   ON l.l_orderkey = o.o_orderkey\nJOIN {customer} c ON o.o_custkey = c.c_custkey\n",
    "JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey\n",
)
# Bytes of files from which on a table is large: joins shuffle it, so its rows are dealt anyway.
LARGE = 128 << 20

VIEWS = {"sales": SALES, "property": PROPERTY, "parcel_event": PARCEL_EVENT}


_LAYOUTS: dict[str, T.StructType] = {}


def base(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table. Its layout is read from the file once; every further use saves that job."""
    path = f"{folder}/{name}.parquet"
    if path not in _LAYOUTS:
        _LAYOUTS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_LAYOUTS[path]).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table for a query that writes or formats every row: its rows dealt over all cores if
    its files give fewer tasks than that. Tables of a cluster have files enough and stay put."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files a table is read from."""
    context = df.sparkSession.sparkContext
    paths = [context._jvm.org.apache.hadoop.fs.Path(name) for name in df.inputFiles()]
    return sum(p.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)


def _view(spark: SparkSession, folder: str, text: str, **dealt: DataFrame) -> DataFrame:
    tables = {n: base(spark, folder, n) for n in TABLE_NAMES if f"{{{n}}}" in text}
    return spark.sql(text, **(tables | dealt))


def many_sales(spark: SparkSession, folder: str) -> bool:
    return file_bytes(base(spark, folder, "lineitem")) >= LARGE


def sales(spark: SparkSession, folder: str, *, dealt: bool = False) -> DataFrame:
    """The sales; ``dealt`` spreads their rows as ``spread`` does, unless joins do."""
    if many_sales(spark, folder):
        return _view(spark, folder, SALES_OF_LARGE)
    return _view(spark, folder, SALES, **({"lineitem": spread(base(spark, folder, "lineitem"))} if dealt else {}))


def properties(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, PROPERTY)


def parcel_events(spark: SparkSession, folder: str) -> DataFrame:
    return _view(spark, folder, PARCEL_EVENT)


def sql_with(*names: str, then: str) -> str:
    """SQL text of a query over some of the views."""
    plain = {n: n for n in TABLE_NAMES}
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in names) + " " + then
