from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.functions.columns import named
from acreage.operators.keyfilter import FILTER, hit_batches, key_filter
from acreage.session import fresh_path, remove_folder, settings
from acreage.sources.widening import read_widened


# Tables are written once and read often; this takes a third less room than the default.
CODEC = {"compression": "zstd"}


def append_batch(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """The frame's rows from a table in the shared folder: what follows reads that table, and a
    lost executor costs only tasks, not everything the frame was made from."""
    path = fresh_path(df.sparkSession, "stored")
    df.write.options(**CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_if_any(df: DataFrame, path: str) -> bool:
    """Append unless there is nothing to append; tells whether it did."""
    if df.isEmpty():
        return False
    append_batch(df, path)
    return True


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may lack columns of the table or bring new ones."""
    append_batch(df, path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Every column any append has brought, NULL where an append lacked it."""
    return spark.read.option("mergeSchema", True).parquet(path)


def require_success_marks(spark: SparkSession) -> None:
    """Snapshots are told from half-written ones by their success mark, so it must not be off."""
    if spark.sparkContext._jsc.hadoopConfiguration().get("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true") != "true":
        raise RuntimeError("mapreduce.fileoutputcommitter.marksuccessfuljobs must be true: snapshots need their _SUCCESS mark")


def overwrite_snapshot(df: DataFrame, root: str) -> str:
    """Write a new snapshot beside the old ones and return its path.

    The frame may read the snapshot it replaces, and a reader of that one is not disturbed.
    """
    taken = [load.number for load in _loads_in(df.sparkSession, root, "v")]
    path = f"{root}/v={max(taken, default=-1) + 1:06d}"
    df.write.parquet(path)
    return path


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Paths of complete snapshots, oldest first; one a failed job left half-written is not."""
    return [f"{root}/{load.name}" for load in _loads_in(spark, root, "v") if load.whole]


@dataclass
class Load:
    """What one load wrote: its folder, the numbers in the names of the folders below, and whether
    it was committed."""

    name: str
    number: int
    marks: dict[str, int]
    whole: bool


def _loads_in(spark: SparkSession, root: str, kind: str) -> list[Load]:
    """The loads under ``root``, in folders named ``kind=number``, in order.

    A load's marks are folders in one another; the success mark lies where its rows begin.
    """
    require_success_marks(spark)
    out = []
    for name in _folders(spark, root):
        if not name.startswith(f"{kind}="):
            continue
        path, marks = f"{root}/{name}", {}
        while not (whole := path_exists(spark, f"{path}/_SUCCESS")):
            inner = [n for n in _folders(spark, path) if n.rsplit("=", 1)[1].isdigit()]
            if len(inner) != 1 or inner[0].startswith("year="):
                break
            key, value = inner[0].rsplit("=", 1)
            marks[key], path = int(value), f"{path}/{inner[0]}"
        out.append(Load(name, int(name[len(kind) + 1 :]), marks, whole))
    return out


def _folders(spark: SparkSession, path: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
    return sorted(n for n in names if "=" in n)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: Sequence[str] = ("year",),
    within: Sequence[str] = ("investor_company_nm_txt",),
    gather: bool = True,
) -> None:
    """Append with one folder per partition value and rows clustered by ``within`` in each file.

    Rebalancing gathers a small partition's rows in one file and splits a large one's over
    several tasks. With ``gather`` False rows are not shuffled for that: each task writes its own.
    Investors are a sort order, not folders: there are too many of them.
    """
    by = [named(c) for c in (*partition, *within)]
    (
        (df.hint("rebalance", *[named(c) for c in partition]) if gather else df)
        .sortWithinPartitions(*by)
        .write.mode("append")
        .options(**CODEC)
        .partitionBy(*partition)
        .parquet(path)
    )


def create_tables(
    spark: SparkSession, layouts: Mapping[str, T.StructType], root: str, prefix: str = ""
) -> list[str]:
    """Create every table empty under ``root``; an existing one is replaced.

    Names are ``schema.table``; ``prefix`` goes before the schema. Returns the full names.
    """
    created = []
    for name, layout in layouts.items():
        schema, table = name.split(".")
        schema = prefix + schema
        # Dropping a schema removes its folder: tables lie elsewhere.
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/_schemas/{schema}'")
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{table}")
        (
            spark.createDataFrame([], layout)
            .write.mode("overwrite")
            .option("path", f"{root}/{schema}/{table}")
            .saveAsTable(f"{schema}.{table}")
        )
        created.append(f"{schema}.{table}")
    return created


# Whole numbers that differ little from row to row take a few bits each; a task that writes all
# buckets at once keeps a row group of each in memory.
DELTAS = {**CODEC, "parquet.writer.version": "v2", "parquet.block.size": str(32 << 20)}


def write_bucketed(df: DataFrame, name: str, path: str, by: Sequence[str], buckets: int, gather: bool = True) -> DataFrame:
    """Write a table whose rows lie in ``buckets`` by the hash of ``by``, sorted by it, and read it.

    Two tables with as many buckets of the same key are joined and grouped by it bucket by bucket:
    neither is shuffled again, however often that is done. ``name`` is kept in the catalog, which knows
    about the buckets; the files lie in ``path``. Rows are dealt to their buckets before they are
    written, so each bucket is one file and not one per task. With ``gather`` False they are neither
    moved nor sorted: each task writes its rows, as they come, to a file per bucket.
    """
    keys = [named(c) for c in by]
    if gather:
        df.repartition(buckets, *keys).write.bucketBy(buckets, *by).sortBy(*by).option("path", path).mode("overwrite").saveAsTable(name)
    else:
        with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(buckets)}):
            df.write.bucketBy(buckets, *by).options(**DELTAS).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def forget_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Take tables made by ``create_tables`` and their schemas out of the catalog. Their files, which
    lie apart from the schemas' folders, stay; a schema with other tables stays too."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for schema in sorted({name.split(".")[0] for name in names}):
        if spark.sql(f"SHOW TABLES IN {schema}").where("NOT isTemporary").isEmpty():
            spark.sql(f"DROP SCHEMA IF EXISTS {schema}")


def path_exists(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


class Lake:
    """Parquet tables of one root folder, appended to in batches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def batches(self, table: str) -> list[int]:
        """The numbers of the table's committed batches."""
        return [load.number for load in _loads_in(self.spark, self.path(table), "batch") if load.whole]

    def read(self, table: str, layout: T.StructType, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of the table's committed batches, or none if nothing has been written yet.
        With ``only`` those of some batches; the folders of others are not opened."""
        loads = _loads_in(self.spark, self.path(table), "batch")
        done = [load.number for load in loads if load.whole]
        if not done:
            return self.spark.createDataFrame([], layout)
        half = [load.number for load in loads if not load.whole]
        stored = T.StructType([*layout.fields, T.StructField("batch", T.LongType())])
        # A batch that is being written while this is planned is beyond the last one.
        known = (F.col("batch") <= done[-1]) & ~F.col("batch").isin(half)
        if only is not None:
            known &= F.col("batch").isin(list(only))
        return self.spark.read.schema(stored).parquet(self.path(table)).where(known).select(*layout.names)

    def read_widened(self, table: str, layout: T.StructType | None = None) -> DataFrame:
        """The table's batches, whose columns may have other types in each: see ``widening``."""
        loads = [load for load in _loads_in(self.spark, self.path(table), "batch") if load.whole]
        marks = ["".join(f"/{name}={value}" for name, value in load.marks.items()) for load in loads]
        return read_widened(self.spark, [f"{self.path(table)}/{load.name}{inner}" for load, inner in zip(loads, marks)], layout)

    def keep_filter(self, table: str, rows: DataFrame, keys: Sequence[str], count: int) -> None:
        """Keep a filter of the keys of the table's last batch beside it: about ``count`` keys."""
        number = self.batches(table)[-1]
        self.append(f"{table}_keys", key_filter(rows, keys, number, count), FILTER, {"of": number})

    def rows_that_may_hold(self, table: str, layout: T.StructType, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The table's rows, without the batches that hold no key of ``rows`` according to the
        filters kept beside them. A batch whose filter was never written counts as one that may."""
        done = self.batches(table)
        if not done:
            return self.read(table, layout)
        filters = self.read(f"{table}_keys", FILTER)
        filtered = {row["of"] for row in filters.select("of").distinct().collect()} if self.exists(f"{table}_keys") else set()
        hit = hit_batches(filters, rows, keys) if filtered else set()
        empty = {load.marks["of"] for load in _loads_in(self.spark, self.path(f"{table}_keys"), "batch") if load.whole} - filtered
        return self.read(table, layout, [n for n in done if n in hit or n not in filtered | empty])

    def append(
        self,
        table: str,
        df: DataFrame,
        layout: T.StructType,
        marks: Mapping[str, int] | None = None,
        by: Sequence[str] = (),
        gather: bool = True,
    ) -> DataFrame:
        """Append a batch in the table's layout: columns by name, missing ones NULL.

        A batch is a folder with a success mark of its own: until that is written nothing of the
        batch is read, whatever a lost driver has moved there, and the next append replaces what
        is left. ``marks`` are numbers to remember with the batch, such as how far its source was
        read: they are names of folders around its rows and become columns where the layout has
        them. They are committed with the rows, and also if there are none. Rows go to a folder
        per year where the table has one, or per value of ``by``, so reading some batches or years
        leaves the other folders alone. With ``gather`` False rows stay in their tasks, each of which
        writes a file per year. A table is one writer's at a time.
        """
        marks, loads = marks or {}, _loads_in(self.spark, self.path(table), "batch")
        number = max((load.number for load in loads if load.whole), default=0) + 1
        for load in loads:
            if not load.whole and load.number >= number:
                remove_folder(self.spark, f"{self.path(table)}/{load.name}")
        path = f"{self.path(table)}/batch={number:06d}" + "".join(f"/{name}={value}" for name, value in marks.items())
        rows = fit(df, layout).drop(*marks)
        if "year" in layout.names:
            write_partitioned(rows, path, ["year"], ["investor_company_nm_txt"], gather)
        elif by:
            rows.hint("rebalance", *[named(c) for c in by]).write.mode("overwrite").options(**CODEC).partitionBy(*by).parquet(path)
        else:
            rows.write.mode("overwrite").options(**CODEC).parquet(path)
        return self.read(table, layout)

    def marks(self, table: str) -> dict[str, int]:
        """The numbers of the last committed load, its own among them; no file is opened."""
        for kind in ("batch", "v"):
            done = [load for load in _loads_in(self.spark, self.path(table), kind) if load.whole]
            if done:
                return ({"v": done[-1].number} if kind == "v" else {}) | done[-1].marks
        return {}

    def replace(self, table: str, df: DataFrame, layout: T.StructType) -> DataFrame:
        """Write the next snapshot of a table that is rewritten as a whole, and read it."""
        return self.spark.read.schema(layout).parquet(
            overwrite_snapshot(fit(df, layout), self.path(table))
        )

    def newest(self, table: str, layout: T.StructType) -> DataFrame:
        """The latest snapshot of such a table."""
        written = snapshots(self.spark, self.path(table))
        if not written:
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(written[-1])

    def advance(
        self,
        table: str,
        df: DataFrame,
        layout: T.StructType,
        still_open: Column,
        marks: Mapping[str, int] | None = None,
    ) -> DataFrame:
        """Write what one load makes of a table whose settled rows never change again.

        ``df`` holds the rows that were open before, the new ones, and nothing else. Those with
        ``still_open`` replace the open rows, the others join the settled ones, which no load
        reads or writes a second time. The folder's success mark is the commit: a load that
        failed half-way is not seen, and what it left is replaced when it runs again. ``marks`` are
        numbers to remember with the load, as in ``append``.
        """
        number = self._last(table) + 1
        folder = f"{self.path(table)}/v={number:06d}"
        remove_folder(self.spark, folder)
        rows = fit(df, layout).withColumn("open", F.coalesce(still_open, F.lit(False)))
        path = folder + "".join(f"/{name}={value}" for name, value in (marks or {}).items())
        rows.write.mode("overwrite").options(**CODEC).partitionBy("open").parquet(path)
        return self.state(table, layout)

    def state(self, table: str, layout: T.StructType) -> DataFrame:
        """All rows of such a table: the last load's open ones and every load's settled ones."""
        last = self._last(table)
        return self._loads(table, layout, (F.col("v") == last) | ((F.col("v") < last) & ~F.col("open")))

    def newest_load(self, table: str, layout: T.StructType) -> DataFrame:
        """What the last load of such a table wrote."""
        return self._loads(table, layout, F.col("v") == self._last(table))

    def open_rows(self, table: str, layout: T.StructType) -> DataFrame:
        return self._loads(table, layout, (F.col("v") == self._last(table)) & F.col("open"))

    def _last(self, table: str) -> int:
        return max((load.number for load in _loads_in(self.spark, self.path(table), "v") if load.whole), default=-1)

    def _loads(self, table: str, layout: T.StructType, wanted: Column) -> DataFrame:
        if self._last(table) < 0:
            return self.spark.createDataFrame([], layout)
        stored = T.StructType([*layout.fields, T.StructField("v", T.LongType()), T.StructField("open", T.BooleanType())])
        rows = self.spark.read.schema(stored).parquet(self.path(table)).where(wanted)
        return rows.select(*layout.names)


def fit(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Project onto a layout: columns by name and type, missing ones NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (named(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]
    )
