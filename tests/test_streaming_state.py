"""Streams that remember keys in their state, and cells a feed loses."""

import time

from pyspark.sql import functions as F
from util import rows

from acreage.schemas import SALES_FEED
from acreage.sources.readers import read_sales_csv, read_sales_csv_checked
from acreage.streaming.dedup import ARRIVED, STATE_STORE, ingest_unseen

KV = "k long, v string"


def test_keys_are_remembered_over_restarts_and_the_sink_is_not_read(spark, tmp_path):
    landing, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    first = spark.range(100).select((F.col("id") % 60).alias("k"), F.lit("v").alias("v"))
    first.repartition(4).write.parquet(landing)

    def take_in(**how):
        query = ingest_unseen(spark, landing, first.schema, ["k"], sink, progress, files_per_batch=2, **how)
        query.awaitTermination()
        return query

    take_in()
    assert rows(spark.read.parquet(sink), "k", "v") == {(k, "v"): 1 for k in range(60)}
    # A new query from the same checkpoint: what landed before is dropped, though the data of the sink is gone.
    for part in (tmp_path / "out").glob("*.parquet"):
        part.write_text("not a table")
    spark.range(50, 70).select(F.col("id").alias("k"), F.lit("w").alias("v")).write.mode("append").parquet(landing)
    spark.createDataFrame([(None, "x"), (None, "y"), (None, "x")], KV).coalesce(1).write.mode("append").parquet(landing)
    query = take_in()
    fresh = [p for p in (tmp_path / "out").glob("*.parquet") if p.read_bytes() != b"not a table"]
    assert rows(spark.read.parquet(*map(str, fresh)), "k", "v") == {**{(k, "w"): 1 for k in range(60, 70)}, (None, "x"): 1, (None, "y"): 1}
    assert query.exception() is None


def test_the_state_holds_no_more_than_the_delay_brings(spark, tmp_path):
    landing, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    sizes = []
    for number in range(4):
        keys = spark.range(number * 100, number * 100 + 100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        keys.coalesce(1).write.mode("append").parquet(landing)
        query = ingest_unseen(spark, landing, keys.schema, ["k"], sink, progress, delay="1 second")
        query.awaitTermination()
        sizes.append(max((p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]), default=0))
        time.sleep(1.5)
    assert spark.read.parquet(sink).count() == 400 and max(sizes) <= 200, sizes
    assert spark.read.parquet(sink).select(ARRIVED).distinct().count() == 4


def test_keys_are_kept_on_disk_and_the_session_as_it_was(spark, tmp_path):
    landing, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    before = {key: spark.conf.get(key, "") for key in STATE_STORE}
    spark.range(50).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(landing)
    query = ingest_unseen(spark, landing, spark.read.parquet(landing).schema, ["k"], sink, progress)
    query.awaitTermination()
    (metrics,) = {tuple(p["stateOperators"][0]["customMetrics"]) for p in query.recentProgress if p["stateOperators"]}
    assert any(name.startswith("rocksdb") for name in metrics)
    assert {key: spark.conf.get(key, "") for key in STATE_STORE} == before


def test_cells_that_do_not_parse_are_listed(spark, tmp_path):
    names = [f.name for f in SALES_FEED]
    good = {n: "" for n in names} | {"APN": "a1", "Bedrooms": "3", "Last Sale Date": "2001-02-03", "Last Sale Amount": "5.5", "City": "St. \"Q\", TX"}
    lines = [good, good | {"APN": "a2", "Bedrooms": "n/a", "Last Sale Amount": "x,y"}, good | {"APN": "a3", "Year Built": "99999999999"}]

    def cell(text):
        return '"' + text.replace('"', '\\"') + '"' if any(c in text for c in ',"') else text

    written = [",".join(names)] + [",".join(cell(row[n]) for n in names) for row in lines]
    written.append(",".join(["short", "line"]))
    (tmp_path / "a.csv").write_text("\n".join(written) + "\n")
    frame, cells = read_sales_csv_checked(spark, str(tmp_path))
    assert frame.schema == read_sales_csv(spark, str(tmp_path)).schema and rows(frame) == rows(read_sales_csv(spark, str(tmp_path)))
    assert rows(cells.select("row.APN", "column_name", "kind", "cell", "file_name")) == {
        ("a2", "Bedrooms", "int", "n/a", "a.csv"): 1,
        ("a2", "Last Sale Amount", "double", "x,y", "a.csv"): 1,
        ("a3", "Year Built", "int", "99999999999", "a.csv"): 1,
        (None, None, None, None, "a.csv"): 1,
    }
    (tmp_path / "a.csv").write_text(written[0] + "\n")
    assert read_sales_csv_checked(spark, str(tmp_path))[1].isEmpty()
