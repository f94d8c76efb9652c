"""De-duplication whose memory is state of the stream, not the table it writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from acreage.operators.changes import spread_null_keys
from acreage.session import settings
from acreage.streaming.ingest import landed

ARRIVED = "arrived_ts"

# Keys are kept on the executors' disks, with a fixed amount of memory for all of an executor's
# partitions: maps of them, as the default store keeps, grow with the keys until no heap holds them.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def unseen_within(rows: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """The rows of a stream whose key has not come within ``delay`` before, with ``arrived_ts``.

    Keys are remembered in the state store for that long after they came and then dropped, so the
    state is as large as what lands in such a time, whatever the sink has grown to. The clock is that
    of the micro-batch, which its log keeps: no row is ever too late for it, and a batch that is
    run again sees the same time. Rows whose key has a NULL are told apart by all their columns.
    """
    timed = spread_null_keys(rows, keys).withColumn(ARRIVED, F.current_timestamp())
    return timed.withWatermark(ARRIVED, delay).dropDuplicatesWithinWatermark([*keys, "_spread"]).drop("_spread")


def ingest_unseen(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    keys: Sequence[str],
    sink: str,
    checkpoint: str,
    delay: str = "30 days",
    *,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append to ``sink`` every landed row whose key has not landed within ``delay``, then stop.

    The sink's own log says which files of it were committed, so a batch that fails half-way leaves
    nothing that ``spark.read.parquet(sink)`` shows. The sink itself is never read. What
    ``streaming.ingest`` does for all time this does for a stated one: a key that lands again
    later than that is taken once more. State is kept as ``STATE_STORE`` says; a checkpoint that was
    begun with another store goes on with that one.
    """
    stream = landed(spark, folder, schema, file_format, files_per_batch, bytes_per_batch, options)
    writer = (
        unseen_within(stream, keys, delay)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    with settings(spark, STATE_STORE):
        return writer.start()
