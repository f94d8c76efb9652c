from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from acreage.operators.changes import insert_new, one_per_key
from acreage.sources.writers import path_exists

STREAM, BATCH = "ingest_stream", "ingest_nr"


def insert_new_into(
    sink: str, schema: T.StructType, keys: Sequence[str], stream: str, order: Sequence[str] = ()
) -> Callable[[DataFrame, int], None]:
    """A batch function that appends the rows whose key no earlier batch has brought.

    Each batch owns one folder and overwrites it, and looks only at the folders before its own.
    Of rows with the same key the first by ``order`` and then by content is taken, so running a
    batch again after a failure gives the same table.

    ``stream`` says whose batches these are, such as the place of the checkpoint: its folders lie
    under that name's hash. A stream whose checkpoint was lost numbers from 0 again under a new
    name, and what an earlier one wrote is kept and looked at like any earlier batch.
    """
    stored = T.StructType([*schema.fields, T.StructField(STREAM, T.StringType()), T.StructField(BATCH, T.LongType())])
    own = hashlib.sha256(stream.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, sink):
            # Other streams' rows were there first: a stream is one writer's at a time.
            mine = (F.col(STREAM) == own) & (F.col(BATCH) >= number)
            earlier = spark.read.schema(stored).parquet(sink).where(~mine)
            rows = insert_new(one_per_key(batch, keys, order), earlier, keys)
        else:
            rows = one_per_key(batch, keys, order)
        rows.write.mode("overwrite").parquet(f"{sink}/{STREAM}={own}/{BATCH}={number}")

    return write


def landed(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The files that land in a folder as a stream, so many or so much of them at a time."""
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(folder)


def incremental_ingest(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    merge: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Hand every file that has landed since the last run to ``merge``, then stop.

    The checkpoint remembers which files are done, so a run without new files does nothing.
    """
    return (
        landed(spark, folder, schema, file_format, files_per_batch, bytes_per_batch, options)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
