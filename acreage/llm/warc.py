"""Web archives: records written as they come, normalised to one gzip member each, and read by offset."""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.session import fresh_path
from acreage.sources.writers import stored

# Payloads from this size on are stored once; later equal ones refer to the first.
LEAST_REVISIT_BYTES = 100
# Records of one archive file, which bounds what one task of the normaliser gets.
RECORDS_PER_FILE = 10_000
# Bytes of a compressed stream that are inflated at a time.
STEP = 1 << 20
BREAK = "\r\n"
# Tasks that read archives; each archive is read by one.
MOST_TASKS = 10_000
# Fixed values of the archive format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2000-01-01T00:00:00Z"


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` with digest, size, ``record_type`` and ``refers_to``.

    A NULL page is an empty payload. Of equal payloads of LEAST_REVISIT_BYTES or more, the
    smallest ``page_id`` is the response; rows that repeat that id are responses too. Rows without
    an id refer to one with an id if there is one. Only digests that occur twice are joined, and
    they are counted before the shuffle, so a page that is a third of the input is no burden.
    """
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("payload")
    ).withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "size": F.octet_length("payload")})
    first = (
        rows.where(F.col("size") >= LEAST_REVISIT_BYTES)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .where((F.col("_n") > 1) & F.col("_first").isNotNull())
    )
    first = stored(first.drop("_n"))
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(first, rows["digest"] == first["_digest"], "left").select(
        *rows.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"),
    )


def record(row: DataFrame) -> Column:
    """A record as text, without the two line breaks that end it."""
    http = F.concat_ws(
        BREAK,
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.col("size").cast("string")),
        F.lit(BREAK),
    )
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit("")))

    def identity(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("none")), F.lit(">"))

    def when_revisit(value: Column) -> Column:
        return F.when(F.col("record_type") == "revisit", value)

    head = F.concat_ws(
        BREAK,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), identity("page_id")),
        F.lit(f"WARC-Date: {RECORD_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        when_revisit(F.concat(F.lit("WARC-Refers-To: "), identity("refers_to"))),
        when_revisit(F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(BREAK * 2), block)


def write(pages: DataFrame, folder: str) -> None:
    """Archives of the pages, each file one gzip stream, as a crawler that does not care leaves them.

    The text writer puts its line separator after each row: here the breaks that end a record.
    """
    rows = with_revisits(pages)
    (
        rows.select(record(rows).alias("value"))
        .write.option("compression", "gzip")
        .option("lineSep", BREAK * 2)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """A gzip stream's content in steps, whether it is one member or many; no step is larger than
    STEP, however well it was packed."""
    stream = zlib.decompressobj(31)
    for data in chunks:
        while data:
            yield stream.decompress(data, STEP)
            data = stream.unconsumed_tail or stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)
    yield stream.flush()


def records(content: bytes | Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Head and block of each record of an archive, whole or in chunks; holds one record at a time."""
    held = bytearray()
    steps, more = inflated([content] if isinstance(content, bytes) else content), True
    head, need, sought = b"", -1, 0
    while more or held:
        if need < 0:
            end = held.find(b"\r\n\r\n", max(0, sought - 3))
            if end >= 0:
                head = bytes(held[:end])
                del held[: end + 4]
                need, sought = int(fields(head)[1]["content-length"]) + 4, 0
            else:
                sought = len(held)
        if 0 <= need <= len(held):
            yield head, bytes(held[: need - 4])
            del held[:need]
            need = -1
            continue
        try:
            held += next(steps)
        except StopIteration:
            if held or need >= 0:
                raise ValueError("the archive ends within a record") from None
            more = False


def chunks_of(stream) -> Iterator[bytes]:
    while data := stream.read(STEP):
        yield data


def fields(head: bytes) -> tuple[str, dict[str, str]]:
    """The first line of a head, and its fields by name in lower case."""
    first, *lines = head.decode().split(BREAK)
    return first, {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def normalise(source: str, target: str, spark) -> DataFrame:
    """Rewrite whole-stream archives with a gzip member per record; one row per archive written.

    Each file is read and inflated once, from start to end and in steps, so an archive of any size
    takes the memory of its largest record; it is one task, as a whole stream cannot be entered in the
    middle. Beside each archive goes a sidecar with a line
    per record: offset and length of its member, its id and type. File names are new in each
    attempt, and only archives named in the returned table count, so a task that runs twice does
    no harm. ``target`` is a folder that every executor reaches.
    """
    # Paths alone: contents are not read here, nor bound by the size of a row.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(target)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                origin, place = fs.FileSystem.from_uri(path)
                name = f"{root}/{uuid.uuid4().hex}"
                count = at = 0
                with (
                        origin.open_input_stream(place, compression=None) as stream,
                        store.open_output_stream(f"{name}.warc.gz", compression=None) as archive,
                        store.open_output_stream(f"{name}.idx", compression=None) as index,
                    ):
                    for head, block in records(chunks_of(stream)):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(head + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()
                        archive.write(member)
                        _, names = fields(head)
                        entry = {"offset": at, "length": len(member), "id": names["warc-record-id"], "type": names["warc-type"]}
                        index.write(json.dumps(entry).encode() + b"\n")
                        at += len(member)
                        count += 1
                yield pa.RecordBatch.from_pydict(
                    {"archive": [f"{name}.warc.gz"], "sidecar": [f"{name}.idx"], "records": [count], "bytes": [at]}
                )

    _create_folder(spark, target)
    return stored(files.mapInArrow(run, "archive string, sidecar string, records long, bytes long"))


def _create_folder(spark, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def page_number(identity: str | None) -> int | None:
    number = (identity or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def read(archives: DataFrame, target: str) -> DataFrame:
    """The records of normalised archives, each member found by its offset in the sidecar.

    ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload`` (NULL for a revisit) and
    ``digest``. A response whose payload does not have the digest it claims fails the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(target)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(row["sidecar"]) as sidecar, store.open_input_file(row["archive"]) as archive:
                    rows, held = [], 0
                    for entry in map(json.loads, io.BufferedReader(sidecar)):
                        content = zlib.decompress(archive.read_at(entry["length"], entry["offset"]), 31)
                        rows.append(_page(content))
                        held += len(content)
                        if held > STEP * 8:
                            yield pa.RecordBatch.from_pylist(rows, PAGE)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, PAGE)

    return archives.mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, digest string, payload binary"
    )


PAGE = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("digest", pa.string()), ("payload", pa.binary()),
    ]
)


def _page(content: bytes) -> dict:
    head, _, block = content[:-4].partition(b"\r\n\r\n")
    _, names = fields(head)
    digest = names["warc-payload-digest"].removeprefix("sha256:")
    payload = None
    if names["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {names['warc-record-id']} is not what its digest says")
    return {
        "page_id": page_number(names["warc-record-id"]),
        "url": names.get("warc-target-uri"),
        "record_type": names["warc-type"],
        "refers_to": page_number(names.get("warc-refers-to")),
        "digest": digest,
        "payload": payload,
    }


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, normalise the archives and read them back: one row per page.

    A revisit takes its size from the responses with the same payload digest in the archives.
    An empty table gives no rows.
    """
    spark = pages.sparkSession
    whole, members = fresh_path(spark, "warc-streams"), fresh_path(spark, "warc-members")
    write(pages, whole)
    archives = normalise(whole, members, spark)
    tasks = max(1, min(archives.count(), MOST_TASKS))
    rows = read(archives.repartition(tasks), members).select(
        "page_id", F.octet_length("payload").cast("long").alias("size"), "digest", "record_type", "refers_to"
    )
    rows = stored(rows)
    revisits = rows.where(F.col("record_type") == "revisit")
    sizes = rows.where(F.col("record_type") == "response").groupBy("digest").agg(F.max("size").alias("full"))
    sizes = sizes.join(revisits.select("digest").distinct(), "digest", "left_semi")
    return rows.join(stored(sizes), "digest", "left").select(
        "page_id",
        F.coalesce("size", "full").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
