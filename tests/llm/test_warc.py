import gzip
import hashlib
import json
import zlib

import pytest
from pyarrow import fs

from acreage.llm import warc
from acreage.session import fresh_path

LAYOUT = "page_id long, url string, html string, size long, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], LAYOUT)


ROWS = [
    (5, "u", "<p>" + "é" * 60), (2, None, "<p>" + "é" * 60), (9, "a\r\nb", "<p>" + "é" * 60), (3, "u", "short"),
    (4, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", "<p>" + "é" * 60), (None, "u", "z" * 100),
    (None, "u", "z" * 100), (11, "u", "\r\n\r\nWARC/1.1\r\n\r\n" + "q" * 100), (12, "u", "\r\n\r\n"),
    (13, "u", "y" * 99), (14, "u", "y" * 99), (15, "u", "w" * 100), (15, "u", "w" * 100), (16, "u", "w" * 100),
]


def brute(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == raw and i is not None]
        again = len(raw) >= 100 and same and page != min(same)
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_file", [1, 4, 10_000])
def test_round_trip_against_plain_python(spark, monkeypatch, per_file):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", per_file)
    got = warc.round_trip(pages(spark, ROWS)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_members_stand_alone_and_streams_do_not(spark):
    whole, members = fresh_path(spark, "w"), fresh_path(spark, "m")
    warc.write(pages(spark, ROWS).coalesce(1), whole)
    archives = warc.normalise(whole, members, spark)
    assert archives.agg({"records": "sum"}).first()[0] == len(ROWS)
    stream = [gzip.decompress(r.content) for r in spark.read.format("binaryFile").load(f"{whole}/*.gz").collect()]
    store, _ = fs.FileSystem.from_uri(members)
    again = [gzip.decompress(store.open_input_file(r.archive).read()) for r in archives.collect()]
    assert sorted(stream) == sorted(again)
    payloads = {r.page_id: r.payload for r in warc.read(archives, members).collect() if r.record_type == "response"}
    assert bytes(payloads[11]) == ROWS[10][2].encode()


def test_streams_of_many_members_and_broken_ones():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    joined = gzip.compress(record) + gzip.compress(record[:10]) + gzip.compress(record[10:])
    assert [block for _, block in warc.records(joined)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.records(gzip.compress(record[:-6])))
    assert list(warc.records(gzip.compress(b""))) == []


def test_a_stream_is_never_held_whole(spark, monkeypatch, tmp_path):
    """A monolithic archive of many records and one that inflates a thousandfold, in small steps."""
    monkeypatch.setattr(warc, "STEP", 1000)
    block = b"a" * 50_000
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n"
    whole = b"".join(record % (i, len(block)) + block + b"\r\n\r\n" for i in range(40))
    packed = gzip.compress(whole)
    read = []

    def chunks():
        for at in range(0, len(packed), 100):
            read.append(at)
            yield packed[at : at + 100]

    seen = 0
    for _, content in warc.records(chunks()):
        assert content == block
        seen += 1
        # The first record is out long before the stream has been read.
        assert seen > 3 or len(read) < len(packed) / 100 / 2
    assert seen == 40 and max(map(len, warc.inflated([packed]))) <= 1000
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gz").write_bytes(packed)
    done = warc.normalise(str(tmp_path / "in"), str(tmp_path / "out"), spark).collect()
    assert [r.records for r in done] == [40]
    index = [json.loads(line) for line in (tmp_path / "out").glob("*.idx").__next__().read_text().splitlines()]
    assert index[-1]["offset"] + index[-1]["length"] == done[0].bytes


def test_a_changed_payload_is_found(spark):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha256:00\r\n\r\nHTTP\r\n\r\nx\r\n\r\n"
    with pytest.raises(ValueError):
        warc._page(good)
    assert zlib.crc32(good)
