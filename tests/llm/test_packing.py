import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from acreage.llm import packing


def held_together(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(deadline=None, max_examples=60)
def test_best_fit_wastes_little(lengths):
    bins, places, fills = packing.best_fit(np.array(lengths, np.int64), 64)
    assert all(0 < f <= 64 for f in fills) and sum(fills) == sum(lengths)
    for b in range(len(fills)):
        inside = sorted((p, n) for p, n, x in zip(places, lengths, bins) if x == b)
        assert [p for p, _ in inside] == list(np.cumsum([0, *[n for _, n in inside]])[:-1])
    # No two bins fit in one.
    assert len(fills) < 2 or sum(sorted(fills)[:2]) > 64


def test_pieces(spark):
    ids = struct.pack("<5I", 7, 8, 9, 10, 2**31 + 5)
    rows = spark.createDataFrame([(1, bytearray(ids)), (2, None), (3, bytearray(b""))], "doc_id long, ids binary")
    found = sorted(tuple(r) for r in packing.pieces(rows, capacity=4, closing=0).collect())
    crc = lambda *n: zlib.crc32(struct.pack(f"<{len(n)}I", *n))
    assert found == [
        (1, 0, 0, 4, crc(7, 8, 9, 10)), (1, 1, 4, 2, crc(2**31 + 5, 0)), (2, 0, 0, 1, crc(0)), (3, 0, 0, 1, crc(0)),
    ]


@pytest.mark.parametrize("group", [7, 50, 10_000])
def test_rounds_keep_every_item_once(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_ITEMS", group)
    lengths = np.random.default_rng(1).integers(1, 100, 600).tolist() + [100] * 5
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = packing.pack(items, capacity=100).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted(enumerate(lengths))
    sequences = held_together(rows, 100)
    assert sequences <= 1.25 * sum(lengths) / 100 and (group < 10_000 or sequences <= 1.02 * sum(lengths) / 100 + 1)


def test_large_items_only_equal_rows_nulls_and_none(spark):
    alike = spark.createDataFrame([(None, 60)] * 9, "doc_id long, length long")
    assert held_together(packing.pack(alike, capacity=100).collect(), 100) == 9
    assert packing.pack(alike.limit(0), capacity=100).count() == 0
