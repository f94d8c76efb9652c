"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of text a task turns into Python objects at a time.
CHARS_AT_ONCE = 1_000_000


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = CHARS_AT_ONCE
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``chars`` of text, or one longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > chars:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def remainder(of: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo: how labelled rows are held out. NULL counts as ''."""
    return F.crc32(F.coalesce(F.col(of).cast("string"), F.lit("")).cast("binary")) % modulus
