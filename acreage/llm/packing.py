"""Best-fit packing of token sequences by hierarchical residual rounds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.sources.writers import stored

# Tokens of a sequence that may stay unused before it is worth another round.
NEARLY_FULL = 8
# Items one group packs, so that its work fits in a task whatever the input.
GROUP_ITEMS = 32_768
# Groups that meet in one of the next round.
FAN_IN = 4
# Bins of one round and group, within its part of the bin numbers.
BINS = 1 << 32


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: each item's bin and place in it, and each bin's fill.

    Longest first, an item goes to the fullest bin that has room. Open bins are kept by the room
    they have left; the set bits of a number say which rooms occur.
    """
    n = len(lengths)
    bins, places = np.empty(n, np.int64), np.empty(n, np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        wide = rooms >> length
        if wide:
            room = length + (wide & -wide).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        bins[item], places[item] = bin_, fills[bin_]
        fills[bin_] += length
        left = room - length
        by_room[left].append(bin_)
        rooms |= 1 << left
    return bins, places, np.array(fills, np.int64)


def pieces(encoded: DataFrame, capacity: int = 2048, closing: int = 0, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows with binary ``ids`` as pieces of at most ``capacity`` tokens, ``closing`` added at each end.

    ``piece`` counts from 0, ``start`` is the number of the document's tokens before it and
    ``ids_crc32`` is of its ids as little-endian unsigned 32-bit integers.
    """
    ends = F.lit(int(closing).to_bytes(4, "little"))
    whole = encoded.select(*keep, F.concat(F.coalesce("ids", F.lit(b"")), ends).alias("_ids"))
    count = (F.octet_length("_ids") / 4).cast("long")
    last = F.floor((count - 1) / capacity)
    cut = whole.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_piece"))
    start = F.col("_piece") * capacity
    ids = F.substring(F.col("_ids"), (start * 4 + 1).cast("int"), F.lit(capacity * 4))
    return cut.select(
        *keep,
        F.col("_piece").cast("int").alias("piece"),
        start.alias("start"),
        (F.octet_length(ids) / 4).cast("long").alias("length"),
        F.crc32(ids).alias("ids_crc32"),
    )


def _packed(items: DataFrame, groups: int, level: int, capacity: int, item: str = "_item") -> DataFrame:
    """Items with ``_bin``, ``_place`` and the bin's ``_fill``, packed best-fit in each group."""
    layout = T.StructType(
        [*items.schema.fields, *(T.StructField(n, T.LongType()) for n in ("_bin", "_place", "_fill"))]
    )

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(item).drop_columns(["_group"])
        bins, places, fills = best_fit(table.column("length").to_numpy(), capacity)
        first = (level * (1 << 20) + key[0].as_py()) * BINS
        for name, values in (("_bin", first + bins), ("_place", places), ("_fill", fills[bins])):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    group = F.pmod(F.xxhash64(F.lit(level), F.col(item)), F.lit(groups)).cast("long")
    return items.withColumn("_group", group).groupBy("_group").applyInArrow(pack, layout)


def pack(items: DataFrame, capacity: int = 2048) -> DataFrame:
    """Rows with ``length`` between 1 and ``capacity``, placed into as few sequences as rounds find.

    Adds ``sequence_id`` and ``offset``; rows of a sequence lie without gaps. First every group
    of rows is packed by itself, best fit. Sequences that are nearly full are done. Every other
    one becomes an item of its fill, and the groups merge ``FAN_IN`` at a time and pack those
    items, until one group is left or no two items find together. Rounds move only numbers and
    fills; rows are written once and joined to what became of their first sequence.

    No group holds more than about ``GROUP_ITEMS`` items: where items do not get fewer with the
    groups, groups stay as many as they need. Equal rows are different items. An empty table
    gives no rows.
    """
    spark: SparkSession = items.sparkSession
    numbered = stored(items.withColumn("_item", F.monotonically_increasing_id()))
    count = numbered.count()
    groups = max(1, math.ceil(count / GROUP_ITEMS))
    first = stored(_packed(numbered, groups, 0, capacity))
    moved = first.where(F.col("_place") == 0).where(F.col("_fill") < capacity - NEARLY_FULL)
    # What became of each first sequence: the one it lies in now, and where.
    became = stored(moved.select(F.col("_bin").alias("_first"), F.col("_bin").alias("_now"), F.lit(0).cast("long").alias("_shift"), "_fill"))
    left, level = became.count(), 0
    while groups > 1 and left > 1:
        level += 1
        groups = max(math.ceil(groups / FAN_IN), math.ceil(left / (2 * GROUP_ITEMS)))
        open_ = became.where(F.col("_fill") < capacity - NEARLY_FULL)
        bins = open_.where(F.col("_shift") == 0).select(F.col("_now").alias("_item"), F.col("_fill").alias("length"))
        placed = _packed(bins, groups, level, capacity).select(
            F.col("_item").alias("_now"), F.col("_bin"), F.col("_place"), F.col("_fill").alias("_full")
        )
        became = stored(
            became.join(placed, "_now", "left").select(
                "_first",
                F.coalesce("_bin", "_now").alias("_now"),
                (F.col("_shift") + F.coalesce("_place", F.lit(0))).alias("_shift"),
                F.coalesce("_full", "_fill").alias("_fill"),
            )
        )
        before, left = left, became.where((F.col("_shift") == 0) & (F.col("_fill") < capacity - NEARLY_FULL)).count()
        if groups > 1 and left >= before:
            break
    became = became.select("_first", "_now", "_shift")
    return (
        first.join(became, first["_bin"] == became["_first"], "left")
        .select(
            *items.columns,
            F.coalesce("_now", "_bin").alias("sequence_id"),
            (F.col("_place") + F.coalesce("_shift", F.lit(0))).alias("offset"),
        )
    )
