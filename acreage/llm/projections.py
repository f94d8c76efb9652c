"""Near-duplicate vectors by sorted projection passes.

Each pass moves the vectors so that a middle of them is the origin, draws random planes through
it, writes down for every vector on which side of each it lies, and sorts all vectors by that
string of bits. Linked vectors share long beginnings, so each is compared with a bounded number of
neighbours in the order. Verified pairs of all passes are united, and passes go on in rounds until
a round unites hardly anything that was apart.

What is united is then compared within: every vector of a component with those of its component
that their angles from one of them do not rule out, in blocks that meet in tasks. That counts the
links of each vector without listing pairs, however many vectors lie close together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.components import components
from acreage.sources.writers import stored

COSINE = 0.95
# Passes of a round, bits of a pass's string, and neighbours a vector is compared with before and after it at most.
PASSES, BITS, WINDOW = 8, 60, 1024
# A round that unites fewer pairs of groups than this share of what is united already is the last.
HARDLY_ANY = 0.001
# Vectors of each length that the middles are chosen from, about, middles of a round, and bytes of all of them.
SAMPLE, MIDDLES, SAMPLE_BYTES = 4096, 16, 32 << 20
# Vectors of a block, and the width in radians of the ring around a component's root it is from.
BLOCK, RING = 1024, 0.05
# Two linked vectors' angles from a third do not differ by more; rounding does not reach the rest.
ANGLE = float(np.arccos(COSINE)) + 1e-6
# Rows handled at once, which bounds the table of cosines.
ROWS = 1024


def comparable() -> Column:
    """Whether a row has an id and a vector that is not NULL, not zero, and finite throughout."""
    v, limit = F.col("embedding").cast("array<double>"), F.lit(float("inf"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    fine = F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of the same length as rows, scaled to length 1."""
    values = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    # Very large and very small components must not overflow or vanish when squared.
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def linked(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs with a cosine of at least COSINE. Single precision decides where rounding
    cannot reach, double precision the rest."""
    slack = 1e-5 + 2.4e-7 * left.shape[1]
    cosines = left.astype(np.float32) @ right.astype(np.float32).T
    here, there = np.nonzero(cosines >= COSINE - slack)
    sure = cosines[here, there] >= COSINE + slack
    doubtful = np.flatnonzero(~sure)
    for at in range(0, len(doubtful), ROWS * 16):
        some = doubtful[at : at + ROWS * 16]
        sure[some] = np.einsum("ij,ij->i", left[here[some]], right[there[some]]) >= COSINE
    return here[sure], there[sure]


def middles(nodes: DataFrame, turn: int) -> dict[int, np.ndarray]:
    """For each vector length the mean of a bounded sample, and below it the means of parts of it
    around some vectors of it, others in each round."""
    count, longest = nodes.agg(F.count("*"), F.max(F.size("v"))).first()
    wanted = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * (longest or 1))))
    place = F.pmod(F.xxhash64("node", F.lit(5 + turn)), F.lit(1 << 30)) / float(1 << 30)
    sample = nodes.where(place < 2 * wanted / max(1, count)).select("v").limit(wanted).toArrow().combine_chunks()
    found = {}
    for rows in (r for b in sample.to_batches() for r in by_length(b)):
        units = matrix(rows.column("v"))
        random = np.random.default_rng(turn)
        own = units[random.choice(len(units), min(MIDDLES, len(units)), replace=False)]
        nearest = (units @ own.T).argmax(1)
        parts = [units[nearest == k].mean(0) for k in np.unique(nearest)]
        found[units.shape[1]] = np.stack([units.mean(0), *parts])
    return found


def bit_strings(units: np.ndarray, own: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """For each vector and pass of a round the middle it was moved by and the sides of the planes
    as one number, first plane first. Even passes move all vectors by the mean, odd ones each by the middle
    that is nearest to it, which tells vectors of a crowded place apart."""
    planes = np.random.default_rng([units.shape[1], turn]).standard_normal((units.shape[1], PASSES, BITS))
    nearest = 1 + (units @ own[1:].T).argmax(1) if len(own) > 1 else np.zeros(len(units), np.int64)
    value = 1 << np.arange(BITS, dtype=np.int64)[::-1]
    cells, keys = np.zeros((len(units), PASSES), np.int64), np.empty((len(units), PASSES), np.int64)
    cells[:, 1::2] = nearest[:, None]
    for odd, moved in ((0, units - own[0]), (1, units - own[nearest])):
        own_planes = planes[:, odd::2]
        sides = moved @ own_planes.reshape(len(planes), -1) > 0
        keys[:, odd::2] = sides.reshape(len(units), -1, BITS) @ value
    return cells, keys


def by_length(batch: pa.RecordBatch, column: str = "v") -> Iterator[pa.RecordBatch]:
    """The batch's rows in groups of one vector length."""
    sizes = np.asarray(batch.column(column).value_lengths())
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def keyed(nodes: DataFrame, turn: int) -> DataFrame:
    """A row per node and pass: ``pass``, vector length ``dim``, ``cell``, ``key``, root and vector."""
    shared = nodes.sparkSession.sparkContext.broadcast(middles(nodes, turn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                for rows in by_length(batch.slice(start, ROWS)):
                    units = matrix(rows.column("v"))
                    own = shared.value.get(units.shape[1], np.zeros((1, units.shape[1])))
                    cells, keys = bit_strings(units, own, turn)
                    lists = [pa.array(x.tolist(), pa.list_(pa.int64())) for x in (cells, keys)]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *lists], ["node", "root", "v", "cells", "keys"])

    found = nodes.select("node", "root", "v").mapInArrow(run, "node long, root long, v array<double>, cells array<long>, keys array<long>")
    each = found.select("node", "root", "v", F.posexplode(F.arrays_zip("cells", "keys")).alias("pass", "at"))
    return each.select("node", "root", F.size("v").alias("dim"), "pass", F.col("at.cells").alias("cell"), F.col("at.keys").alias("key"), "v")


def top_of(parents: dict[int, int]) -> Callable[[int], int]:
    def top(root: int) -> int:
        while (above := parents.get(root, root)) != root:
            parents[root] = parents.get(above, above)
            root = above
        return root

    return top


def neighbour_links(keys: DataFrame, partitions: int) -> DataFrame:
    """``a``, ``b``: groups that verified pairs among neighbours of each pass's order unite.

    Range partitions hold stretches of the order; ties are ordered by a hash, so equal keys may
    be split as well. Each row's last WINDOW forerunners are all a task keeps, and it gives no
    pair that follows from its others. A pair that a border separates has the other passes, whose
    borders lie elsewhere.
    """
    ordered = keys.withColumn("tie", F.xxhash64("pass", "node"))
    by = ["pass", "dim", "cell", "key", "tie"]
    ordered = ordered.repartitionByRange(partitions, *by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parents = None, {}
        top = top_of(parents)
        for batch in batches:
            places = np.asarray(batch.column("pass")).astype(np.int64) << 32 | np.asarray(batch.column("dim"))
            cuts = np.flatnonzero(np.diff(places)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                for at in range(start, end, ROWS):
                    rows = batch.slice(at, min(ROWS, end - at))
                    roots, units = np.asarray(rows.column("root")), matrix(rows.column("v"))
                    before = 0
                    if held is not None and held[0] == places[at]:
                        before, roots, units = len(held[1]), np.concatenate([held[1], roots]), np.concatenate([held[2], units])
                    later, earlier = linked(units[before:], units)
                    later += before
                    near = (earlier < later) & (later - earlier <= WINDOW) & (roots[earlier] != roots[later])
                    pairs = np.unique(np.stack([roots[earlier[near]], roots[later[near]]], 1), axis=0)
                    joins = []
                    for a, b in pairs.tolist():
                        if top(a) != top(b):
                            parents[top(a)] = top(b)
                            joins.append((a, b))
                    ends = np.array(joins, np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])
                    held = (places[at], roots[-WINDOW:], units[-WINDOW:])

    return ordered.select("pass", "dim", "root", "v").mapInArrow(run, "a long, b long")


def united(nodes: DataFrame, partitions: int) -> DataFrame:
    """The nodes with ``root``, the same for what the passes unite, in rounds of PASSES."""
    grouped = nodes.withColumn("root", F.col("node"))
    joined, turn = 0, 0
    while True:
        links = stored(neighbour_links(keyed(grouped, turn), partitions).distinct())
        if links.isEmpty():
            return grouped
        # As many groups disappear as nodes of the links exceed the groups they become.
        moved = stored(components(links).select(F.col("node").alias("root"), F.col("root").alias("to")))
        before, after = moved.agg(F.count("*"), F.count_distinct("to")).first()
        fresh = before - after
        placed = grouped.join(moved, "root", "left").select(*nodes.columns, F.coalesce("to", "root").alias("root"))
        grouped = stored(placed)
        joined, turn = joined + fresh, turn + 1
        if fresh <= HARDLY_ANY * joined:
            return grouped


def in_blocks(grouped: DataFrame) -> DataFrame:
    """Members of components of more than one node with ``ring`` and ``part``: the block each is in.

    A component of up to BLOCK nodes is one block. Larger ones are cut into rings of equal angle
    from the root's vector, and rings into parts by a hash, of about BLOCK nodes each.
    """
    sizes = stored(grouped.groupBy("root").agg(F.count("*").alias("size")).where(F.col("size") > 1))
    roots = grouped.select(F.col("node").alias("root"), F.col("v").alias("root_v"))
    members = grouped.join(sizes, "root").join(roots, "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                for rows in by_length(batch.slice(start, ROWS)):
                    cosines = np.einsum("ij,ij->i", matrix(rows.column("v")), matrix(rows.column("root_v")))
                    rings = np.where(np.asarray(rows.column("size")) > BLOCK, np.arccos(np.clip(cosines, -1, 1)) // RING, 0)
                    kept = [rows.column(c) for c in ("node", "root", "copies", "v")]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(rings.astype(np.int32))], ["node", "root", "copies", "v", "ring"])

    columns = members.select("node", "root", "copies", "v", "size", "root_v")
    ringed = stored(columns.mapInArrow(run, "node long, root long, copies long, v array<double>, ring int"))
    parts = ringed.groupBy("root", "ring").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    return stored(ringed.join(stored(parts), ["root", "ring"]).select("node", "root", "copies", "v", "ring", part))


def link_counts(grouped: DataFrame) -> DataFrame:
    """``node`` and ``near``: how many rows each node of a larger component is linked to, itself and
    its copies among them. Blocks of a component meet in tasks of their own, two at a time; rings
    too far from one another for a link do not meet."""
    members = in_blocks(grouped)
    blocks = stored(members.select("root", "ring", "part").distinct())
    other = blocks.select("root", F.col("ring").alias("ring2"), F.col("part").alias("part2"))
    reach = int(np.ceil(ANGLE / RING)) + 1
    near = (F.col("ring2") - F.col("ring")).between(0, reach)
    pairs = blocks.join(other, "root").where(near & ((F.col("ring2") > F.col("ring")) | (F.col("part2") >= F.col("part"))))
    pairs = stored(pairs.withColumn("pair", F.monotonically_increasing_id()))
    ends = pairs.select("pair", "root", "ring", "part", F.lit(0).alias("side")).unionByName(
        pairs.where((F.col("ring2") != F.col("ring")) | (F.col("part2") != F.col("part"))).select(
            "pair", "root", F.col("ring2").alias("ring"), F.col("part2").alias("part"), F.lit(1).alias("side")
        )
    )
    dealt = members.join(ends, ["root", "ring", "part"]).select("pair", "side", "node", "copies", "v")

    def count(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sides, nodes, copies = (table.column(c).to_numpy() for c in ("side", "node", "copies"))
        column = table.column("v").combine_chunks()
        units = matrix(pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column)
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        same = not len(right)
        right = left if same else right
        found = np.zeros(len(nodes), np.int64)
        for start in range(0, len(left), ROWS):
            some = left[start : start + ROWS]
            for begin in range(0, len(right), ROWS):
                others = right[begin : begin + ROWS]
                here, there = linked(units[some], units[others])
                found[some] += np.bincount(here, copies[others[there]], len(some)).astype(np.int64)
                if not same:
                    found[others] += np.bincount(there, copies[some[here]], len(others)).astype(np.int64)
        return pa.table({"node": nodes, "near": found})

    partial = dealt.groupBy("pair").applyInArrow(count, "node long, near long")
    return partial.groupBy("node").agg(F.sum("near").alias("near"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """A row per row of ``vec_id`` and ``embedding``: ``n_links``, ``component_id`` and ``kept``.

    Equal vectors are one node and linked with one another. NULL, zero and non-finite vectors,
    those with NULL components and rows without an id link with nothing; vectors of different
    lengths are never linked. A repeated id with several vectors is several rows. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col("embedding").cast("array<double>").alias("v")
    rows = vectors.where(comparable()).select("vec_id", v).select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    nodes = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("v").alias("v"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = united(nodes, partitions)
    whole = grouped.select("h1", "h2", "node", "first", "root", "copies").join(link_counts(grouped), "node", "left")
    whole = stored(whole.select("h1", "h2", "first", "root", F.coalesce("near", "copies").alias("near")))
    groups = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    settled = whole.join(stored(groups), "root").select("h1", "h2", "component_id", (F.col("near") - 1).alias("n_links"))
    settled = stored(settled)
    linked = rows.select("vec_id", "h1", "h2").join(settled, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    # What cannot be compared is a component of its own.
    alone = vectors.where(~comparable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
