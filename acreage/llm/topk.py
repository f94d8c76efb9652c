"""Exact top-k search by inner product with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it, and stored in that order, so
a stretch of rows is an annulus around a pivot. By the triangle inequality an annulus bounds the
distance of all its vectors from a query, and with their largest norm their inner products. A
query goes to the blocks of the order that hold an annulus which may reach its k-th best score so
far, and in each block to the annuli with the best bounds first, until no other can reach it.
Queries and rows meet in tasks; none goes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.operators.changes import one_per_key
from acreage.sources.writers import stored

# Vectors the pivots are chosen from, about; most pivots; rounds of moving them to their cells' middle.
PIVOT_SAMPLE, MAX_PIVOTS, ROUNDS = 4096, 256, 4
# Vectors of an annulus.
ANNULUS = 512
# Rows of a block of the order, as a power of two, and queries that meet a block at a time, about.
BLOCK_POWER, QUERIES = 15, 16_384
# Stretches of one pivot within a block: as long as there are no more, queries are told which to go to.
MOST_STRETCHES = 500_000
# Hits that a task holds before it drops those beyond a query's k.
HITS = 1 << 20
# Rows handled at once when vectors are keyed.
ROWS = 2048


def padded(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of ``dim`` numbers, shorter ones filled with zeros."""
    sizes = np.asarray(column.value_lengths())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dim).all():
        return values.reshape(len(column), dim)
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = values
    return out


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id`` and ``x``, floor(scale * component) of every vector that takes part."""
    v, limit = F.col("embedding").cast("array<double>"), F.lit(float("inf"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    takes_part = F.col("vec_id").isNotNull() & v.isNotNull() & finite
    x = F.transform(v, lambda c: F.floor(c * scale).cast("double"))
    return vectors.where(takes_part).select(F.col("vec_id").cast("long"), x.alias("x"))


def choose_pivots(rows: DataFrame, count: int, dim: int) -> np.ndarray:
    """Pivots in the middle of groups of a bounded sample: as many as the square root of the rows
    suggests, so that annuli are neither few nor tiny."""
    share = min(1.0, PIVOT_SAMPLE / max(1, count))
    place = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(place < share).select("x").limit(2 * PIVOT_SAMPLE).toArrow().column("x").combine_chunks()
    points = np.unique(padded(sample, dim), axis=0) if len(sample) else np.zeros((1, dim))
    wanted = max(1, min(MAX_PIVOTS, math.isqrt(count) // 2, len(points)))
    pivots = points[np.random.default_rng(10).choice(len(points), wanted, replace=False)]
    for _ in range(ROUNDS):
        nearest = distances(points, pivots).argmin(1)
        for cell in range(wanted):
            if (nearest == cell).any():
                pivots[cell] = points[nearest == cell].mean(0)
    return pivots


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def build(rows: DataFrame, pivots: np.ndarray, partitions: int) -> DataFrame:
    """The rows with ``pivot``, ``far``, ``norm2`` and ``block``, stored in order of pivot and distance.
    A cell of any size is many files' worth of rows: the order goes on by distance and id."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                points = padded(part.column("x"), pivots.shape[1])
                far = distances(points, pivots)
                nearest = far.argmin(1)
                added = [pa.array(nearest, pa.int32()), pa.array(far[np.arange(len(far)), nearest]), pa.array((points**2).sum(1))]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], ["vec_id", "x", "pivot", "far", "norm2"])

    added = [("pivot", T.IntegerType()), ("far", T.DoubleType()), ("norm2", T.DoubleType())]
    layout = T.StructType([*rows.schema.fields, *(T.StructField(n, t) for n, t in added)])
    keyed = stored(rows.mapInArrow(run, layout))
    by = ["pivot", "far", "vec_id"]
    ordered = keyed.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    return stored(ordered.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_POWER)))


def annuli(batch: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch | pa.Table]:
    """Stretches of one pivot and at most ANNULUS rows, of a batch or table in order."""
    pivots = np.asarray(batch.column("pivot"))
    cuts = [0, *(np.flatnonzero(np.diff(pivots)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        for at in range(start, end, ANNULUS):
            yield batch.slice(at, min(ANNULUS, end - at))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: by floating point where no sum can leave its exact
    range, and else by Python's whole numbers."""
    most = np.sqrt((left**2).sum(1).max(initial=0) * (right**2).sum(1).max(initial=0))
    if most < 2**52:
        return (left @ right.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in left.tolist()], [[int(x) for x in row] for row in right.tolist()]
    return np.array([[sum(a * b for a, b in zip(x, y)) for y in exact[1]] for x in exact[0]], np.int64).reshape(len(left), len(right))


def seeds(index: DataFrame, every: int, k: int, dim: int) -> DataFrame:
    """The queries with ``seed``, their k-th best score within their own annulus: where a search
    begins. NULL if the annulus is too small to tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in annuli(batch):
                ids = np.asarray(part.column("vec_id"))
                asked = np.flatnonzero(ids % every == 0)
                if not len(asked):
                    continue
                points = padded(part.column("x"), dim)
                scores = products(points[asked], points).astype(np.float64)
                scores[ids[asked][:, None] == ids[None, :]] = -np.inf
                kth = np.sort(scores, 1)[:, -k] if len(ids) >= k else np.full(len(asked), -np.inf)
                found = pa.array(np.where(np.isfinite(kth), kth, 0), pa.float64(), mask=~np.isfinite(kth))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(asked)), part.column("x").take(pa.array(asked)), found], ["vec_id", "x", "seed"]
                )

    found = index.mapInArrow(run, "vec_id long, x array<double>, seed double")
    # Of several rows with a query's id the first by components is the query.
    return one_per_key(found, ["vec_id"], ["x", "seed"])


def bounds(
    points: np.ndarray, pivots: np.ndarray, pivot: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray
) -> np.ndarray:
    """The most that the product of each query with a vector of each annulus can be: one that lies
    ``low`` to ``high`` from its pivot and holds squared norms of up to ``most``."""
    norms = (points**2).sum(1)[:, None]
    to_pivot = distances(points, pivots)[:, pivot]
    gap = np.maximum(0, np.maximum(to_pivot - high, low - to_pivot))
    by_distance = (norms + most - gap**2) / 2
    by_pivot = (points @ pivots.T)[:, pivot] + np.sqrt(norms) * high
    return np.minimum(by_distance, by_pivot) + 1e-9 * (norms + most) + 1e-6


def dealt(asked: DataFrame, index: DataFrame, pivots: np.ndarray, portions: int) -> DataFrame:
    """The queries with ``portion`` and a row for each ``block`` that may hold one of their best.

    What is known of the blocks is sent to the tasks if it is no more than MOST_STRETCHES rows;
    else every query goes to every block.
    """
    spark = asked.sparkSession
    stretches = index.groupBy("block", "pivot").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.max("norm2").alias("most"))
    stretches = stored(stretches)
    placed = asked.withColumn("portion", F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(portions)).cast("int"))
    if stretches.count() > MOST_STRETCHES:
        blocks = stretches.select("block").distinct()
        return placed.join(blocks, F.lit(True))
    table = stretches.toArrow()
    shared = spark.sparkContext.broadcast((pivots, {n: table.column(n).to_numpy() for n in table.column_names}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, known = shared.value
        names, of = np.unique(known["block"], return_inverse=True)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                points = padded(part.column("x"), pivots.shape[1])
                seeds = np.nan_to_num(part.column("seed").to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf)
                goes = np.zeros((len(points), len(names)), bool)
                for at in range(0, len(of), ROWS):
                    some = slice(at, at + ROWS)
                    reach = bounds(points, pivots, known["pivot"][some], known["low"][some], known["high"][some], known["most"][some])
                    q, k = np.nonzero(reach >= seeds[:, None])
                    goes[q, of[some][k]] = True
                q, b = np.nonzero(goes)
                for at in range(0, len(q), ROWS):
                    chosen = pa.array(q[at : at + ROWS])
                    columns = [part.column(c).take(chosen) for c in ("vec_id", "x", "seed", "portion")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(names[b[at : at + ROWS]])], ["vec_id", "x", "seed", "portion", "block"])

    return placed.mapInArrow(run, "vec_id long, x array<double>, seed double, portion int, block long")


def best_in(block: pa.Table, asked: pa.Table, pivots: np.ndarray, k: int) -> pa.Table:
    """``query_id``, ``vec_id`` and ``score``: the block's k best of each query, at least as good as
    the query's seed; rows with the query's id are the query's own and left out."""
    queries, seeds = asked.column("vec_id").to_numpy(), np.nan_to_num(asked.column("seed").to_numpy().astype(np.float64), nan=-np.inf)
    dim = pivots.shape[1]
    asked_points = padded(whole(asked.column("x")), dim)
    best = np.full((len(queries), k), -np.inf)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def least() -> np.ndarray:
        """What a score has to reach: the k-th best of this block or the seed."""
        return np.maximum(best.min(1), seeds)

    def kept() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, ids, scores = (np.concatenate(c) for c in zip(*held)) if held else (np.empty(0, np.int64),) * 3
        good = scores >= least()[q]
        q, ids, scores = q[good], ids[good], scores[good]
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        top = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[top], ids[top], scores[top]

    rows = list(annuli(block.sort_by([("pivot", "ascending"), ("far", "ascending"), ("vec_id", "ascending")])))
    edges = {n: np.array([f(r.column(c).to_numpy()) for r in rows]) for n, c, f in (("low", "far", np.min), ("high", "far", np.max), ("most", "norm2", np.max))}
    pivot = np.array([r.column("pivot")[0].as_py() for r in rows])
    reach = bounds(asked_points, pivots, pivot, edges["low"], edges["high"], edges["most"])
    for j in np.argsort(-(reach - least()[:, None]).max(0)):
        active = np.flatnonzero(reach[:, j] >= least())
        if not len(active):
            continue
        ids = rows[j].column("vec_id").to_numpy()
        scores = products(asked_points[active], padded(whole(rows[j].column("x")), dim))
        own = queries[active][:, None] == ids[None, :]
        ranked = np.where(own, -np.inf, scores)
        best[active] = np.partition(np.concatenate([best[active], ranked], 1), -k, axis=1)[:, -k:]
        q, at = np.nonzero((ranked >= least()[active][:, None]) & ~own)
        held.append((active[q], ids[at], scores[q, at]))
        size += len(q)
        if size > HITS:
            held = [kept()]
            size = len(held[0][0])
    q, ids, scores = kept()
    return pa.table({"query_id": queries[q], "vec_id": ids, "score": scores.astype(np.int64)})


def whole(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def search(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every`` its ``k`` best others by the inner
    product of floor(scale * component): ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``.

    Ties go to the smaller id; fewer rows where there are fewer others. NULL vectors, those with
    NULL or non-finite components and rows without an id take no part; shorter vectors count as
    filled with zeros; rows that repeat a query's id are its own, and of them the first by components
    is the query. Products must fit in 64 bits.

    Portions of about QUERIES queries and blocks of the order meet in tasks, so more of either are
    more tasks, not larger ones.
    """
    spark = vectors.sparkSession
    rows = stored(whole_numbers(vectors, scale))
    count, dim = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    dim = dim or 1
    pivots = choose_pivots(rows, count, dim)
    index = build(rows, pivots, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = stored(seeds(index, every, k, dim))
    portions = max(1, math.ceil(asked.count() / QUERIES))
    going = dealt(asked, index, pivots, portions).groupBy("block", "portion")
    met = index.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(portions - 1)))).groupBy("block", "portion")
    shared = spark.sparkContext.broadcast(pivots)

    def compare(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        return best_in(block, asked, shared.value, k)

    found = met.cogroup(going).applyInArrow(compare, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
