"""Hard-negative mining with segment summaries.

Each vector is cut into segments, and the mean and the deviation of each are stored beside it. The
inner product of two segments is the product of their means times their length, give or take the
product of their deviations. Summed over segments that bounds a score from both sides: first over
a few long segments, for pairs that remain over shorter ones, and only what no bound rules out is
multiplied.

Anchors and rows are dealt into blocks by a hash of their ids, and every block of anchors meets every
block of rows in a task of its own. Nothing goes through the driver, and no key is larger than others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.llm.topk import padded, products
from acreage.operators.changes import one_per_key
from acreage.sources.writers import stored

# Segments of the stored summaries, and of the bounds in the order they are tried.
SEGMENTS, LEVELS = 16, (1, 4, 16)
# Most rows and anchors of a block, about, and the fewest rows worth a task.
BLOCK_ROWS, BLOCK_ANCHORS, LEAST_ROWS = 32_768, 16_384, 2_048
# Rows and anchors that are compared at once.
AT_ONCE = 1024


def taking_part(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label`` as text and ``x``, floor(scale * component), of every row that takes part."""
    v, limit = F.col("embedding").cast("array<double>"), F.lit(float("inf"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < limit))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite
    x = F.transform(v, lambda c: F.floor(c * scale).cast("double"))
    return vectors.where(whole).select(F.col("vec_id").cast("long"), F.col("label").cast("string"), x.alias("x"))


def summaries(points: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each segment and its deviation, the length of what differs from the mean. The
    last segment is filled up with zeros."""
    size = max(1, math.ceil(points.shape[1] / segments))
    parts = np.zeros((len(points), segments * size))
    parts[:, : points.shape[1]] = points
    parts = parts.reshape(len(points), segments, size)
    means = parts.mean(2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(2))


def with_summaries(rows: DataFrame, dim: int) -> DataFrame:
    """The rows with ``means`` and ``deviations`` of SEGMENTS segments."""
    layout = T.StructType([*rows.schema.fields, *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("means", "deviations"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = summaries(padded(batch.column("x"), dim), SEGMENTS)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(s.ravel()), SEGMENTS).cast(pa.list_(pa.float64())) for s in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=layout.names)

    return rows.mapInArrow(run, layout)


@dataclass
class Block:
    """Vectors of a block with their summaries at each level, scaled so that a bound is a product."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray
    means: list[np.ndarray]
    deviations: list[np.ndarray]
    norms: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, labels: np.ndarray, dim: int) -> Block:
        points = padded(_column(table, "x"), dim)
        size = max(1, math.ceil(dim / SEGMENTS))
        fine, spread = (padded(_column(table, n), SEGMENTS) for n in ("means", "deviations"))
        means, deviations = [], []
        for level in LEVELS:
            within = SEGMENTS // level
            parts = fine.reshape(len(fine), level, within)
            mean = parts.mean(2)
            squares = (spread.reshape(parts.shape) ** 2).sum(2) + size * ((parts - mean[:, :, None]) ** 2).sum(2)
            means.append(mean * math.sqrt(size * within))
            deviations.append(np.sqrt(squares))
        ids = _column(table, "vec_id").to_numpy(zero_copy_only=False)
        return cls(ids, labels, points, means, deviations, np.sqrt((points**2).sum(1)))

    def some(self, at: np.ndarray) -> Block:
        parts = [m[at] for m in self.means], [d[at] for d in self.deviations]
        return Block(self.ids[at], self.labels[at], self.points[at], *parts, self.norms[at])


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def refined(anchors: Block, rows: Block, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the allowed pairs that no bound keeps out of their anchor's range."""
    a, r = np.arange(len(anchors.ids)), np.arange(len(rows.ids))
    slack = 1e-9 * anchors.norms[:, None] * rows.norms[None, :] + 1e-6
    for means, deviations, row_means, row_deviations in zip(anchors.means, anchors.deviations, rows.means, rows.deviations):
        used, met = allowed.any(1), allowed.any(0)
        a, r, allowed, slack = a[used], r[met], allowed[np.ix_(used, met)], slack[np.ix_(used, met)]
        middle = means[a] @ row_means[r].T
        reach = deviations[a] @ row_deviations[r].T + slack
        allowed = allowed & (middle + reach >= least[a, None]) & (middle - reach <= most[a, None])
    p, q = np.nonzero(allowed)
    if 16 * len(p) < allowed.size and (anchors.norms.max(initial=0) * rows.norms.max(initial=0)) < 2**52:
        scores = (anchors.points[a[p]] * rows.points[r[q]]).sum(1).astype(np.int64)
    else:
        scores = products(anchors.points[a], rows.points[r])[p, q]
    return a[p], r[q], scores


class Best:
    """The ``k`` highest scores of each of ``n`` questions so far, and the rows that reach them."""

    def __init__(self, n: int, k: int):
        self.k, self.scores = k, np.full((n, k), -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def least(self) -> np.ndarray:
        return self.scores[:, 0]

    def add(self, question: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least()[question]
        question, ids, scores = question[good], ids[good], scores[good]
        if not len(question):
            return
        order = np.lexsort((-scores, question))
        place = np.arange(len(order)) - np.searchsorted(question[order], question[order])
        top = order[place < self.k]
        fresh = np.full((len(self.scores), self.k), -np.inf)
        fresh[question[top], place[place < self.k]] = scores[top]
        self.scores = np.sort(np.concatenate([self.scores, fresh], 1), 1)[:, -self.k :]
        self.held.append((question, ids, scores))
        self.size += len(question)
        if self.size > 1 << 20:
            self.held = [self.found()]
            self.size = len(self.held[0][0])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, id, score): the best, ties by the smaller id."""
        question, ids, scores = (np.concatenate(c) for c in zip(*self.held)) if self.held else (np.empty(0, np.int64),) * 3
        order = np.lexsort((ids, -scores, question))
        question, ids, scores = question[order], ids[order], scores[order]
        top = np.arange(len(question)) - np.searchsorted(question, question) < self.k
        return question[top], ids[top], scores[top]


def parts(n: int) -> Iterator[np.ndarray]:
    for start in range(0, n, AT_ONCE):
        yield np.arange(start, min(n, start + AT_ONCE))


def best_partners(anchors: Block, rows: Block, k: int) -> Best:
    """The ``k`` best rows of each anchor's own label."""
    best = Best(len(anchors.ids), k)
    by_label = np.argsort(rows.labels, kind="stable")
    bounds = np.searchsorted(rows.labels[by_label], np.arange(int(anchors.labels.max(initial=-1)) + 2))
    for label in np.unique(anchors.labels).tolist():
        asked = np.flatnonzero(anchors.labels == label)
        same = by_label[bounds[label] : bounds[label + 1]]
        for i in parts(len(asked)):
            some = anchors.some(asked[i])
            for j in parts(len(same)):
                others = rows.some(same[j])
                allowed = some.ids[:, None] != others.ids[None, :]
                least = best.least()[asked[i]]
                a, r, scores = refined(some, others, allowed, least, np.full(len(least), np.inf))
                best.add(asked[i][a], others.ids[r], scores)
    return best


def ranges(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest whole number between ``low`` and ``high`` hundredths of each score,
    without a product that could leave 64 bits."""
    least = -((-scores // 100) * low + (-scores % 100) * low // 100)
    return least, (scores // 100) * high + (scores % 100) * high // 100


def hard_negatives(anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray, k: int) -> Best:
    """The ``k`` best rows of other labels within each range of each anchor; question
    ``anchor * width + place``. A range that is empty (low above high) finds nothing."""
    width = low.shape[1]
    best = Best(low.size, k)
    some_range = low <= high
    for i in parts(len(anchors.ids)):
        some = anchors.some(i)
        most = np.where(some_range[i], high[i], -np.inf).max(1, initial=-np.inf)
        for j in parts(len(rows.ids)):
            others = rows.some(j)
            reached = np.maximum(best.least().reshape(low.shape)[i], low[i])
            least = np.where(some_range[i], reached, np.inf).min(1, initial=np.inf)
            allowed = (some.labels[:, None] != others.labels[None, :]) & np.isfinite(least)[:, None]
            allowed &= some.ids[:, None] != others.ids[None, :]
            a, r, scores = refined(some, others, allowed, least, most)
            for place in range(width):
                at = i[a]
                inside = (low[at, place] <= scores) & (scores <= high[at, place])
                best.add(at[inside] * width + place, others.ids[r[inside]], scores[inside])
    return best


def dealt(df: DataFrame, own: str, blocks: int, other: str, copies: int, by: str) -> DataFrame:
    """The rows in blocks by a hash of ``by``, with a copy for every block of the other side."""
    placed = df.withColumn(own, F.pmod(F.xxhash64(by, F.lit(13)), F.lit(blocks)).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def meet(rows: DataFrame, asked: DataFrame, blocks: tuple[int, int], compare: Callable, layout: str) -> DataFrame:
    """What ``compare`` makes of every block of anchors and every block of rows."""
    left = dealt(rows, "rows_at", blocks[0], "asked_at", blocks[1], "vec_id").groupBy("rows_at", "asked_at")
    right = dealt(asked, "asked_at", blocks[1], "rows_at", blocks[0], "vec_id").groupBy("rows_at", "asked_at")
    return left.cogroup(right).applyInArrow(compare, layout)


def in_blocks(rows: pa.Table, asked: pa.Table, dim: int) -> tuple[Block, Block]:
    """Both sides as blocks, their labels as numbers that mean the same on both."""
    texts = pa.concat_arrays([_column(asked, "label"), _column(rows, "label")])
    codes = texts.dictionary_encode().indices.to_numpy().astype(np.int64)
    return Block.of(asked, codes[: asked.num_rows], dim), Block.of(rows, codes[asked.num_rows :], dim)


def mine(
    vectors: DataFrame, every: int = 50, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``. A score is the inner product
    of floor(scale * component). An anchor's positives are its ``positives`` best other rows of the
    same label; of each, the ``negatives`` best rows of other labels whose score is between
    ``low`` and ``high`` hundredths of the positive's are returned, ``rank`` from 1. Ties go to the
    smaller id, and there are fewer rows where fewer fit. A positive of negative score has none.

    Rows without id or label, with a NULL vector or with NULL or non-finite components take no
    part; shorter vectors count as filled with zeros, empty ones as zero. Rows that carry an anchor's
    id are the anchor's own and never its partners; of several the one that comes first by label and
    then components is the anchor. Other repeated rows each count. An empty table gives no rows.
    Products must fit in 64 bits; other columns are ignored.

    Every anchor is compared with every row, but for pairs that bounds rule out: the work grows with
    the product of their numbers. Blocks of up to BLOCK_ANCHORS and BLOCK_ROWS meet in tasks.
    """
    spark = vectors.sparkSession
    chosen = stored(taking_part(vectors, scale))
    count, dim = chosen.agg(F.count("*"), F.max(F.size("x"))).first()
    dim = max(1, dim or 0)
    rows = stored(with_summaries(chosen, dim))
    asked = stored(one_per_key(rows.where(F.col("vec_id") % every == 0), ["vec_id"], ["label", "x"]))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(1, math.ceil(count / BLOCK_ROWS), min(tasks, count // LEAST_ROWS))
    blocks = (row_blocks, max(1, math.ceil(asked.count() / BLOCK_ANCHORS)))

    def partners(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({"anchor_id": pa.array([], pa.int64()), "positive_id": pa.array([], pa.int64()), "positive_score": pa.array([], pa.int64())})
        anchors, others = in_blocks(rows, asked, dim)
        at, ids, scores = best_partners(anchors, others, positives).found()
        return pa.table({"anchor_id": anchors.ids[at], "positive_id": ids, "positive_score": scores.astype(np.int64)})

    found = meet(rows, asked, blocks, partners, "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    near = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("near")
    )
    asked = stored(asked.join(near, "vec_id"))

    def negative(rows: pa.Table, asked: pa.Table) -> pa.Table:
        names = ("anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")
        if not rows.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        anchors, others = in_blocks(rows, asked, dim)
        near = _column(asked, "near").to_pylist()
        # Missing positives have an empty range.
        lows, highs = np.ones((len(near), positives), np.int64), np.zeros((len(near), positives), np.int64)
        scores = [np.array([p["positive_score"] for p in n], np.int64) for n in near]
        for at, s in enumerate(scores):
            lows[at, : len(s)], highs[at, : len(s)] = ranges(s, low, high)
        question, ids, reached = hard_negatives(anchors, others, lows, highs, negatives).found()
        at, place = np.divmod(question, positives)
        positive = [near[a][p] for a, p in zip(at.tolist(), place.tolist())]
        columns = (anchors.ids[at], place, [p["positive_id"] for p in positive], [p["positive_score"] for p in positive], ids, reached)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    layout = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = meet(rows, asked, blocks, negative, layout)
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
