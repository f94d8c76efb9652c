"""Toxicity by logistic regression on hashed word n-grams and skip-grams, trained by FTRL-proximal.

Each feature has its own learning rate, which falls as the feature is seen, and a weight that is
exactly zero until the evidence for it passes the L1 bound. What is broadcast is the few weights
that are not zero.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import small_batches
from acreage.sources.writers import stored

# Features are numbered below this: the bound of the weights' size.
FEATURES = 1 << 20
# Labelled rows a classifier is fitted on, chosen by a hash of their id; all if there are fewer.
SAMPLE = 24_000
EPOCHS = 4
# FTRL-proximal: learning rate, its offset, and the L1 and L2 bounds.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 1.0
# Odd factors that mix the hashes of two words, one pair for each distance between them.
MIX = ((0x9E3779B1, 0x85EBCA77), (0xC2B2AE3D, 0x27D4EB2F), (0x165667B1, 0xD3A2646D))

BLANK, WORD = 0, 1


def byte_kinds() -> np.ndarray:
    """Letters, digits and all bytes beyond ASCII make words; others part them."""
    kinds = np.full(256, BLANK, np.uint8)
    kinds[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = WORD
    kinds[128:] = WORD
    return kinds


KINDS = byte_kinds()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of the texts in lower case, and the number of its text."""
    column = pa.array([t.lower() for t in texts], pa.string())
    _, offsets, content = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(texts) + 1]
    if not ends[-1]:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    kinds = KINDS[np.frombuffer(content, np.uint8)[: ends[-1]]]
    begins = np.empty(len(kinds), bool)
    begins[1:] = kinds[1:] != kinds[:-1]
    begins[ends[:-1][np.diff(ends) > 0]] = True
    starts = np.flatnonzero(begins)
    cuts = np.append(starts, len(kinds)).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cuts), content)
    parts = parts.filter(pa.array(kinds[starts] == WORD)).dictionary_encode()
    distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
    hashes = np.fromiter((zlib.crc32(w.encode()) for w in distinct), np.uint32, len(distinct))
    of = np.searchsorted(ends, starts[kinds[starts] == WORD], side="right") - 1
    return hashes[parts.indices.to_numpy()], of


def features(hashes: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the features and the texts they are in: words, then pairs of words at each distance."""
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    yield (hashes * np.uint32(0x9E3779B1)) >> shift, of
    for distance, (a, b) in enumerate(MIX, 1):
        first, second = hashes[:-distance], hashes[distance:]
        same = of[:-distance] == of[distance:]
        yield ((first * np.uint32(a) ^ second * np.uint32(b)) * np.uint32(0x9E3779B1) >> shift)[same], of[distance:][same]


@dataclass
class Weights:
    """The features whose weight is not zero, their weights, and the bias."""

    numbers: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(FEATURES, np.float32)
        table[self.numbers] = self.values
        return table


def scores(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The chance that each text is toxic. A feature counts once in a text."""
    hashes, of = word_hashes(texts)
    keys = []
    for numbers, within in features(hashes, of):
        heavy = table[numbers] != 0
        keys.append(within[heavy] * FEATURES + numbers[heavy])
    found = np.unique(np.concatenate(keys))
    sums = np.bincount(found // FEATURES, table[found % FEATURES], len(texts))
    return 1 / (1 + np.exp(-np.clip(sums + bias, -500, 500)))


def ftrl(examples: list[tuple[np.ndarray, float]]) -> Weights:
    """Weights after EPOCHS passes over (features, label) in the order given."""
    n, z = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)

    def weights(n: np.ndarray, z: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for numbers, label in examples:
            # The last place is the bias, which every example has.
            at = np.append(numbers, FEATURES)
            nn, zz = n[at], z[at]
            w = weights(nn, zz)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -500, 500))) - label
            more = nn + gradient * gradient
            z[at] = zz + gradient - (np.sqrt(more) - np.sqrt(nn)) / ALPHA * w
            n[at] = more
    w = weights(n, z)
    numbers = np.flatnonzero(w[:-1])
    return Weights(numbers.astype(np.int32), w[numbers].astype(np.float32), float(w[-1]))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """``text`` and ``toxic`` of about ``rows`` labelled documents, in an order of their own.

    Labels are chosen before documents are read for them, so the side that is sent to every task
    has about ``rows`` rows. A document with several labels has the largest; rows without an id,
    text or label teach nothing.
    """
    labels = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    labels = stored(labels)
    share = F.lit(min(1.0, rows / max(1, labels.count())))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labels.where(place < share)
    return docs.select("doc_id", "text").dropna().join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Weights:
    """Fit on a bounded sample of labelled documents: features in many tasks, the passes in one.

    Without a labelled document every score is a half.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            hashes, of = word_hashes(texts)
            keys = np.unique(np.concatenate([w * FEATURES + f for f, w in features(hashes, of)]))
            cuts = np.searchsorted(keys, np.arange(len(texts) + 1) * FEATURES).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array((keys % FEATURES).astype(np.int32)))
            order = pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([order, batch.column("toxic"), lists], ["place", "toxic", "features"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            lists, labels = batch.column("features"), batch.column("toxic").to_pylist()
            examples += [(lists[i].values.to_numpy(), float(y)) for i, y in enumerate(labels)]
        found = ftrl(examples)
        yield pa.RecordBatch.from_arrays(
            [pa.array([found.bias]), pa.array([found.numbers.tolist()], pa.list_(pa.int32())), pa.array([found.values.tolist()], pa.list_(pa.float32()))],
            ["bias", "numbers", "values"],
        )

    examples = sample(docs, labels, rows).mapInArrow(extract, "place long, toxic int, features array<int>")
    # One place to learn in: the sample's bound is what makes this fit.
    fitted = examples.repartition(1).sortWithinPartitions("place", "toxic", "features")
    found = fitted.mapInArrow(fit, "bias double, numbers array<int>, values array<float>").collect()
    if not found:
        return Weights(np.empty(0, np.int32), np.empty(0, np.float32), 0.0)
    row = found[0]
    return Weights(np.array(row["numbers"], np.int32), np.array(row["values"], np.float32), row["bias"])


def score(docs: DataFrame, weights: Weights, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``score``, the chance that the row's whole ``text`` is toxic.

    NULL and empty texts get what the bias says. Nothing is shuffled.
    """
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table = model.dense()
        for batch in small_batches(batches, "_text"):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            found = pa.array(scores(texts, table, model.bias), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), found], [*keep, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kinds}, score double")
