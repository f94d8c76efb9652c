"""Periodic runs of words, by branching squares found in an enhanced suffix array.

Two suffixes that lie a distance p apart and share exactly p words begin a square of period p that
cannot be moved to the right. Both lie in the same interval of the suffix array, of depth p, and
in different children of it. So for each interval the suffixes of all children but the largest
look up, by the inverse suffix array, whether the suffix a depth before or behind lies in the
interval. Every run has one such square at its end; turning it to the left finds the run's start.
Intervals are bounds in the array, and no tree is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import small_batches

# A run is at least so many words, and so many times its period.
LEAST_LENGTH, LEAST_EXPONENT = 6, 4
# Look-ups made at a time.
LOOK_UPS = 1 << 22


def stretches(codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of words that may be in a run, and the stretch of neighbouring ones each is in.

    Each word of a run occurs at least LEAST_EXPONENT times in it, and in any stretch around it.
    Other words end a stretch, and so may make words of the shorter stretches rare in turn.
    """
    places, groups = np.arange(len(codes)), docs
    while len(places):
        _, word, counts = np.unique(groups * (int(codes.max()) + 1) + codes[places], return_inverse=True, return_counts=True)
        stays = counts[word] >= LEAST_EXPONENT
        places, groups = places[stays], groups[stays]
        if not len(places):
            break
        cut = np.flatnonzero((np.diff(places) != 1) | (np.diff(groups) != 0)) + 1
        sizes = np.diff(np.concatenate([[0], cut, [len(places)]]))
        each = np.repeat(np.arange(len(sizes)), sizes)
        long_enough = np.repeat(sizes >= LEAST_LENGTH, sizes)
        if stays.all() and long_enough.all():
            return places, each
        places, groups = places[long_enough], each[long_enough]
    return places, places


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of numbers that end in one of a kind, its inverse, and how much each
    suffix shares with the one before it.

    Suffixes are sorted by twice as many numbers in each round, those that are told apart already
    left out. The rank of every round is kept, so that shared lengths are found by halving.
    """
    n = len(text)
    _, first, counts = np.unique(text, return_inverse=True, return_counts=True)
    # The rank of a suffix is the number of suffixes that are smaller as far as they were sorted.
    rank = (np.cumsum(counts) - counts)[first].astype(np.int32)
    open_ = np.flatnonzero(counts[first] > 1)
    ranks, step = [rank], 1
    while len(open_):
        rank = rank.copy()
        key = rank[open_].astype(np.int64) * (n + 1) + ranks[-1][open_ + step]
        order = np.argsort(key, kind="stable")
        open_, key = open_[order], key[order]
        begins = np.concatenate([[True], key[1:] != key[:-1]])
        old = ranks[-1][open_]
        old_begins = np.concatenate([[True], old[1:] != old[:-1]])
        at = np.arange(len(open_))
        new = old + np.maximum.accumulate(np.where(begins, at, 0)) - np.maximum.accumulate(np.where(old_begins, at, 0))
        rank[open_] = new
        ends = np.concatenate([begins[1:], [True]])
        open_ = open_[~(begins & ends)]
        ranks.append(rank)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    shared = np.zeros(n, np.int64)
    left, right, length = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][np.minimum(left + length, n - 1)] == ranks[level][np.minimum(right + length, n - 1)]
        length += same.astype(np.int64) << level
    shared[1:] = length
    return order, rank, shared


def smaller_children(shared: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(begin, end, depth, low, high): the children of each interval but its largest, with the
    interval. Ends are exclusive."""
    stack: list[tuple[int, int, list[int]]] = []
    for place in range(1, len(shared) + 1):
        depth = shared[place] if place < len(shared) else 0
        if not depth and not stack:
            continue
        low = place - 1
        while stack and stack[-1][0] > depth:
            closed, low, splits = stack.pop()
            bounds = [low, *splits, place]
            largest = max(range(len(splits) + 1), key=lambda c: bounds[c + 1] - bounds[c])
            for child in range(len(splits) + 1):
                if child != largest:
                    yield bounds[child], bounds[child + 1], closed, low, place
        if depth:
            if stack and stack[-1][0] == depth:
                stack[-1][2].append(place)
            else:
                stack.append((depth, low, [place]))


def branching_squares(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares of ``text`` that cannot be moved to the right."""
    order, inverse, shared = suffix_array(text)
    parts = np.array(list(smaller_children(shared.tolist())), np.int64).reshape(-1, 5)
    sizes = parts[:, 1] - parts[:, 0]
    starts, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    upto = np.cumsum(sizes)
    at = 0
    while at < len(parts):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] - sizes[at] + LOOK_UPS, "right")))
        some, each = parts[at:to], sizes[at:to]
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        begin, _, depth, low, high = np.repeat(some, each, axis=0).T
        suffix = order[begin + within]
        for other, square in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
            inside = (other >= 0) & (other < len(text))
            found = inverse[np.where(inside, other, 0)]
            inside &= (low <= found) & (found < high)
            start, period = square[inside], depth[inside]
            ends = text[start + period] != text[start + 2 * period]
            starts.append(start[ends])
            periods.append(period[ends])
        at = to
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    return both[0], both[1]


def run_start(text: np.ndarray, start: int, period: int) -> int:
    """Where the square's run begins: it is turned to the left as far as it goes."""
    size = 64
    while start > 0:
        low = max(0, start - size)
        differs = np.flatnonzero(text[low:start] != text[low + period : start + period])
        if len(differs):
            return low + int(differs[-1]) + 1
        start, size = low, size * 2
    return 0


def runs_of(text: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, by start and period."""
    start, period = branching_squares(text)
    end = start + 2 * period
    # Before anything is turned: the run has to reach back far enough, and its first and last steps to fit.
    least = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    first = end - least
    fits = first >= 0
    fits &= text[np.maximum(first, 0)] == text[np.maximum(first, 0) + period]
    fits &= text[np.maximum(start - 1, 0)] == text[np.maximum(start - 1, 0) + period]
    out, known = [], {}
    order = np.lexsort((period[fits], end[fits]))
    for p, e, n in zip(period[fits][order].tolist(), end[fits][order].tolist(), least[fits][order].tolist()):
        # A square inside a run that ends with it repeats that run's period.
        if e - known.get(e, e) >= 2 * p:
            continue
        begin = run_start(text, e - 2 * p, p)
        if e - begin >= n:
            out.append((begin, e - begin, p))
            known[e] = begin
    return sorted(out, key=lambda r: (r[0], r[2]))


def find_in(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not sizes.sum():
        return out
    codes = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    docs = np.repeat(np.arange(len(texts)), sizes)
    places, groups = stretches(codes, docs)
    if not len(places):
        return out
    # Stretches one behind the other, each its own words and then a number of its own.
    _, words = np.unique(groups * (int(codes.max()) + 1) + codes[places], return_inverse=True)
    at = np.arange(len(places)) + groups
    text = np.empty(len(places) + int(groups[-1]) + 1, np.int64)
    text[:] = len(places) + np.arange(len(text))
    text[at] = words
    place_of = np.zeros(len(text), np.int64)
    place_of[at] = places
    first = np.cumsum(sizes) - sizes
    for start, length, period in runs_of(text):
        place = int(place_of[start])
        doc = int(docs[place])
        out[doc].append((place - int(first[doc]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, of each run only its first period."""
    if not runs:
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    kept = np.cumsum(marks[:-1]) == 0
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


def find(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` with ``n_words``, ``runs`` and ``collapsed`` of each row's whole text.

    Words are what blanks, tabs, line feeds and the like of ASCII part. A run is a stretch of at
    least LEAST_LENGTH words and LEAST_EXPONENT times its smallest period, that neither neighbour
    continues; ``runs`` holds start (a word number from 0), length and period of each, by start
    and then period. ``collapsed`` is the text with the words of every run that come after its first
    period left out, joined by blanks.

    NULL and empty texts have no words, no runs and an empty ``collapsed``. Rows are handled where
    they are read, each by itself, so repeated rows and ids do not matter; an empty table gives
    no rows. A text is one row of one task, and needs memory in proportion to its repeated words
    times the logarithm of its longest repeat.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            # On bytes, split() parts words at the six white-space characters of ASCII.
            words = [t.split() if t else [] for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            runs = find_in(words)
            columns = [
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], kind),
                pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, "n_words", "runs", "collapsed"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kinds}n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
