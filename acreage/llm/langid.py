"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of varying length holds how often each byte followed.
A text's code length under a tree is the sum over its bytes of -log2 of the chance the tree gives
it: the longest context that is known predicts, and what it has never seen followed costs an
escape to the next shorter one, whose bytes already ruled out are left aside. Statistics are
frozen after training. Each stretch of a text counts for the language with the shortest code, and
the language of most of the text is the prediction: a passage in another one, whose code is long
under all languages but its own, does not outweigh the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.llm.common import CHARS_AT_ONCE, small_batches
from acreage.sources.writers import stored

# Longest context in bytes.
ORDER = 4
# Labelled texts a language is learned from: about this many whole texts, chosen by a hash of
# the text; all of them if a language has fewer.
SAMPLE_PER_LANGUAGE = 600
# Languages whose trees are one automaton; more are several of those, and a task holds one at a time.
LANGUAGES_AT_ONCE = 4
# Pairs of context and byte of each language that reach the driver: its most frequent ones.
ENTRIES = 75_000
# Counts from here on are one class; classes that have to be cut are cut by a hash into so many buckets.
HIGHEST_CLASS, BUCKETS = 100_000, 1024
# Contexts of each language in its tree: its most frequent ones, whatever languages are beside it.
CONTEXTS = 3072
# Characters of text that are scored by one automaton after another before the next are read.
CHARS_IN_TURN = 8_000_000
UNKNOWN = "und"
LETTER = re.compile("[A-Za-z]")
# Bytes of a stretch that is given to one language.
STRETCH = 192
# Bytes a column of the scoring table reads one after another.
STRIDE = 512


@dataclass
class Trees:
    """All languages' trees as one automaton: a state is the longest known context.

    ``follow[state, symbol]`` is the next state and ``bits[language, state, symbol]`` the code
    length, where a symbol is a byte that occurred in training, and 0 any other.
    """

    languages: list[str]
    symbols: np.ndarray
    follow: np.ndarray
    bits: np.ndarray

    def lengths(self, texts: list[bytes], stretch: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code length in bits of each stretch of each text under each language, with the number
        of its text and its size; without ``stretch`` each text is one. Empty texts have none.

        All texts lie behind one another, each after ORDER line feeds, so no context reaches
        into another text. Many places are read at once: a state depends on the last ORDER bytes
        alone, so each column of the table starts ORDER bytes early.
        """
        pad = b"\n" * ORDER
        stream = self.symbols[np.frombuffer(b"".join([pad + t for t in texts]), np.uint8)]
        sizes = np.fromiter((len(t) + ORDER for t in texts), np.int64, len(texts))
        width = self.follow.shape[1]
        columns = -(-len(stream) // STRIDE)
        padded = np.zeros(columns * STRIDE + ORDER, stream.dtype)
        padded[ORDER : ORDER + len(stream)] = stream
        steps = np.lib.stride_tricks.as_strided(
            padded, (columns, STRIDE + ORDER), (STRIDE * padded.itemsize, padded.itemsize)
        ).T.copy()
        follow = self.follow.ravel()
        at = np.empty((STRIDE, columns), np.int32)
        state = np.zeros(columns, np.int32)
        for step in range(STRIDE + ORDER):
            place = state * width
            place += steps[step]
            if step >= ORDER:
                at[step - ORDER] = place
            state = follow.take(place)
        places = at.T.reshape(-1)[: len(stream)]
        ends = np.cumsum(sizes)
        starts = ends - sizes + ORDER
        step = stretch or max(1, int(sizes.max()))
        parts = -(-(sizes - ORDER) // step)
        of = np.repeat(np.arange(len(texts)), parts)
        begins = starts[of] + step * (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts))
        stops = np.minimum(begins + step, ends[of])
        cuts = np.stack([begins, stops], 1).ravel()
        out = np.zeros((len(of), len(self.languages)))
        for number, bits in enumerate(self.bits):
            taken = np.append(bits.ravel().take(places), np.float32(0)).astype(np.float64)
            if len(cuts):
                out[:, number] = np.add.reduceat(taken, cuts)[::2]
        return out, of, stops - begins

    def decide(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """The language of most of each text, ties to the shorter code of the whole, and the share
        of the text that is in it."""
        bits, of, sizes = self.lengths(texts, STRETCH)
        return vote(self.languages, bits.argmin(1), of, sizes, wholes(bits, of, len(texts)))


def wholes(bits: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """The code length of each whole text under each language from those of its stretches."""
    return np.stack([np.bincount(of, column, texts) for column in bits.T], 1)


def vote(languages: list[str], best: np.ndarray, of: np.ndarray, sizes: np.ndarray, whole: np.ndarray) -> tuple[list[str], list[float]]:
    """See ``Trees.decide``; ``best`` is the language of each stretch."""
    count = len(languages)
    shares = np.bincount(of * count + best, sizes, len(whole) * count).reshape(-1, count)
    tied = shares == shares.max(1, keepdims=True)
    chosen = np.where(tied, whole, np.inf).argmin(1)
    return [languages[b] for b in chosen.tolist()], (shares[np.arange(len(whole)), chosen] / np.maximum(shares.sum(1), 1)).tolist()


@dataclass
class Portions:
    """More languages than one automaton holds: their counts, laid out some at a time."""

    languages: list[str]
    symbols: np.ndarray
    counts: DataFrame

    def trees(self, first: int) -> Trees:
        own = self.languages[first : first + LANGUAGES_AT_ONCE]
        return lay_out(self.counts.where(F.col("lang").isin(own)).toArrow(), own, self.symbols)

    def shared(self) -> list:
        """One automaton after the other, sent to the executors."""
        context = self.counts.sparkSession.sparkContext
        return [context.broadcast(self.trees(n)) for n in range(0, len(self.languages), LANGUAGES_AT_ONCE)]


def has_letter(text: str | None) -> bool:
    """Whether there is a character of Unicode's category L: no digit, fraction or Roman numeral."""
    return bool(text) and (bool(LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text))))


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``text`` and ``lang`` of the labelled rows to learn from.

    The share of each language's rows follows from its count, so no language is gathered in one
    place to choose among its rows.
    """
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).dropna()
    counts = rows.groupBy("lang").count()
    shares = stored(counts.select("lang", (F.lit(float(per_language)) / F.col("count")).alias("share")))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(shares, "lang").where(place < F.col("share")).select("text", "lang")


def context_counts(texts: DataFrame) -> DataFrame:
    """How often each byte follows each context of up to ORDER bytes, by language.

    ``entry`` packs the context and the byte after it, ``size`` is the length of the context.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = b"\n" * ORDER
        for batch in small_batches(batches):
            by_language: dict[str, list[bytes]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                by_language.setdefault(lang, []).append(pad + text.encode())
            for lang, parts in by_language.items():
                stream = np.frombuffer(b"".join(parts), np.uint8)
                real = np.ones(len(stream), bool)
                firsts = np.cumsum([0, *map(len, parts[:-1])])
                for k in range(ORDER):
                    real[firsts + k] = False
                at = np.flatnonzero(real)
                for size in range(ORDER + 1):
                    packed = np.zeros(len(at), np.int64)
                    for back in range(size, -1, -1):
                        packed = packed << 8 | stream[at - back]
                    entries, numbers = np.unique(packed, return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([lang] * len(entries), pa.string()),
                            "size": pa.array(np.full(len(entries), size, np.int32)),
                            "entry": pa.array(entries, pa.int64()),
                            "n": pa.array(numbers, pa.int64()),
                        }
                    )

    counted = texts.mapInArrow(run, "lang string, size int, entry long, n long")
    return counted.groupBy("lang", "size", "entry").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Trees | Portions:
    """Trees of the languages in ``lang``; rows without a text or language teach nothing.

    Counts are made and added up in tasks. The ENTRIES most frequent ones of each language are
    sent to the driver, which lays out the trees: all of them, or those of LANGUAGES_AT_ONCE at a
    time when they are needed.
    """
    counts = stored(context_counts(sample(docs, per_language)))
    rows = stored(most_frequent(counts, ENTRIES))
    languages = sorted(row["lang"] for row in rows.select("lang").distinct().collect())
    seen = sorted(row["entry"] for row in rows.where(F.col("size") == 0).select("entry").distinct().collect())
    symbols = np.zeros(256, np.int32)
    symbols[seen] = np.arange(1, len(seen) + 1)
    if len(languages) > LANGUAGES_AT_ONCE:
        return Portions(languages, symbols, rows)
    return lay_out(rows.toArrow(), languages, symbols)


def lay_out(rows: pa.Table, languages: list[str], symbols: np.ndarray) -> Trees:
    """The automaton of some languages. Each has its own CONTEXTS most frequent contexts and says
    nothing of others', so its code lengths do not depend on the languages beside it."""
    width = int(symbols.max()) + 1
    langs, sizes, entries, numbers = (rows.column(c).to_numpy() for c in ("lang", "size", "entry", "n"))
    own_rows = {language: np.flatnonzero(langs == language) for language in languages}
    own_nodes: dict[str, set[bytes]] = {}
    for language, own in own_rows.items():
        # A context and its length as one number; the sum of its counts is how often it occurred.
        contexts, of = np.unique(sizes[own].astype(np.int64) << 40 | entries[own] >> 8, return_inverse=True)
        totals = np.bincount(of, numbers[own], len(contexts)).astype(np.int64)
        best = np.sort(contexts[np.lexsort((contexts, -totals))[:CONTEXTS]])
        known = own_nodes[language] = {b""}
        for context in best.tolist():
            name = (context & (1 << 40) - 1).to_bytes(context >> 40, "big")
            if name and name[:-1] in known and name[1:] in known:
                known.add(name)
    nodes = {name: number for number, name in enumerate(sorted(set().union(*own_nodes.values(), {b""}), key=lambda n: (len(n), n)))}
    parent = np.array([nodes[name[1:]] if name else -1 for name in nodes])
    follow = np.zeros((len(nodes), width), np.int32)
    for size in range(ORDER + 1):
        for name, node in nodes.items():
            if len(name) == size and name:
                follow[node] = follow[parent[node]]
        for name, node in nodes.items():
            if len(name) == size + 1:
                follow[nodes[name[:-1]], symbols[name[-1]]] = node
    bits = np.zeros((len(languages), len(nodes), width), np.float32)
    for number, language in enumerate(languages):
        own = own_rows[language]
        names = [int(e >> 8).to_bytes(s, "big") for e, s in zip(entries[own].tolist(), sizes[own].tolist())]
        known = np.array([nodes[n] if n in own_nodes[language] else -1 for n in names], np.int64)
        held = known >= 0
        table = np.zeros((len(nodes) + 1, width))
        table[known[held], symbols[entries[own][held] & 255]] = numbers[own][held]
        bits[number] = code_lengths(table, parent)
    return Trees(languages, symbols, follow, bits)


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Of each language the ``most`` rows with the highest counts, exactly, ties by a hash.

    No language is sorted in one task: classes of equal counts are taken whole as long as they
    fit, the class that has to be cut is taken by buckets, and only rows of the bucket that has to be cut
    are put in order.
    """
    keyed = counts.withColumns(
        {"_class": F.least("n", F.lit(HIGHEST_CLASS)), "_bucket": F.pmod(F.xxhash64("size", "entry"), F.lit(BUCKETS))}
    )

    def reached(rows: DataFrame, by: str, first: Column, left: Column) -> DataFrame:
        """Groups that fit at least in part into what is left of a language, in order, with how
        many of their rows do."""
        sizes = rows.groupBy("lang", by).agg(F.count("*").alias("_rows"), F.max(left).alias("_left"))
        before = F.sum("_rows").over(Window.partitionBy("lang").orderBy(first)) - F.col("_rows")
        sizes = sizes.withColumn("_left", F.col("_left") - before).where(F.col("_left") > 0)
        return stored(sizes.withColumn("_whole", F.col("_rows") <= F.col("_left")))

    def split(rows: DataFrame, groups: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
        met = rows.join(groups.select("lang", by, "_left", "_whole"), ["lang", by])
        return met.where("_whole").select(*rows.columns), met.where("not _whole").drop("_whole")

    classes = reached(keyed, "_class", F.desc("_class"), F.lit(most))
    whole, cut = split(keyed, classes, "_class")
    cut = stored(cut)
    buckets = reached(cut, "_bucket", F.asc("_bucket"), F.col("_left"))
    more, rest = split(cut.drop("_left"), buckets, "_bucket")
    order = Window.partitionBy("lang").orderBy("size", "entry")
    rest = rest.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= F.col("_left"))
    return whole.unionByName(more).unionByName(rest.select(*keyed.columns)).select(*counts.columns)


def code_lengths(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The exact code length of each symbol after each context, with escapes and exclusions.

    A context that was seen n times with d different symbols gives a symbol seen c times
    c / (n + d) and the escape d / (n + d). ``counts`` has an empty row at the end, which the
    shortest context's parent -1 names; below it, symbols not ruled out share what is left.
    """
    size = len(parent)
    at, escaped = np.arange(size), np.zeros(size)
    out = np.full((size, counts.shape[1]), np.nan)
    ruled_out = np.zeros(out.shape, bool)
    for _ in range(ORDER + 1):
        here = np.where(ruled_out, 0, counts[at])
        total, different = here.sum(1), (here > 0).sum(1)
        known = total > 0
        whole = np.where(known, total + different, 1)
        seen = here > 0
        chance = np.where(seen, here, 1) / whole[:, None]
        out = np.where(seen, escaped[:, None] - np.log2(chance), out)
        ruled_out |= seen
        escaped = escaped - np.where(known, np.log2(np.where(known, different, 1) / whole), 0)
        at = np.where(at >= 0, np.append(parent, -1)[at], -1)
    left = np.maximum((~ruled_out).sum(1), 1)
    return np.where(np.isnan(out), (escaped + np.log2(left))[:, None], out)


def decide_in_turn(shared: list, languages: list[str], texts: list[bytes]) -> tuple[list[str], list[float]]:
    """``Trees.decide`` for languages of several automata, one of which is held at a time."""
    least = best = of = sizes = None
    whole, first = [], 0
    for one in shared:
        # Read from the executor's copy each time: a value that is asked for stays in memory.
        trees = one.load_from_path(one._path) if len(shared) > 1 else one.value
        bits, of, sizes = trees.lengths(texts, STRETCH)
        whole.append(wholes(bits, of, len(texts)))
        shortest, found = bits.min(1), bits.argmin(1) + first
        first += len(trees.languages)
        if least is None:
            least, best = shortest, found
        else:
            best, least = np.where(shortest < least, found, best), np.minimum(least, shortest)
    return vote(languages, best, of, sizes, np.concatenate(whole, 1))


def predict(
    docs: DataFrame, trees: Trees | Portions, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` for the whole ``text`` of each row, with ``text`` itself
    if wanted: a text that is to come along goes to the worker once.

    The score is the share of the text that is in the language. A NULL text, one without a letter,
    and every text if nothing was learned are ``und`` with score 0.
    """
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    languages, in_turn = trees.languages, isinstance(trees, Portions)
    shared = trees.shared() if in_turn else [docs.sparkSession.sparkContext.broadcast(trees)]
    chars = CHARS_IN_TURN if in_turn else CHARS_AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_text", chars):
            texts = batch.column("_text").to_pylist()
            found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            places = [i for i, t in enumerate(texts) if languages and has_letter(t)]
            if places:
                read = [texts[i].encode() for i in places]
                answers = decide_in_turn(shared, languages, read) if in_turn else shared[0].value.decide(read)
                for i, lang, share in zip(places, *answers):
                    found[i], scores[i] = lang, share
            answers = [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            columns = [*(batch.column(c) for c in keep), *([batch.column("_text")] if with_text else []), *answers]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *(["text"] if with_text else []), "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{kinds}, {'text string, ' if with_text else ''}lang_pred string, score double")
