import random

import numpy as np
import pytest

from acreage.llm import runs
from acreage.llm.queries import with_planted_runs


def brute(words):
    """Runs by trying every period, longest stretches of equal words a period apart."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                out.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words):
    gone = {i for s, n, q in brute(words) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def samples():
    rnd = random.Random(5)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 300, ["a", "b"] * 3 + ["a"], ["a", "b"] * 4, list("aabaabaabaab" * 3)]
    for size in (8, 20, 60, 200):
        for letters in (1, 2, 3, 5):
            for _ in range(12):
                out.append([rnd.choice("abcdefgh"[:letters]) for _ in range(size)])
    for _ in range(60):
        words = []
        for _ in range(rnd.randrange(1, 6)):
            block = [rnd.choice("abcdxyz") for _ in range(rnd.randrange(1, 9))]
            words += block * rnd.randrange(1, 9) + block[: rnd.randrange(len(block) + 1)]
        out.append(words)
    a, b = ["a"], ["a", "b"]
    for _ in range(9):
        a, b = b, b + a
    return [*out, b, (b[:30] * 5 + ["x"]) * 6]


def test_runs_equal_those_of_every_period():
    texts = samples()
    together = runs.find_in([[w.encode() for w in t] for t in texts])
    for words, found in zip(texts, together):
        assert found == brute(words), words
        assert runs.collapsed([w.encode() for w in words], found).decode() == brute_collapsed(words)


def test_suffix_array_and_shared_lengths():
    rnd = np.random.default_rng(2)
    text = np.concatenate([rnd.integers(0, 3, 200), np.zeros(70, int), [99]])
    order, inverse, shared = runs.suffix_array(text)
    suffixes = [text[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes) and (inverse[order] == np.arange(len(text))).all()
    for a, b, n in zip(suffixes, suffixes[1:], shared[1:].tolist()):
        assert a[:n] == b[:n] and a[n] != b[n]


def test_look_ups_in_portions(monkeypatch):
    monkeypatch.setattr(runs, "LOOK_UPS", 7)
    words = list("abcabcabcabcabc" * 4 + "aaaaaaaab" * 5)
    assert runs.find_in([[w.encode() for w in words]])[0] == brute(words)


def test_a_long_text_of_one_word():
    n = 300_000
    assert runs.find_in([[b"w"] * n]) == [[(0, n, 1)]]


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "a\x0ba\x0ca\ra a b a a a a a a"), (4, "é é é é é é x"), (None, "a b a b a b a b"), (5, "x " * 40_000)]
    rows = [(i, t, 7, "r", "c") for i, t in texts]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, n_words int, runs string, collapsed string")
    out = runs.find(docs).collect()
    assert len(out) == 8
    by_text = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out]
    for (doc, text), got in zip(texts, by_text):
        words = [w.decode() for w in (text or "").encode().split()]
        if len(words) < 1000:
            assert got == (doc, len(words), brute(words), brute_collapsed(words))
    assert by_text[6] == (5, 40_000, [(0, 40_000, 1)], "x")
    assert runs.find(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 7, 500])
def test_planted_runs(spark, size):
    from zlib import crc32

    rows = [(i, " ".join(f"w{i}x{k % 97}" for k in range(size))) for i in range(60)] + [(None, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in with_planted_runs(docs).collect()}
    for doc, text in rows:
        h, words = crc32(str(doc if doc is not None else "").encode()), text.split()
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert (got[doc] or "").split() == words
