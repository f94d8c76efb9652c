import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.llm import langid

TEXTS = {"en": "the cat and the other dog that is there, with them", "de": "der hund und die katze, das ist nicht über"}


@pytest.fixture(scope="module")
def trees(spark):
    rows = [(t, lang) for lang, t in TEXTS.items()] * 3 + [(None, "en"), ("lost", None)]
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def code_length(text, training, symbols):
    """Prediction by partial matching as it is written down: one text, one byte at a time."""
    counts = defaultdict(Counter)
    for t in training:
        data = b"\n" * langid.ORDER + t.encode()
        for i in range(langid.ORDER, len(data)):
            for size in range(langid.ORDER + 1):
                counts[data[i - size : i]][data[i]] += 1
    data, bits = b"\n" * langid.ORDER + text.encode(), 0.0
    for i in range(langid.ORDER, len(data)):
        out, symbol = set(), data[i]
        known = max((s for s in range(langid.ORDER + 1) if data[i - s : i] in symbols), default=0)
        for size in range(known, -1, -1):
            here = {b: c for b, c in counts[data[i - size : i]].items() if b not in out}
            total, different = sum(here.values()), len(here)
            if symbol in here:
                bits -= math.log2(here[symbol] / (total + different))
                break
            if total:
                bits -= math.log2(different / (total + different))
            out |= set(here)
        else:
            bits += math.log2(max(1, symbols["width"] - len(out)))
    return bits


def test_code_lengths_are_those_of_the_definition(trees):
    contexts = {"width": trees.follow.shape[1]}
    for t in TEXTS.values():
        data = b"\n" * langid.ORDER + t.encode()
        for i in range(langid.ORDER, len(data)):
            for size in range(langid.ORDER + 1):
                contexts[data[i - size : i]] = 1
    texts = ["the hund", "über there", "zzz", "a", "", "die katze " * 200]
    bits, of, _ = trees.lengths([t.encode() for t in texts])
    assert of.tolist() == [0, 1, 2, 3, 5]
    got = np.zeros((len(texts), len(trees.languages)))
    got[of] = bits
    for number, lang in enumerate(trees.languages):
        want = [code_length(t, [TEXTS[lang]] * 3, contexts) for t in texts]
        assert np.allclose(got[:, number], want, rtol=1e-4, atol=1e-3)


def test_a_text_costs_the_same_in_any_company(trees):
    texts = [b"the other", b"die katze" * 300, b"x" * 2000, "über".encode()]
    alone = np.concatenate([trees.lengths([t])[0] for t in texts])
    assert np.allclose(alone, trees.lengths(texts)[0])
    stretches, of, sizes = trees.lengths(texts, 100)
    assert np.bincount(of, sizes).tolist() == [len(t) for t in texts] and sizes.max() == 100
    assert np.allclose([stretches[of == k].sum(0) for k in range(4)], alone)


def test_a_passage_in_another_language_does_not_decide(trees):
    text = TEXTS["en"] * 9 + TEXTS["de"] * 6
    assert trees.decide([text.encode()])[0] == ["en"]


def test_predictions_and_what_is_rejected(trees, make_docs):
    texts = ["there is the dog", "nicht die katze", None, "", "123 456!", "é", "the " * 50_000]
    rows = {r.doc_id: r for r in langid.predict(make_docs(texts), trees).collect()}
    assert [rows[i].lang_pred for i in range(7)] == ["en", "de", "und", "und", "und", rows[5].lang_pred, "en"]
    assert rows[5].lang_pred != "und" and rows[2].score == 0 and all(0 <= r.score <= 1 for r in rows.values())


def test_letters_are_those_of_category_l(trees, make_docs):
    texts = ["½ ①②", "Ⅷ", "²³", "٣٤", "½ a", "ß", "日本", "ʰ", "_", "\u0301"]
    found = {r.doc_id: r.lang_pred for r in langid.predict(make_docs(texts), trees).collect()}
    assert [found[i] != "und" for i in range(10)] == [False, False, False, False, True, True, True, True, False, False]


@pytest.mark.parametrize("most", [1, 10, 75_000, 80_009, 80_010, 90_000])
def test_the_most_frequent_entries_exactly(spark, most):
    """A class of equal counts that is larger than what is left is cut, not left out; a count beyond
    the highest class does not make a language vanish."""
    rows = spark.range(80_010).select(
        F.lit("a").alias("lang"), F.lit(3).alias("size"), F.col("id").alias("entry"),
        F.when(F.col("id") < 5, 300_000).when(F.col("id") < 10, 2).otherwise(1).cast("long").alias("n"),
    )
    rows = rows.unionByName(spark.createDataFrame([("b", 1, 7, 1)], rows.schema))
    got = langid.most_frequent(rows, most)
    assert got.columns == rows.columns
    by = {r["lang"]: r for r in got.groupBy("lang").agg(F.count("*").alias("rows"), F.count_distinct("entry").alias("d"), F.sum("n").alias("n")).collect()}
    own = min(most, 80_010)
    assert by["a"]["rows"] == by["a"]["d"] == own and by["b"]["rows"] == 1
    assert by["a"]["n"] == 300_000 * min(own, 5) + 2 * max(0, min(own, 10) - 5) + max(0, own - 10)


def test_a_language_costs_the_same_beside_any_others(spark, monkeypatch):
    rnd = np.random.default_rng(11)
    rows = [(" ".join("".join(rnd.choice(list("abcdefgh"), 5)) for _ in range(400)), lang) for lang in "abcde"]
    monkeypatch.setattr(langid, "CONTEXTS", 60)
    texts = [b"abc def gha", rows[0][0].encode()]
    together = langid.train(spark.createDataFrame(rows[:4], "text string, lang string"))
    symbols = together.symbols
    for number in range(4):
        alone = langid.train(spark.createDataFrame([rows[number]], "text string, lang string"))
        assert (alone.symbols > 0).sum() == (symbols > 0).sum()
        assert np.allclose(alone.lengths(texts)[0][:, 0], together.lengths(texts)[0][:, number])


def test_nothing_to_learn_and_nothing_to_read(spark, make_docs):
    empty = langid.train(make_docs([]))
    assert [r.lang_pred for r in langid.predict(make_docs(["words"]), empty).collect()] == ["und"]
    assert langid.predict(make_docs([]), empty).count() == 0


def test_every_language_has_its_own_budget(spark, make_docs, monkeypatch):
    # 300 languages, each of words of its own; one has a single text beside the others' ten.
    rnd = np.random.default_rng(9)
    words = {f"l{k:03}": ["".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(5)] for k in range(300)}
    rows = [(" ".join(w), lang) for lang, w in words.items() for _ in range(1 if lang == "l299" else 10)]
    monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", 60)
    portions = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert len(portions.languages) == 300
    texts = [" ".join(w[::-1]) for w in words.values()] + [None, "12"]
    found = {r.doc_id: r for r in langid.predict(make_docs(texts), portions).collect()}
    assert [found[i].lang_pred for i in range(302)] == [*words, "und", "und"]


def test_languages_in_turn_are_as_all_at_once(spark, trees, make_docs, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES_AT_ONCE", 1)
    rows = [(t, lang) for lang, t in TEXTS.items()] * 3
    portions = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    texts = ["there is the dog", "nicht die katze", None, "", "é", TEXTS["en"] * 9 + TEXTS["de"] * 6, "the " * 500]
    want = langid.predict(make_docs(texts), trees).orderBy("doc_id").collect()
    assert langid.predict(make_docs(texts), portions).orderBy("doc_id").collect() == want


def test_held_out_accuracy(spark):
    from acreage.llm.queries import op9_language_id

    folder = "/root/testdata/sf0.01"
    found = op9_language_id(spark, folder).where("held_out")
    rows = found.join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 100
