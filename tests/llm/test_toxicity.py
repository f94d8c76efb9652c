import math
import random
import zlib

import numpy as np
import pytest

from acreage.llm import toxicity as tox


def test_features_are_those_of_the_definition():
    text = "You, TRASH you  é1"
    words = ["you", "trash", "you", "é1"]
    hashes, of = tox.word_hashes(["", text, "x"])
    assert [h for h, o in zip(hashes.tolist(), of.tolist()) if o == 1] == [zlib.crc32(w.encode()) for w in words]
    numbers = [set(f[w == 1].tolist()) for f, w in tox.features(hashes, of)]
    assert len(numbers) == 1 + len(tox.MIX) and [len(n) for n in numbers] == [3, 3, 2, 1]
    assert all(0 <= n < tox.FEATURES for group in numbers for n in group)


def test_ftrl_is_sparse_and_learns():
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        label = i % 2
        noise = [rnd.randrange(100, 5000) for _ in range(30)]
        rows.append((np.unique(noise + [7] * label), float(label)))
    found = tox.ftrl(rows)
    table = found.dense()
    assert table[7] > 0 and len(found.numbers) < 200
    assert all((table[f].sum() + found.bias > 0) == bool(y) for f, y in rows)


def plain_ftrl(examples):
    """The update rule as it is written down: one coordinate at a time, in dictionaries."""
    z, n, bias = {}, {}, tox.FEATURES

    def weight(i):
        if abs(z.get(i, 0.0)) <= tox.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * tox.L1) / ((tox.BETA + math.sqrt(n[i])) / tox.ALPHA + tox.L2)

    for _ in range(tox.EPOCHS):
        for numbers, label in examples:
            at = [*numbers.tolist(), bias]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in at:
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / tox.ALPHA * w[i]
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_equals_the_rule_step_by_step():
    rnd = random.Random(8)
    rows = []
    for _ in range(300):
        label = float(rnd.random() < 0.3)
        noise = [rnd.randrange(50, 400) for _ in range(rnd.randrange(0, 25))]
        rows.append((np.unique(noise + [rnd.randrange(5) for _ in range(int(label) * 3)]).astype(int), label))
    found, want = tox.ftrl(rows), plain_ftrl(rows)
    assert want.pop(tox.FEATURES, 0.0) == pytest.approx(found.bias, rel=1e-6, abs=1e-9)
    assert found.numbers.tolist() == sorted(want) and len(want) >= 4
    assert found.values.tolist() == pytest.approx([want[i] for i in sorted(want)], rel=1e-4)


def test_scores_in_any_company_and_for_empty_texts():
    weights = tox.Weights(np.array([0]), np.array([0.0], np.float32), -1.0)
    table = np.random.default_rng(0).normal(size=tox.FEATURES).astype(np.float32)
    texts = ["", "a b c d e", "x", "a b c d e a b c d e", "word " * 5000]
    together = tox.scores(texts, table, weights.bias)
    assert np.allclose(together, [tox.scores([t], table, weights.bias)[0] for t in texts])
    assert np.isclose(together[0], 1 / (1 + np.exp(1)))


def test_training_and_scoring_tables(spark, make_docs):
    rnd = random.Random(3)
    noise = lambda: " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(9)) for _ in range(20))
    texts = [noise() + (" awful nonsense" if i % 2 else "") for i in range(300)] + [None, ""]
    docs = make_docs(texts)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)] + [(0, 1, None), (None, 1, 1), (300, 0, 1), (999, 0, 1)], "doc_id long, quality int, toxic int")
    weights = tox.train(docs, labels)
    rows = {r.doc_id: r.score for r in tox.score(docs, weights).collect()}
    assert len(rows) == 302 and all((rows[i] >= 0.5) == bool(i % 2) for i in range(300)) and rows[300] == rows[301]
    assert tox.score(make_docs([]), weights).count() == 0
    nothing = tox.train(docs, labels.limit(0))
    assert all(r.score == 0.5 for r in tox.score(docs, nothing).collect())


def test_held_out_quality(spark):
    from acreage.llm.queries import op2_toxicity

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = op2_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic) > 30
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(rows)
