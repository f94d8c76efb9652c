import re
from collections import Counter

import pytest

from acreage.llm import decontamination as deco

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall((text or "").translate(UP))


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        ws = words(text)
        size = min(window, len(ws))
        for i in range(len(ws) - size + 1 if ws else 0):
            grams.setdefault(tuple(ws[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(ws) - size + 1):
                if (g := tuple(ws[i : i + size])) in grams:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in grams[g] if x is not None}
        out.append((doc, len(ws), len(hit), tuple(sorted(found)), bool(hit)))
    return Counter(out)


PASSAGE = "One two three, four five six seven; eight nine ten eleven twelve"
ITEMS = [
    (1, PASSAGE),
    (10, "ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN and more"),
    (2, "short item"),
    (3, "Élan vital"),
    (3, "x1"),
    (4, None),
    (5, " .,! "),
    (None, "nobody knows"),
    (6, "a a a a a a a a a a"),
]
DOCS = [
    (1, "Before. " + PASSAGE + " after"),
    (1, "Before. " + PASSAGE + " after"),
    (2, "one two three four five six seven eight nine"),
    (3, "It is a SHORT\n\titem, is it? short item"),
    (4, "élan vital"),
    (5, "Élan vital x1"),
    (6, None),
    (7, ""),
    (8, "nobody knows"),
    (9, "a " * 25),
    (None, "no id, short item"),
    (11, "clean text of no interest"),
    (12, ("filler words here " * 9000) + PASSAGE + " short item " * 2000),
]


def frames(spark, docs=DOCS, items=ITEMS):
    d = spark.createDataFrame(
        [(i, t, 1, "g", 2.0, [1]) for i, t in docs], "doc_id long, text string, start int, gram string, h double, spans array<int>"
    )
    return d, spark.createDataFrame([(i, t, 5, "s") for i, t in items], "item_id long, text string, size int, digest string")


def found(df):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in df.collect())


@pytest.mark.parametrize("set_rows", [deco.SET_ROWS, 4])
def test_against_every_window_of_every_item(spark, set_rows):
    """One pass, and portions of a set that is too large to be broadcast at once."""
    docs, items = frames(spark)
    out = deco.find(docs, items, set_rows=set_rows)
    assert out.columns == ["doc_id", "text", "start", "gram", "h", "n_words", "spans", "n_hit", "items", "contaminated"]
    assert found(out) == brute(DOCS, ITEMS)


def test_other_window(spark):
    docs, items = frames(spark)
    assert found(deco.find(docs, items, window=3)) == brute(DOCS, ITEMS, 3)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert deco.find(docs.limit(0), items).count() == 0
    assert found(deco.find(docs, items.limit(0))) == brute(DOCS, [])


def test_spans_or_documents_are_removed(spark):
    docs, items = frames(spark)
    spans = deco.decontaminate(docs, items)
    assert spans.columns == docs.columns
    texts = Counter((r["doc_id"], r["text"]) for r in spans.collect())
    assert texts[1, "Before after"] == 2
    assert texts[3, "It is a, is it"] == 1
    assert texts[6, None] == texts[7, ""] == texts[11, "clean text of no interest"] == 1
    assert texts[2, DOCS[2][1]] == 1
    assert not deco.find(spans, items).where("contaminated").count()
    kept = deco.decontaminate(docs, items, remove="documents")
    clean = {d for d, *_, bad in brute(DOCS, ITEMS) if not bad}
    assert {r["doc_id"] for r in kept.collect()} == clean
    with pytest.raises(ValueError):
        deco.decontaminate(docs, items, remove="all")


def test_the_scan_has_no_python_and_sends_no_texts(spark):
    docs, items = frames(spark)
    plan = deco.find(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
