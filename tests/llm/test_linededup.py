from collections import Counter

from acreage.llm import linededup

BLANK = " \t\n\x0b\x0c\r"


def brute(texts, least, chars=1):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for lines in split for k in {key(x) for x in lines})
    gone = {k for k, n in seen.items() if n >= least and len(k) >= chars}
    return [([x for x in lines if key(x) not in gone], len(lines)) for lines in split]


def check(docs, texts, least=3, chars=1):
    got = {r.doc_id: r for r in linededup.drop_common_lines(docs, least, chars).collect()}
    assert len(got) == len(texts)
    for i, (kept, lines) in enumerate(brute(texts, least, chars)):
        assert ((got[i].text or ""), got[i].n_lines, got[i].n_dropped) == ("\n".join(kept), lines, lines - len(kept))


def test_against_plain_python(make_docs):
    texts = [
        "Shared line\nown 1", " shared LINE \t\nown 2\n", "\nshared line\r\n\n", None, "", "own 1", "ÉTÉ\nété", "x \nx",
        "a\n" * 50, "a", "A", "shared line\nshared line", "ÉTÉ", "ÉTÉ", "x ",
    ]
    check(make_docs(texts), texts)
    check(make_docs(texts), texts, chars=2)
    assert linededup.drop_common_lines(make_docs([None])).collect()[0].text is None


def test_many_lines_repeated_rows_and_none(make_docs):
    long = "\n".join(f"line {i % 700}" for i in range(5000))
    texts = [long, long, long, "line 3\nelse"]
    check(make_docs(texts), texts)
    same = make_docs([(1, "copy"), (1, "copy"), (1, "copy")])
    assert [r.text for r in linededup.drop_common_lines(same, 3).collect()] == ["", "", ""]
    assert linededup.drop_common_lines(make_docs([])).count() == 0


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6, 7)], "doc_id long, text string, gone long, h1 long, id long")
    row = linededup.drop_common_lines(docs).collect()[0]
    assert (row.gone, row.h1, row.id, row.n_lines) == (5, 6, 7, 1)
