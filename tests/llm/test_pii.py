import random
import re

from acreage.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    worth = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(w - 9 if w > 9 else w for w in worth) % 10 == 0


def fine(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if fine(kind, m.group())
    ]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


def spans(docs, **more):
    rows = pii.find(docs, **more).select("doc_id", pii.listed(pii.F.col("pii")).alias("spans")).collect()
    return {r.doc_id: [s for s in r.spans.split(",") if s] for r in rows}


def test_base_spans_are_those_of_plain_python(make_docs):
    rnd = random.Random(2)
    parts = ["a@b.c", "a@b", "@", ".", "1.2.3.4", "256.1.1.1", "0001.2.3.255", "4111111111111111", "4111 1111-1111 1111", "+", "+49 (30) 123-4567",
             "12", " ", "-", "é", "🙂", "\n", "x_y%+z@q-r.co.uk", "1.2.3.4.5.6.7.8", "_", "+1.2.3.4.5.6.7.8.9", "x"]
    texts = [None, ""] + ["".join(rnd.choice(parts) for _ in range(rnd.choice([2, 8, 40]))) for _ in range(400)]
    got = spans(make_docs(texts), kinds=pii.BASE)
    assert {i: brute(t) for i, t in enumerate(texts)} == got


def test_very_long_runs_do_not_break_the_search(make_docs):
    texts = ["9" * 60_000, "a" * 60_000 + "@b.c", "1 " * 30_000, "+1" + "(" * 50_000, "1.2.3.4 " * 1500, "9." * 30_000]
    got = spans(make_docs(texts), kinds=pii.BASE)
    assert {i: brute(t) for i, t in enumerate(texts)} == got


def test_checksums_and_context_decide(make_docs):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE89 3704 0044 0532 0130 01.", "GB82WEST12345698765432 is one",
        "ssn 123-45-6789", "code 123-45-6789", "ssn 000-45-6789", "call (407) 555-7710 now", "lot (407) 555-7710 now",
    ]
    got = spans(make_docs(texts), kinds=pii.DOUBTFUL)
    kinds = [[s.split(":")[0] for s in got[i]] for i in range(len(texts))]
    assert kinds == [["iban"], [], ["iban"], ["ssn"], [], [], ["local_phone"], []]


def test_base_spans_stay_beside_others(make_docs):
    text = "phone +1 (407) 555-7710, mail a@b.cd"
    assert set(brute(text)) <= set(spans(make_docs([text]))[0])


def test_masking_leaves_no_span_and_no_other_change(make_docs, spark):
    texts = ["x a@b.cd y 1.2.3.4 z 4111111111111111 +1 (407) 555-7710.", "nothing 12 here", None, ""]
    got = {r.doc_id: r.text for r in pii.mask(make_docs(texts)).collect()}
    assert got == {0: "x <EMAIL> y <IP> z <CARD> <PHONE>.", 1: "nothing 12 here", 2: None, 3: ""}
    clash = spark.createDataFrame([(1, "a@b.cd", 3)], "doc_id long, text string, pii long")
    assert pii.mask(clash).collect()[0].pii == 3
    assert pii.find(make_docs([])).count() == 0


def covered(text, found):
    """The text with all of the spans replaced, overlapping ones by the kind of the longest."""
    out, at, stretches = "", 0, []
    for start, _, end, kind in sorted(found):
        if stretches and start < stretches[-1][1]:
            last = stretches[-1]
            stretches[-1] = (last[0], max(last[1], end), [*last[2], (start - end, pii.KINDS.index(by_name[kind]), kind)])
        else:
            stretches.append((start, end, [(start - end, pii.KINDS.index(by_name[kind]), kind)]))
    for start, end, kinds in stretches:
        out, at = out + text[at:start] + f"<{min(kinds)[2].upper()}>", end
    return out + text[at:]


by_name = {k.name: k for k in pii.KINDS}


def test_nothing_of_overlapping_spans_is_left(make_docs):
    rnd = random.Random(5)
    parts = ["+33.1.42.68.53.00", "1.2.3.4", ".5", "+49 ", "+", "4111111111111111", "4111 1111-1111 1111", "a@", "b.c", "é", " ", "x"]
    texts = ["call +33.1.42.68.53.00", "🙂 +33.1.42.68.53.00, a@1.2.3.4", "1.2.3.4-4111111111111111"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.choice([2, 5, 9]))) for _ in range(300)]
    texts.append("é +33.1.42.68.53.00 z\n" * 1300)
    found = spans(make_docs(texts))
    got = {r.doc_id: r.text for r in pii.mask(make_docs(texts)).collect()}
    assert got[0] == "call <PHONE>" and got[1] == "🙂 <PHONE>, <EMAIL>" and got[2] == "<IP>-<CARD>"
    assert got[len(texts) - 1] == "é <PHONE> z\n" * 1300
    want, overlapping = {}, 0
    for i, text in enumerate(texts):
        own = sorted((int(a), 0, int(b), k) for k, a, b in (s.split(":") for s in found[i]))
        overlapping += any(a[2] > b[0] for a, b in zip(own, own[1:]))
        want[i] = covered(text, own)
    # What shows only afterwards is masked too.
    more, left = spans(make_docs(list(want.items()))), spans(make_docs(list(got.items())), kinds=pii.BASE)
    assert {i: t for i, t in got.items() if not more[i]} == {i: t for i, t in want.items() if not more[i]}
    assert not any(left.values()) and sum(map(bool, more.values())) < 100
    assert overlapping > 20


def test_many_matches_are_placed_in_stretches(make_docs):
    text = "a@b.cd\n" * 1300
    assert spans(make_docs([text]), kinds=pii.BASE)[0] == brute(text)


def test_no_python_in_the_plan(make_docs):
    plan = pii.mask(pii.find(make_docs(["a"])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
