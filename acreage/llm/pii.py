"""Personal data in texts: patterns propose spans, checks confirm them, nearby words decide doubtful ones.

All of it is column expressions. The patterns are written so that a search takes time in
proportion to the text: repeats that could be tried again from each of their own characters are
possessive and start only where such a run starts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points before a match in which a context word counts.
CONTEXT_WINDOW = 48
# A span whose score reaches this is reported.
ACCEPTED = 0.5
# Matches of one text whose places are added up in one go; more are taken in stretches of it.
STRETCH = 512


@dataclass(frozen=True)
class Kind:
    """A pattern, the check of a match, and what the match is worth without and with context."""

    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float = 1.0
    context: str = ""
    bonus: float = 0.0
    #: A text without this has no match.
    needs: str = ""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a number of a few digits, as text, passes the Luhn check."""
    figures = F.reverse(F.split(number, ""))

    def worth(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(figures, worth), F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an international account number leaves 1 by the mod-97 check."""
    plain = F.replace(account, F.lit(" "))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(letter >= 10, (rest * 100 + letter) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def is_card(match: Column) -> Column:
    number = digits(match)
    size = F.length(number)
    return F.when((size >= 12) & (size <= 19), luhn(number)).otherwise(F.lit(False))


def is_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) < 3) | ((F.length(value) == 3) & (value <= "255"))

    return F.forall(F.split(match, "\\."), small)


def is_phone(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


def is_ssn(match: Column) -> Column:
    area = F.substring(match, 1, 3)
    return (
        ~area.isin("000", "666") & (area < "900") & (F.substring(match, 5, 2) != "00") & (F.substring(match, 8, 4) != "0000")
    )


def always(match: Column) -> Column:
    return F.lit(True)


# The kinds every text is searched for, in the order in which they are listed. A search that
# failed from a run's first character fails from its others too, unless an earlier match took
# the characters before: then it goes on from that match's end (\G).
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", always, needs="@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", is_ip, needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", is_card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", is_phone, needs="+"),
)
# Kinds that a checksum or nearby words have to confirm.
DOUBTFUL = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        mod97,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", is_ssn, 0.3,
        r"(?i)\b(?:ssn|social security|tax id)\b", 0.4, needs="-",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9.-])(?<!\+[0-9]{1,3}[ .-]?)(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        always, 0.2, r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp)\b", 0.4,
    ),
)
KINDS = (*BASE, *DOUBTFUL)


def running(sizes: Column, joined: Callable[[Column, Column], Column] = lambda a, x: a + x) -> Column:
    """For each size the sum of those up to it, itself included; or what else ``joined`` makes of
    them, beginning with 0."""

    def summed(part: Column, start: Column) -> Column:
        first = F.struct(start.alias("sum"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            part,
            first,
            lambda a, x: let(
                joined(a["sum"], x), lambda s: F.struct(s.alias("sum"), F.concat(a["out"], F.array(s)).alias("out"))
            ),
        )["out"]

    def stretches(sizes: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(sizes), F.lit(STRETCH))
        parts = F.transform(firsts, lambda at: F.slice(sizes, at, F.lit(STRETCH)))

        def ends(parts: Column) -> Column:
            totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), joined))
            return let(
                summed(totals, F.lit(0)),
                lambda sums: F.flatten(
                    F.transform(
                        parts, lambda p, i: summed(p, F.when(i == 0, F.lit(0)).otherwise(F.get(sums, i - 1)))
                    )
                ),
            )

        return let(parts, ends)

    return F.when(F.size(sizes) <= STRETCH, summed(sizes, F.lit(0))).otherwise(stretches(sizes))


def candidates(text: Column, kind: Kind) -> Column:
    """``gaps``, the texts between matches, and ``matches``, an array of (match, score).

    The score is 0 for a match that fails its check: it is not tried again from a later place.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    parts = F.struct(F.split(text, kind.pattern, -1).alias("gaps"), found.alias("found"))

    def scored(p: Column) -> Column:
        def score(match: Column, gap: Column) -> Column:
            worth = F.lit(kind.score)
            if kind.context:
                near = F.rlike(F.substr(gap, F.greatest(F.length(gap) - CONTEXT_WINDOW + 1, F.lit(1))), F.lit(kind.context))
                worth = worth + F.when(near, F.lit(kind.bonus)).otherwise(F.lit(0.0))
            return F.struct(match.alias("match"), F.when(kind.check(match), worth).otherwise(F.lit(0.0)).alias("score"))

        # As many gaps as matches: the last gap follows the last match.
        before = F.slice(p["gaps"], F.lit(1), F.size(p["found"]))
        return F.struct(p["gaps"].alias("gaps"), F.zip_with(p["found"], before, score).alias("matches"))

    return let(parts, scored)


SPANS = "array<struct<start:int,order:int,end:int,kind:string,score:double>>"


def kind_spans(text: Column, order: int, kind: Kind) -> Column:
    """The confirmed spans of a kind, in code points, the end exclusive."""

    def placed(c: Column) -> Column:
        before = F.slice(c["gaps"], F.lit(1), F.size(c["matches"]))
        sizes = F.zip_with(before, c["matches"], lambda g, m: F.length(g) + F.length(m["match"]))
        spans = F.zip_with(
            running(sizes),
            c["matches"],
            lambda end, m: F.struct(
                (end - F.length(m["match"])).alias("start"),
                F.lit(order).alias("order"),
                end.alias("end"),
                F.lit(kind.name).alias("kind"),
                m["score"].alias("score"),
            ),
        )
        return F.filter(spans, lambda s: s["score"] >= ACCEPTED)

    none = F.array().cast(SPANS)
    there = F.rlike(text, F.lit(kind.pattern))
    if kind.needs:
        there = F.contains(text, F.lit(kind.needs)) & there
    return F.when(there, let(candidates(text, kind), placed)).otherwise(none)


def all_spans(text: Column, kinds: tuple[Kind, ...]) -> Column:
    return F.array_sort(F.concat(*[kind_spans(text, i, k).cast(SPANS) for i, k in enumerate(kinds)]))


def find(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The rows with ``pii`` in addition: confirmed spans by start and then kind, each with its score.

    Spans of one kind are leftmost and do not overlap; spans of different kinds may. NULL and
    empty texts have none. A column that is called ``pii`` is replaced; others do not matter.
    Nothing is shuffled.
    """
    return docs.withColumn("pii", all_spans(F.coalesce(F.col(text), F.lit("")), kinds))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def merged(spans: Column) -> Column:
    """Sorted spans with those that overlap made one ``start``, ``end`` and ``kind``: that of the
    longest, or the first listed of several."""

    def cut(ends: Column) -> Column:
        firsts = F.filter(
            F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.get(ends, i - 1))
        )

        def one(firsts: Column) -> Column:
            def stretch(first: Column, k: Column) -> Column:
                after = F.coalesce(F.get(firsts, k + 1), F.size(spans))
                worth = F.transform(
                    F.slice(spans, first + 1, after - first),
                    lambda s: F.struct((s["end"] - s["start"]).alias("size"), (-s["order"]).alias("order"), s["kind"].alias("kind")),
                )
                return F.struct(
                    F.get(spans, first)["start"].alias("start"),
                    F.get(ends, after - 1).alias("end"),
                    F.array_max(worth)["kind"].alias("kind"),
                )

            return F.transform(firsts, stretch)

        return let(firsts, one)

    return let(running(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x)), cut)


def covered(text: Column, cuts: Column) -> Column:
    """The text with each of the sorted, separate ``cuts`` replaced by its kind.

    Places are counted from the start of a stretch of cuts, not from that of the text.
    """

    def part(at: Column) -> Column:
        begin = F.coalesce(F.get(cuts, at - 2)["end"], F.lit(0))

        def written(c: Column) -> Column:
            def piece(x: Column, i: Column) -> Column:
                before = F.when(i == 0, begin).otherwise(F.get(c["cuts"], i - 1)["end"])
                gap = F.substr(c["text"], before - begin + 1, x["start"] - before)
                return F.concat(gap, F.lit("<"), F.upper(x["kind"]), F.lit(">"))

            return F.array_join(F.transform(c["cuts"], piece), "")

        some = F.slice(cuts, at, F.lit(STRETCH))
        end = F.element_at(some, -1)["end"]
        return let(F.struct(some.alias("cuts"), F.substr(text, begin + 1, end - begin).alias("text")), written)

    firsts = F.sequence(F.lit(1), F.size(cuts), F.lit(STRETCH))
    rest = F.substr(text, F.element_at(cuts, -1)["end"] + 1)
    return F.concat(F.array_join(F.transform(firsts, part), ""), rest)


def mask(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The rows with each confirmed span of ``text`` replaced by its kind in angle brackets.

    The spans are those ``find`` gives for the whole text; of overlapping ones everything goes.
    What only shows once its surroundings are replaced is masked afterwards, kind by kind. Texts
    without spans, NULL ones too, stay as they are.
    """

    def masked(text: Column, kind: Kind) -> Column:
        def joined(c: Column) -> Column:
            covers = F.transform(
                c["matches"], lambda m: F.when(m["score"] >= ACCEPTED, F.lit(f"<{kind.name.upper()}>")).otherwise(m["match"])
            )
            pairs = F.zip_with(c["gaps"], covers, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
            return F.array_join(pairs, "")

        there = F.rlike(text, F.lit(kind.pattern))
        if kind.needs:
            there = F.contains(text, F.lit(kind.needs)) & there
        return F.when(there, let(candidates(text, kind), joined)).otherwise(text)

    # Steps in columns of their own: one expression of all would be nested too deep to resolve.
    name = "_" * (1 + max(map(len, docs.columns)))
    spans, cuts = F.col(name), F.col(f"{name}cuts")
    rows = docs.withColumn(name, all_spans(F.coalesce(F.col(text), F.lit("")), kinds))
    rows = rows.withColumn(f"{name}cuts", F.when(F.size(spans) > 0, merged(spans)))
    rows = rows.withColumn(text, F.when(cuts.isNull(), F.col(text)).otherwise(covered(F.col(text), cuts)))
    new = reduce(lambda text, kind: let(text, lambda t: masked(t, kind)), kinds, F.col(text))
    return rows.withColumn(text, F.when(cuts.isNull(), F.col(text)).otherwise(new)).drop(name, f"{name}cuts")
