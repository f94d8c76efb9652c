"""Dropping lines that many documents share, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.sources.writers import stored

# Upper and lower case of the letters whose case a key ignores.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What is stripped at both ends of a line.
BLANK = " \t\n\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    """The key of each line of a text: stripped, its ASCII letters in lower case."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.transform(lines, lambda line: F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER))


def hashed(key: Column) -> Column:
    """128 bits that stand for a key: two hashes with different seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """``h1``, ``h2``: hashes of keys of at least ``min_chars`` found in at least ``min_docs`` rows.

    A row is a document. Its distinct keys are taken inside the row, and counts are added up
    before the shuffle, so a line that is in every document is one row per task.
    """
    keys = F.filter(F.array_distinct(line_keys(F.col(text))), lambda k: F.length(k) >= min_chars)
    return (
        docs.select(F.explode(F.transform(keys, hashed)).alias("h"))
        .groupBy("h.h1", "h.h2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2")
    )


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """The rows with ``text`` rid of the lines that many documents share, and ``n_lines`` and
    ``n_dropped`` in addition.

    A text is split at line feeds; NULL and empty texts are one empty line, which stays, and a
    NULL text stays NULL. Lines are compared by a 128-bit hash of their key. A row is a document:
    a row that occurs ten times is ten documents. Other columns stay as they are; columns that are
    called ``n_lines`` or ``n_dropped`` are replaced. An empty table gives no rows.

    Texts are not shuffled by line. Hashes of lines meet the common ones, where adaptive
    execution may split a line that fills much of the input, and what is to go comes back as
    one short row per text, keyed by the text's own 128-bit hash.
    """
    common = stored(common_lines(docs, min_docs, min_chars, text))
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = (
        docs.select(hashed(whole).alias("id"), F.transform(line_keys(F.col(text)), hashed).alias("keys"))
        .select("id", F.posexplode("keys").alias("at", "key"))
        .select("id", "at", "key.h1", "key.h2")
    )
    # Copies of a text lose the same lines: a position is kept once per task before it is sent.
    gone = (
        lines.join(common, ["h1", "h2"], "left_semi")
        .groupBy("id")
        .agg(F.array_sort(F.collect_set("at")).alias("at"))
        .select("id.*", F.size("at").alias("n"), _flags(F.col("at")).alias("gone"))
    )
    gone = stored(gone)
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"), hashed(whole).alias("id"))
    rows = rows.select("row", "id.*").join(gone, ["h1", "h2"], "left")
    lines_of = F.split(F.coalesce(F.col(f"row.`{text}`"), F.lit("")), "\n", -1)
    kept = F.filter(lines_of, lambda line, at: ~F.coalesce(F.get(F.col("gone"), at), F.lit(False)))
    shorter = F.when(F.col("n").isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join(kept, "\n"))
    return rows.select(
        *[(shorter if c == text else F.col(f"row.`{c}`")).alias(c) for c in kept_columns],
        F.size(lines_of).cast("long").alias("n_lines"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_dropped"),
    )


def _flags(at: Column) -> Column:
    """Sorted positions as an array that is true there, up to the last: a look-up takes one step
    however many lines a text has."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(at, i - 1))
    runs = F.transform(at, lambda p, i: F.concat(F.repeat(F.lit("0"), p - before(i) - 1), F.lit("1")))
    return F.transform(F.split(F.array_join(runs, ""), ""), lambda c: c == "1")
