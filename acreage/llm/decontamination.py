"""Benchmark decontamination by a broadcast hash set of n-grams, in DataFrame functions alone.

The test items' windows of words are hashed into a set that every task gets. A document's windows
are hashed where the document is read and looked up in the set; a hit is verified by the SHA-256
of the window's words before it counts. What leaves the scan is the places of verified windows,
so the shuffle grows with contamination and not with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.sources.writers import stored

# Upper and lower case of the letters whose case does not matter.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What is no part of a word, in lower-cased text and in a text as it stands.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_AS_IS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
# Words of a window; a shorter item is one window by itself.
WINDOW = 10
# Windows of the set that is broadcast at a time: a hash, a digest and a number each, whatever the
# length of their words, so about 64 MB. More windows are more passes over the documents.
SET_ROWS = 500_000


def words(text: Column) -> Column:
    """The words of a text, its ASCII letters in lower case; none for NULL."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, -1)
    # Only the first and the last part can be empty.
    return F.filter(parts, lambda w: w != "")


def text_id(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")]


def with_word_hashes(df: DataFrame, longest: int) -> DataFrame:
    """Adds ``h1``, ``h2``, ``h4``, …: for each word the hash of the stretch of so many words that
    begins there, each made from two of half the length. What would reach beyond the end says nothing.

    Stretches are read by index, not cut out: cutting copies the whole array for each of them.
    """
    df = df.withColumn("h1", F.transform("ws", lambda w: F.xxhash64(w)))
    half = 1
    while 2 * half <= longest:
        df = df.withColumn(f"h{2 * half}", _joined(half, [(half, half)]))
        half *= 2
    return df


def _joined(length: int, rest: list[tuple[int, int]]) -> Column:
    """The hash of each stretch of ``length`` words with others of (length, distance) after it."""
    return F.transform(f"h{length}", lambda h, i: F.xxhash64(h, *[F.get(f"h{n}", i + at) for n, at in rest]))


def window_hashes(size: int) -> Column:
    """The hash of each window of ``size`` words, one per start, from those of shorter stretches."""
    stretch = 1 << (size.bit_length() - 1)
    rest, at = [], stretch
    for bit in range(size.bit_length() - 2, -1, -1):
        if size >> bit & 1:
            rest.append((1 << bit, at))
            at += 1 << bit
    each = _joined(stretch, rest) if rest else F.col(f"h{stretch}")
    return F.slice(each, 1, F.greatest(F.lit(0), F.size("ws") - size + 1))


def digest(ws: Column, start: Column, size: Column | int) -> Column:
    """What verifies a window: words hold no blank, so nothing else has the same joined text."""
    return F.unhex(F.sha2(F.array_join(F.slice(ws, start, size), " ").cast("binary"), 256))


def item_windows(items: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item``, ``size``, ``h`` and ``digest`` of each distinct window of each item. An item of
    fewer than ``window`` words is one window; one without words has none."""
    ws = items.select(F.col(f"`{item}`").alias("item"), words(F.col(f"`{text}`")).alias("ws"))
    hashed = with_word_hashes(ws.where(F.size("ws") > 0), window)
    of_size = window_hashes(window)
    for size in range(1, window):
        of_size = F.when(F.size("ws") == size, window_hashes(size)).otherwise(of_size)
    size = F.least(F.lit(window), F.size("ws")).alias("size")
    each = hashed.select("item", "ws", size, F.posexplode(of_size).alias("at", "h"))
    return each.select("item", "size", "h", digest(F.col("ws"), F.col("at") + 1, F.col("size")).alias("digest")).distinct()


def hits(docs: DataFrame, grams: DataFrame, text: str = "text", set_rows: int = SET_ROWS) -> DataFrame:
    """``t1``, ``t2`` and ``n_words`` of every text with NULL in the other columns, and a row for
    each verified window of a text with its ``start`` (a word number from 0), ``size`` and ``gram``.

    ``grams`` holds ``gram``, ``size``, ``h`` and ``digest``, a row per distinct window. A set of
    more than ``set_rows`` is dealt by hash into portions that hold fewer, each counted before it
    is broadcast and taken to all documents in a pass of its own.
    """
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # at most WINDOW numbers
    portions, count = 1, grams.count()
    while portions * set_rows < count or (portions > 1 and _largest(grams, portions) > set_rows):
        portions *= 2
    split = docs.select(*text_id(F.col(f"`{text}`")), words(F.col(f"`{text}`")).alias("ws"))
    hashed = with_word_hashes(split, max(sizes, default=1))
    # A NULL hash at the end stands for the text itself, which so leaves the scan once.
    kinds = [F.struct(F.lit(0).alias("size"), F.array(F.lit(None).cast("long")).alias("h"))]
    kinds += [F.struct(F.lit(n).alias("size"), window_hashes(n).alias("h")) for n in sizes]
    each = hashed.select("t1", "t2", "ws", F.explode(F.array(*kinds)).alias("kind"))
    each = each.select("t1", "t2", "ws", "kind.size", F.posexplode("kind.h").alias("start", "h"))
    found = None
    for portion in range(portions):
        some = grams.where(F.pmod("h", F.lit(portions)) == portion)
        some = some.select("gram", F.col("h").alias("gram_h"), F.col("size").alias("gram_size"), "digest")
        part = each.join(F.broadcast(some), F.col("h") == F.col("gram_h"), "left" if portion == 0 else "inner")
        # Digests have one length. An equality would become a join key and be computed for every window.
        same = F.startswith(digest(F.col("ws"), F.col("start") + 1, F.col("size")), F.col("digest"))
        verified = F.col("gram").isNotNull() & (F.col("size") == F.col("gram_size")) & same
        part = part.where(F.col("h").isNull() | verified).select(
            "t1",
            "t2",
            F.when(F.col("h").isNull(), F.size("ws")).cast("long").alias("n_words"),
            F.when(F.col("h").isNotNull(), F.col("start")).alias("start"),
            F.when(F.col("h").isNotNull(), F.col("size")).alias("size"),
            "gram",
        )
        found = part if found is None else found.unionByName(part)
    return found


def _largest(grams: DataFrame, portions: int) -> int:
    return grams.groupBy(F.pmod("h", F.lit(portions))).count().agg(F.max("count")).first()[0] or 0


def hit_words(spans: Column) -> Column:
    """The numbers of the words in any of the spans of (start, size), sorted."""
    each = F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def find(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", set_rows: int = SET_ROWS
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``spans``, ``n_hit``, ``items`` and ``contaminated``.

    Words are what no other ASCII character than a letter or digit parts, compared without case
    of ASCII letters. A window is ``window`` consecutive words of an item, or all words of a
    shorter one. ``spans`` holds start (a word number from 0) and size of each window that
    occurs, sorted; ``n_hit`` counts the words in any of them, ``items`` lists the items they are
    from, as text and sorted, and a document with any is ``contaminated``.

    NULL and empty texts and items have no words. Items that share an id are one; words that
    occur in an item without an id are hit, and it is not listed. A row is a document, whatever
    its id; columns of the added names are replaced. Empty tables on either side find nothing.

    A text of any length is one row of one task, and copies of it are scanned where they lie and
    merged by their 128-bit hash; texts themselves are not moved.
    """
    windows = stored(item_windows(items, window, item, text).select(F.col("item").cast("string"), "size", "h", "digest"))
    grams = windows.select("size", "h", "digest").distinct().withColumn("gram", F.monotonically_increasing_id())
    grams = stored(grams)
    named = windows.join(grams, ["size", "h", "digest"]).select("gram", "item").where(F.col("item").isNotNull())
    named = stored(named.distinct())
    # One row per text and window: how often and by how many copies it was met is settled before the shuffle.
    by_gram = stored(hits(docs, grams, text, set_rows).groupBy("t1", "t2", "gram").agg(
        F.max("n_words").alias("n_words"), F.collect_set(F.when(F.col("gram").isNotNull(), F.struct("start", "size"))).alias("spans")
    ))
    of_text = by_gram.groupBy("t1", "t2").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")
    )
    met = by_gram.where(F.col("gram").isNotNull()).select("t1", "t2", "gram")
    listed = met.join(named, "gram").groupBy("t1", "t2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    of_text = stored(of_text.join(listed, ["t1", "t2"], "left"))
    added = ("n_words", "spans", "n_hit", "items", "contaminated")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *text_id(F.col(f"`{text}`")))
    return rows.join(of_text, ["t1", "t2"]).select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        "n_words",
        "spans",
        F.size(hit_words(F.col("spans"))).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, remove: str = "spans", window: int = WINDOW, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """The documents without what occurs in the items: their hit words (``remove="spans"``), or
    the documents that have any (``remove="documents"``).

    A hit word goes with what parts it from the word before; the rest of a text stays as it is.
    Columns are those of ``docs``. What ``find`` says of NULL, empty and repeated rows holds.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove!r}")
    names = docs.columns
    found = find(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col(f"`{text}`").alias("text")), items, window, "text", item)
    if remove == "documents":
        return found.where(~F.col("contaminated")).select(*[F.col(f"doc.`{c}`").alias(c) for c in names])
    shorter = F.when(F.col("contaminated"), without(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return found.select(*[(shorter if c == text else F.col(f"doc.`{c}`")).alias(c) for c in names])


def without(text: Column, spans: Column) -> Column:
    """The text without the words in spans of (start, size)."""
    pieces = F.regexp_extract_all(text, F.lit(f"[{BETWEEN_AS_IS}]*[^{BETWEEN_AS_IS}]+"), F.lit(0))
    tail = F.regexp_extract(text, f"[{BETWEEN_AS_IS}]*\\z", 0)
    # A digit for each word up to the last hit one. What a function of an element names is computed
    # for every element, so arrays meet side by side and are not looked up.
    hit = hit_words(spans)
    gap = lambda n, before: F.when(n.isNull(), F.lit("")).otherwise(F.concat(F.repeat(F.lit("0"), n - before - 1), F.lit("1")))
    gone = F.split(F.array_join(F.zip_with(hit, F.concat(F.array(F.lit(-1)), hit), gap), ""), "")
    kept = F.zip_with(pieces, gone, lambda piece, g: F.when(g == "1", F.lit("")).otherwise(piece))
    return F.concat(F.array_join(kept, ""), tail)
