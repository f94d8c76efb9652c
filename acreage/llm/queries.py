"""The operators of this package over their whole tables, and SQL that checks some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm import bpe, decontamination, hardneg, langid, linededup, ordermin, packing, pii, projections, runs, topk, toxicity, warc
from acreage.llm.common import remainder

TOXICITY_FOLDS, TOXICITY_HELD_OUT = 5, 0
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 4, 2
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and places."""
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    names = [k.name for k in pii.BASE]
    base = F.filter("pii", lambda s: s["order"] < len(names))

    def number(name: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id",
        *[number(n) for n in names],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"),
    )


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every document, learned from labels that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = remainder("doc_id", TOXICITY_FOLDS) == TOXICITY_HELD_OUT
    weights = toxicity.train(docs, labels.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    scored = toxicity.score(rows, weights, ("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query()
def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every document, decode it again, and return digests of both."""
    both = bpe.encode(table(spark, folder, "documents"), vocabulary_path(), decoded=True)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pack every document's tokens, closed by id 0, into sequences of at most 2048."""
    encoded = bpe.encode(table(spark, folder, "documents"), vocabulary_path())
    return packing.pack(packing.pieces(encoded))


OP5_SQL = """
WITH RECURSIVE numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), comparable AS (
  SELECT vec_id, v FROM numbers WHERE vec_id IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM comparable a JOIN comparable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
  SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT b, root FROM reached JOIN links ON vec_id = a
), roots AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN degrees USING (vec_id)
"""


@query(OP5_SQL)
def op5_projection_passes(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors: links, components and what is kept."""
    return projections.near_duplicates(table(spark, folder, "embeddings"))


OP6_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN strlen(payload) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(payload) >= 100 AND page_id <> first THEN first END AS refers_to
FROM payloads JOIN firsts USING (payload)
"""


@query(OP6_SQL)
def op6_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Write every page to web archives, normalise them, and read the records back."""
    return warc.round_trip(table(spark, folder, "pages"))


OP7_SQL = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), exploded AS (
  SELECT r, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM texts
), keyed AS (
  SELECT r, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM exploded
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), marked AS (
  SELECT k.r, k.pos, k.line, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
), joined AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM texts JOIN joined USING (r)
"""


@query(OP7_SQL)
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Drop the lines that at least ten documents share."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = linededup.drop_common_lines(docs)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op8_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near duplicates of every document."""
    classes, _ = ordermin.near_duplicates(table(spark, folder, "documents"))
    return classes.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


@query()
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    held_out = remainder("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT
    trees = langid.train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, trees, ("doc_id", "held_out"))


OP10_SQL = """
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM numbers q JOIN numbers c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""


@query(OP10_SQL)
def op10_pivot_distance_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best partners of every twentieth vector."""
    return topk.search(table(spark, folder, "embeddings"))


OP11_SQL = r"""
WITH doc_texts AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT size FROM grams),
windows AS (
  SELECT r, i, size, array_to_string(ws[i:i + size - 1], ' ') AS gram
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM doc_texts, sizes WHERE len(ws) >= size)
), met AS (
  SELECT DISTINCT r, i, size, item_id FROM windows JOIN grams USING (size, gram)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM met) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_texts LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


@query(OP11_SQL)
def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The words and items of the benchmark that every document holds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where in about a tenth of the texts what follows a certain word
    repeats with a certain period, both drawn from the id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    ws = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    drawn = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    drawn = drawn.withColumn("ws", F.when(F.col("chosen"), ws)).withColumn("n", F.size("ws").cast("long"))
    # Neither words nor places exist where nothing is planted; the conditions keep those from being computed.
    planted = F.col("chosen") & (F.col("n") > 0)
    drawn = drawn.withColumn("a", F.when(planted, F.col("g") % F.col("n")))
    drawn = drawn.withColumn("p", F.when(planted, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    order = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    text = F.array_join(F.transform(order, lambda i: F.get("ws", i.cast("int"))), " ")
    return drawn.select("doc_id", F.when(planted, text).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document, some of which were planted, and digests of what is kept."""
    found = runs.find(with_planted_runs(table(spark, folder, "documents")))
    # The greatest length first, of those the smallest start, then the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n"))
    lines = F.array_join(F.transform("runs", line), "")
    best_length, best_period = best["length"], -best["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["start"]).alias("start"),
        best_length.alias("length"),
        best_period.alias("period"),
        F.floor(best_length * 1000 / best_period).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


OP13_SQL = """
WITH numbers AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM numbers a JOIN numbers b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query(OP13_SQL)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, after some labels were moved."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.select("vec_id", "embedding", moved.alias("label")))
