"""From documents to packed sequences: the stages of a training-data pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm import bpe, langid, linededup, ordermin, packing, pii
from acreage.llm.queries import vocabulary_path
from acreage.session import fresh_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no text, or none with a letter. What stays and had no
    ``lang`` has the predicted one. Learns from all documents that have a language."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text")
    found = langid.predict(rows, langid.train(docs), ("row",), with_text=True).where(F.col("lang_pred") != langid.UNKNOWN)
    kept = {c: F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns}
    return found.select(*(kept | {"lang": F.coalesce("row.lang", "lang_pred").alias("lang")}).values())


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least ten documents share go; the documents stay."""
    return linededup.drop_common_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return ordermin.keep_one(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; the documents stay."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens, closed by id 0, in sequences of at most 2048."""
    return packing.pack(packing.pieces(bpe.encode(docs, vocabulary_path())))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("PII", mask_pii),
    ("packing", pack),
]

# No stage but two can be put in SQL; the tests hold run() against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
