"""Corpus pipeline: five stages of the text operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; the last returns doc_id, lang, source, n_tokens,
ids_sha256 and decoded_sha256. Decisions take effect: rejected documents and copies go, benchmark spans are cut out of
the texts (n_chars follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reciprospark.llm import bpe, decontaminate, outliers, rules, simhash
from reciprospark.llm.common import bounded_batches, discard, stored, stored_so_far, sweep, table

WIDTH, SIMILARITY = 5, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return outliers.filtered(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return rules.filtered(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of at least SIMILARITY go, by the Jaccard similarity of shingles of WIDTH words."""
    bounded_batches(spark)
    return simhash.deduplicated(docs, WIDTH, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that was nothing else goes."""
    bounded_batches(spark)
    out = decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.where(F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return bpe.digests(docs.select("doc_id", "lang", "source", "text")).drop("text")


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage has stored meanwhile, and the stage's input, go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        since = stored_so_far()
        after = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        sweep(spark, since, after)
        discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
