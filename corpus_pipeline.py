"""Training-data pipeline: quality, language, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and returns the rows for the next one;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.llm import jaccard_join, langid, packing, pu_quality
from tiersmith.llm.common import json_bytes, small_batches, table
from tiersmith.llm.registry import tokenizer_path
from tiersmith.session import fresh_path

# Share of a text's words that must be in its language; mixed texts pass, texts without letters don't.
MIN_LANGUAGE_SCORE = 0.4
# Standard deviations that a text's n-grams may be less usual than those of the learned languages:
# held-out documents of the given tables reach -7.2, sentences in other languages start at -9.4.
MIN_FAMILIAR = -8.0


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier takes for good ones."""
    model = pu_quality.fit_pu(docs, table(spark, sf_dir, "labels"))
    return docs.where(pu_quality.score_column(model) >= pu_quality.KEEP_SCORE)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are mostly in a known language, and look like it."""
    found = langid.language_column(langid.fit_crf(docs, familiar=True), familiar=True)
    return (docs.withColumn("_language", found).where((F.col("_language.score") >= MIN_LANGUAGE_SCORE) & (F.col("_language.familiar") >= MIN_FAMILIAR))
            .drop("_language"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their place in the packed sequences."""
    pieces = packing.token_pieces(docs.select("doc_id", "text"), ["doc_id"], json_bytes(tokenizer_path("byte_bpe_50k.json")))
    return packing.pack(pieces)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared
    folder and read again, so a lost executor costs at most a stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with small_batches(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# The classifiers are trained, the packing is a search: no SQL expresses them.
ORACLE_SQL = None
