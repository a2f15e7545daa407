"""Registered queries of the operators, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.llm import bpe, decontaminate, jaccard_join, kd_shards, langid, lexical, license_scan, merkle, norm_topk, packing, pu_quality, quality_rules, url_filter
from tiersmith.llm.common import held_out, json_bytes, table
from tiersmith.llm.oracle import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dimensions that equal texts share: their rows are near each other in the tree.
    placed = kd_shards.kd_shards(table(spark, sf_dir, "documents"), ["doc_id"], shards=8, dims=["n_chars", "lang"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.exact_topk(table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_texts(docs, json_bytes(tokenizer_path("word_bpe_49k.json"))).select("doc_id", "bpe.*")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, ["doc_id"], json_bytes(tokenizer_path("byte_bpe_50k.json")))
    return packing.pack(pieces).withColumn("piece", F.col("piece").cast("int"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_crf(docs)
    return (docs.select("doc_id", held_out().alias("held_out"), langid.language_column(model).alias("_l"))
            .select("doc_id", "held_out", "_l.lang_pred", "_l.score"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pu_quality.fit_pu(docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", held_out().alias("held_out"), pu_quality.score_column(model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= pu_quality.KEEP_SCORE, 1).otherwise(0)))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    found = merkle.manifest(table(spark, sf_dir, "documents"), replaced={"text": lowered}, where=merkle.tampered())
    text = {c: F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")}
    return found.select("doc_id", text["leaf"], text["subroot"], text["root"], F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"),
                        text["folded_root"], (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_kd_tree_sharding, op2_license_scan, op3_exact_topk, op4_bpe, op5_best_fit_packing, op6_quality_rules,
    op7_url_filter, op8_language_id, op9_quality_classifier, op10_ngram_jaccard_join,
    op11_benchmark_decontamination, op12_merkle_manifest, op13_ranked_search)}
