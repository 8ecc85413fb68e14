"""The registered queries of this subpackage and their DuckDB equivalents.

Each query applies its operator, with production parameters, to the whole of
its table and derives the digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import (
    bpe_documents,
    decontamination,
    embedding_dedup,
    importance,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    sql,
    suffix_dedup,
    token_files,
    toxicity,
    url_filters,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public vocabulary of the tokenizer queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences",
        F.size("offending").alias("n_offending"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages)
    keys = pages.select(warc.page_key(F.col("page_id"), F.col("url")).alias("key"))
    return warc.look_up(archive, keys).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.filter_urls(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def url_mirror_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redirect equivalence at work: pages of example.com and example.net redirect to the same page of example.org."""
    pages = _table(spark, sf_dir, "pages")
    redirects = pages.select(F.col("url").alias("from_url"), F.regexp_replace("url", r"example\.(com|net)", "example.org").alias("to_url"))
    return url_filters.filter_urls(pages, redirects=redirects).select("page_id", "component", "rule", "verdict", "basis")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_token_files(_table(spark, sf_dir, "documents"), tokenizer_path()).digest()


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_documents.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.family_trie(_table(spark, sf_dir, "conversations"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
        "op3_warc": op3_warc,
        "op4_url_filters": op4_url_filters,
        "url_mirror_classes": url_mirror_classes,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_token_files": op6_token_files,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_bpe": op9_bpe,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_decontamination": op13_decontamination,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_jaccard_join": sql.NGRAM_JOIN,
        "op3_warc": sql.WARC,
        "op4_url_filters": sql.URL_FILTERS,
        "url_mirror_classes": sql.URL_MIRRORS,
        "op8_quality_rules": sql.QUALITY,
        "op11_importance_resampling": sql.RESAMPLING,
        "op12_conversation_trie": sql.TRIE,
        "op13_decontamination": sql.DECONTAMINATION,
    }
