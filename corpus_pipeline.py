"""A corpus pipeline of five stages over the documents table.

quality rules, toxicity, n-gram Jaccard join, suffix-array dedup, best-fit
packing.  Each stage works on all rows that its predecessor kept, written as
Parquet in between; all but the last return the columns of documents.  Rows
without id, and rows that repeat an id, are documents like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import ngram_join, packing, quality, suffix_dedup, toxicity
from cairn.llm.rows import ROW, with_row_numbers
from cairn.llm.scratch import Scratch

#: A document is toxic from this score on.
TOXIC = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.quality_filter(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC`` under a model of the given labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels), TOXIC)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of similar ones."""
    rows = with_row_numbers(docs, Scratch(spark, "classes"))
    classes = ngram_join.similarity_classes(rows, id_col=ROW)
    dropped = classes.where("component_id <> doc_id").select(F.col("doc_id").alias(ROW))
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier in the corpus; n_chars follows the text."""
    rows = with_row_numbers(docs, Scratch(spark, "passages"))
    cut = suffix_dedup.cut_passages(rows, suffix_dedup.repeated_passages(rows, id_col=ROW), id_col=ROW)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in bins of bounded length."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", passage_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL expresses neither the model of the second stage nor the order-dependent fourth and fifth.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return kept
        docs = scratch.cut(kept, name)
    return docs
