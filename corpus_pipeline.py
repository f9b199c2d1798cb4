"""Corpus pipeline: documents to packed token sequences in five stages.

Quality rules reject documents and take out boilerplate lines, line dedup drops frequent
lines, near-dedup leaves one document of each group, mixing repeats or leaves out documents
by source, packing cuts and places their tokens. Each stage reads the table its predecessor
wrote, all of it. All but the last return the columns of documents; ``n_chars`` follows the
text where it changes.

Defined results are those of the operators: null and empty texts fail the quality rules,
repeated rows and copies leave one document, ties go to the least id, very long texts pass
whole, extra columns are kept whatever their names, an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracover.llm import line_dedup, minhash, mixing, packing, quality
from terracover.llm.queries import tokenizer
from terracover.sources.staging import stage


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line frequencies of their source leave, without boilerplate lines."""
    return _with_length(quality.clean_good(docs))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    clean = line_dedup.drop_frequent_lines(docs, min_docs=10, min_key_chars=1, with_counts=False)
    return _with_length(clean)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs, width=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("minhash", near_deduplication),
    ("mixing", source_mixing),
    ("packing", best_fit_packing),
]

#: Packing tokenises, near-dedup sketches: SQL cannot express these stages; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
