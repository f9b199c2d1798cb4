"""Registered queries of the operators: thin digests of their results on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracover.llm import alignment, conversations, line_dedup, lm, minhash, mixing, packing, pii, quality, substrings, topk, urls, warc

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file on this machine; executors need it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = line_dedup.drop_frequent_lines(docs, min_docs=10, min_key_chars=1)
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed",
    )


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, width=3, percent=85)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.repeated_spans(docs, length=50).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.lm_scores(docs, order=3).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


#: (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    responses = warc.responses_of(pages)
    records = warc.derive(responses, "id", "record_id", "uri", "date", "http", "payload")
    return records.select(
        F.col("id").alias("page_id"), *[n for n, _ in warc._FIELDS if n != "record"], F.sha2("record", 256).alias("record_sha256")
    )


@query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair_conversations(rows, seeded=True)


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


@query
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.personal_data(docs).drop("key")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
