"""Texts of a million words, and columns that clash, through every operator on texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from terracover.llm import alignment, conversations, line_dedup, lm, minhash, mixing, packing, pii, quality, substrings
from terracover.llm.queries import tokenizer

WORDS = 1_000_000


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(5000)]
    words = [rng.choice(vocabulary) for _ in range(WORDS)]
    long = "\n".join(" ".join(words[i:i + 20]) for i in range(0, WORDS, 20))
    near = "\n".join(" ".join(words[i:i + 20]) for i in range(0, WORDS - 2000, 20))
    return [(1, long), (2, near), (3, "a few words of its own"), (4, "x" * 3_000_000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    extra = "lang string, source string, n_chars bigint, key string, cls string, num string, id string, text_ string, spans string, base string, features string"
    rows = [(i, t, "en", "s", len(t), *["clash"] * 8) for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {extra}").repartition(4).cache()


def test_lines(docs, texts):
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.drop_frequent_lines(docs, min_docs=2).select("doc_id", "n_lines", "n_dropped").collect()}
    assert got[1] == (WORDS // 20, (WORDS - 2000) // 20) and got[3] == (1, 0)


def test_quality(docs, texts):
    got = {r.doc_id: r for r in quality.judge(docs).select("doc_id", "n_words", "n_repeat_words", "kept").collect()}
    assert got[1].n_words == WORDS and got[1].kept and not got[4].kept
    assert quality.clean_good(docs).columns == docs.columns


def test_near_duplicates(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got[1][1] == got[2][1] == 1 and got[3][1] == 3 and got[4] == (1, 4) and got[1][0] > WORDS * 0.99


def test_repeats(docs, texts):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.repeated_spans(docs).collect()}
    assert got == {1: (WORDS, 0), 2: (WORDS - 2000, WORDS - 2000), 3: (6, 0), 4: (1, 0)}


def test_packing(docs, texts):
    pieces = packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))
    got = {r.doc_id: (r.n, r.pieces) for r in pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces")).collect()}
    assert got[1][0] > WORDS and all(p == -(-n // 2048) for n, p in got.values())


def test_scores_and_mix(docs):
    scores = {r.doc_id: r for r in lm.lm_scores(docs, order=3).collect()}
    assert scores[1].n_tokens == WORDS + 1 and scores[4].n_tokens == 2 and all(r.score < 0 for r in scores.values())
    mixed = mixing.mix(docs).collect()
    assert {r.doc_id: r["size"] for r in mixed} == {1: WORDS, 2: WORDS - 2000, 3: 6, 4: 1}
    assert mixing.apply_mix(docs, mixing.mix(docs)).columns == docs.columns


def test_alignment(docs):
    got = {r.doc_id: r for r in alignment.align_documents(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).collect()}
    assert got[1].n_a > WORDS and got[1].n_links >= max(got[1].n_a, got[1].n_b) and got[4].n_groups >= 1
    assert all(len(r.groups_sha256) == 64 for r in got.values())


def test_personal_data(spark, docs, texts):
    data = [(1, texts[0][1] + " +1 (212) 555-0147 end"), (2, "call 10.0.0.1 " * 100_000)]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    at = len(texts[0][1]) + 1
    assert got[1].spans == f"phone:{at}:{at + 17}" and got[2].n_ip == 100_000
    assert pii.redact(docs).columns == docs.columns


def test_conversation(spark, texts):
    rows = [(1, t, ("user", "assistant")[t % 2], texts[0][1] if t < 3 else "So.") for t in range(4)]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, ck string, symbol string")
    row = conversations.repair_conversations(frame).first()
    # The third row repeats the first: it goes, and what follows it needs a user before it or goes as well.
    assert (row.duplicate, row.truncated) == (1, 2) and len(row.audit) >= 4
    assert len(row.repaired_sha256) == 64 and row.repaired_sha256 != hashlib.sha256(b"").hexdigest()
