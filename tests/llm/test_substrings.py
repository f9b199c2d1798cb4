"""Substring dedup where hashes nearly clash, rows repeat and one passage is everywhere."""

import hashlib
import random

import numpy as np
import pytest

from terracover.llm import substrings
from terracover.llm.sketch import WordHashes, mix64

LENGTH = 50


def brute(docs):
    seen, out = {}, []
    for i, t in docs:
        w = t.split(" ")
        for p in range(len(w) - LENGTH + 1):
            k = tuple(w[p:p + LENGTH])
            seen[k] = min(seen.get(k, i), i)
    for i, t in docs:
        w, gone = t.split(" "), set()
        for p in range(len(w) - LENGTH + 1):
            if seen[tuple(w[p:p + LENGTH])] < i:
                gone.update(range(p, p + LENGTH))
        left = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def found(spark, docs, parts=3):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    return sorted(tuple(r) for r in substrings.repeated_spans(frame).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def colliding_pair():
    """Two texts that differ in one word, whose words between two selected k-mers agree in 32 bits of their hash."""
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(260)]
    cache, rolling, width = WordHashes(), substrings.RollingHash(), LENGTH - substrings.KMER + 1

    def nodes(words):
        prefix = rolling.prefix(cache.of(words))
        at = np.arange(len(words) - substrings.KMER + 1)
        return prefix, substrings.selected(rolling.spans(prefix, at, at + substrings.KMER), width)

    plain = [w.encode() for w in base]
    prefix, pos = nodes(plain)
    u, v = next((a, b) for a, b in zip(pos[:-1].tolist(), pos[1:].tolist()) if b - a > substrings.KMER + 2)
    at = u + substrings.KMER  # in no k-mer of u or v
    spellings = [f"w{i}".encode() for i in range(500_000)]
    h = cache.of(spellings)
    with np.errstate(over="ignore"):
        rest = prefix[v] - prefix[u] - cache.of([plain[at]])[0] * rolling.up[at]
        short = mix64((rest + h * rolling.up[at]) * rolling.down[u] + np.uint64(v - u)).astype(np.uint32)
    order = np.argsort(short, kind="stable")
    for i in np.flatnonzero(short[order][1:] == short[order][:-1]).tolist():
        texts = []
        for k in (order[i], order[i + 1]):
            words = [*plain[:at], spellings[k], *plain[at + 1:]]
            if nodes(words)[1].tolist() != pos.tolist():
                break
            texts.append(b" ".join(words).decode())
        if len(texts) == 2:
            return texts
    return None


def test_texts_whose_short_hashes_clash_keep_their_words(spark):
    pair = colliding_pair()
    assert pair
    docs = [(1, pair[0]), (2, pair[1])]
    assert found(spark, docs) == brute(docs)
    assert found(spark, docs)[1][2] == 259


@pytest.fixture()
def eager_split(spark):
    """Skewed joins split from a few bytes on, and no table is small enough to broadcast."""
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_repeated_rows_and_a_passage_everywhere_under_split_joins(spark, eager_split):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    text, passage = prose(120), prose(70)
    docs = [(7, text)] * 600 + [(i + 10, f"{prose(20)} {passage} {prose(15)}") for i in range(200)] + [(1, text + " " + prose(9))]
    got = found(spark, docs, 12)
    assert len(got) == 801 and got == brute(docs)


def test_join_on_a_hot_node_is_split(spark, eager_split):
    from terracover.operators.joins import large_join
    from terracover.sources.staging import stage

    rows = spark.range(200_000).selectExpr("CASE WHEN id % 2 = 0 THEN 1 ELSE id END node", "id AS pos")
    counted = stage(rows.groupBy("node").count().where("count > 0").select("node"), "hot-nodes")
    met = large_join(rows.repartition(16), counted, "node")
    assert met.count() == 200_000
    met.write.format("noop").mode("overwrite").save()
    met.collect()
    assert "skew=true" in met._jdf.queryExecution().executedPlan().toString()
