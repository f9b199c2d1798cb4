"""The whole pipeline over driver tables against plain Python, stage by stage."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from terracover.llm.oracles import ORACLES
from terracover.llm.queries import tokenizer

import corpus_pipeline

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\f\r"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sql_over(docs, sql):
    """Rows of DuckDB SQL with ``docs`` as the table documents."""
    import pyarrow as pa

    con = duckdb.connect()
    con.register("given", pa.Table.from_pylist([dict(zip(COLUMNS, d)) for d in docs]))
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, r)) for r in cursor.fetchall()]


def with_text(doc, text):
    return (doc[0], text, doc[2], doc[3], len(text))


def good(docs):
    """Documents that the rules keep; no line passes the limit in so few documents."""
    judged = {r["doc_id"]: r for r in sql_over(docs, ORACLES["op4_quality_rules"])}
    assert not any(r["n_removed"] for r in judged.values())
    return [with_text(d, d[1]) for d in docs if judged[d[0]]["kept"]]


def fewer_lines(docs):
    holders = defaultdict(set)
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for d in docs:
        for line in d[1].split("\n"):
            holders[key(line)].add(d[0])
    return [with_text(d, "\n".join(x for x in d[1].split("\n") if not key(x) or len(holders[key(x)]) < 10)) for d in docs]


def one_of_each(docs):
    def shingles(text):
        words = text.translate(LOWER).encode().split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(d[1]) for d in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                up[find(i)] = find(j)
    groups = defaultdict(list)
    for i, d in enumerate(docs):
        groups[find(i) if sets[i] else ("alone", i)].append(d)
    return [min(g, key=lambda d: d[0]) for g in groups.values()]


def mix(docs):
    taken = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in sql_over(docs, ORACLES["op9_mixing"])}
    return [d for d in docs for _ in range(taken[d[0]])]


def pieces(docs):
    coder = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    out = []
    for d in docs:
        ids = coder.encode(d[1], add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            held = np.array(ids[at:at + 2048], "<u4").tobytes()
            out.append((d[0], n, at, len(held) // 4, zlib.crc32(held)))
    return out


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    """What each stage returns, from the table the one before wrote."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf_dir).cache()
        out.append(docs)
    return out


def rows(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


@pytest.mark.parametrize("n, plain", [(0, good), (1, fewer_lines), (2, one_of_each)])
def test_stage_equals_plain_python(staged, n, plain):
    before, after = rows(staged[n]), rows(staged[n + 1])
    assert sorted(plain(before)) == sorted(after)
    assert staged[n + 1].columns == staged[0].columns


def test_mixing_takes_whole_documents_near_the_targets(staged):
    before, after = rows(staged[3]), rows(staged[4])
    want, got = Counter(mix(before)), Counter(after)
    # Documents without words are taken or not without effect on any budget.
    sized = lambda c: {d: n for d, n in c.items() if d[1].split()}
    assert sized(want) == sized(got)


def test_packing_places_every_piece(staged):
    found = staged[5].collect()
    assert Counter(pieces(rows(staged[4]))) == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held[:-1]]]).tolist()
        assert sum(n for _, n in held) <= 2048


def test_run_equals_its_stages(spark, sf_dir, staged):
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(key, staged[5].collect()))
