"""Alignment of two tokenizers against plain Python over the encoders' own output."""

from collections import Counter
from hashlib import sha256

import pytest
from odd import SCHEMA, rows

from terracover.llm import alignment
from terracover.llm.queries import REGISTRY, tokenizer

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def coders():
    return alignment.ByteLevel(tokenizer(A)), alignment.Pieces(tokenizer(B))


def decoded_a(coder, ids):
    """Bytes of each token by the library's own decoder tables."""
    from tokenizers.pre_tokenizers import ByteLevel

    letters = {}
    for i in range(256):
        shown = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(i))[0][0]
        letters.update(zip(shown, chr(i).encode()))
    return [bytes(letters[c] if c in letters else alignment.byte_letters()[c] for c in coder.coder.id_to_token(i)) for i in ids]


def plain(coders, text):
    """(ids of A, ids of B, groups, links) of one text, by byte ranges."""
    if not text:
        return None
    a, b = coders[0].encode([text])[0], coders[1].encode([text])[0]
    first, second = decoded_a(coders[0], a), [coders[1].bytes[i] for i in b]
    raw = b" " + text.encode()
    if b"".join(first) != raw or b"".join(second) != raw:
        return None

    def ranges(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    ra, rb = ranges(first), ranges(second)
    common = {e for _, e in ra} & {e for _, e in rb}
    groups, i, j = [], 0, 0
    for end in sorted(common):
        x, y = [], []
        while i < len(ra) and ra[i][1] <= end:
            x.append(a[i])
            i += 1
        while j < len(rb) and rb[j][1] <= end:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    links, j0 = [], 0
    for (s, e), i in zip(ra, a):
        while rb[j0][1] <= s:
            j0 += 1
        j = j0
        while j < len(rb) and rb[j][0] < e:
            links.append((i, b[j]))
            j += 1
    return a, b, groups, links


def expected(coders, docs):
    seen = {}
    found = [(i, seen[t] if t in seen else seen.setdefault(t, plain(coders, t))) for i, t in docs]
    count = Counter(pair for _, f in found if f for pair in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append((
            i, len(f[0]), len(f[1]), len(f[2]), len(f[3]), sum(count[p] == best[p[1]] for p in f[3]),
            sum(count[p] for p in f[3]), sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def results(df):
    return sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in df.collect()), key=repr)


def test_equals_plain_python_on_odd_texts(spark, coders, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH", 3000)
    more = ["a▁b", "▁", "<|endoftext|> <s> <0x41> </s>", "\n\nx\ty \r\n z　  q ", " ", "\x00 \x00", "\U0001F600‍́ naïve", "x" * 3000 + " " * 50 + "\n" * 40]
    docs = [(r[0], r[1]) for r in rows()] + [(1000 + i, t) for i, t in enumerate(more)]
    data = [(*r[:2], *r[2:]) for r in rows()] + [(1000 + i, t, *[None] * 14) for i, t in enumerate(more)]
    got = results(alignment.align_documents(spark.createDataFrame(data, SCHEMA).repartition(3), tokenizer(A), tokenizer(B)))
    assert got == expected(coders, docs)
    assert (1000, 0, 0, 0, 0, 0, 0, "") in got


def test_pair_counts_and_groups(spark, coders):
    docs = [(0, "hello hello world"), (1, "wörld hello"), (2, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    count = Counter(p for _, t in docs if t for p in plain(coders, t)[3])
    got = {(r["a_id"], r["b_id"]): r["n_links"] for r in alignment.pair_counts(frame, tokenizer(A), tokenizer(B)).collect()}
    assert got == count
    shown = {r["doc_id"]: r["groups"] for r in alignment.align_documents(frame, tokenizer(A), tokenizer(B), with_groups=True).collect()}
    assert shown[2] == "" and shown[0] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain(coders, docs[0][1])[2])


def test_empty_table_and_no_tokens(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align_documents(frame, tokenizer(A), tokenizer(B)).count() == 0
    frame = spark.createDataFrame([(1, ""), (None, None)], "doc_id bigint, text string")
    assert results(alignment.align_documents(frame, tokenizer(A), tokenizer(B))) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_identity_map(coders):
    same = alignment.identity_map(coders[0].bytes, coders[1].bytes, coders[1].fallback)
    known = [(a, b) for a, b in enumerate(same.tolist()) if b >= 0]
    assert len(known) > 5000 and all(coders[0].bytes[a] == coders[1].bytes[b] for a, b in known)
    whole = {x for x, f in zip(coders[1].bytes, coders[1].fallback) if not f}
    assert not any(coders[1].fallback[b] for a, b in known if coders[0].bytes[a] in whole)


def test_query_equals_plain_python(spark, sf_dir, coders):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert results(REGISTRY["op12_alignment"](spark, sf_dir)) == expected(coders, docs)


def test_ranks_give_the_ids_of_the_tokenizer(coders):
    whole = coders[0]
    assert whole.ranks is not None
    safe = [chr(c) for c in range(0x250) if not alignment._RARE.search(chr(c))] + [chr(c) for c in (*range(0x2010, 0x2028), 0x20AC, 0x2122, 0x4E00, 0x9FA5)]
    texts = [x for c in safe for x in (c, f"a{c}b 1{c}2", f" {c} {c}{c}", f"don't{c}'s\n\n {c}")] + ["".join(safe), "a  b\n\n\nc   ", "<|endoftext|> x"]
    slow = whole.coder.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert whole.encode(texts) == [x.ids for x in slow]
    assert [x.ids for x in slow] == [whole.ranks.encode_ordinary(" " + t) for t in texts]


def test_very_long_runs(coders):
    aligner = alignment.Aligner(tokenizer(A), tokenizer(B))
    texts = ["x" * 300_000, " " * 100_000, "word " * 200_000]
    found = aligner.align(texts)
    assert found["counts"][0].min() > 0 and (found["counts"][3] >= found["counts"][:2].max(axis=0)).all()
