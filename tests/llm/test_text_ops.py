"""Line dedup, quality rules, mixing, near-dedup, substrings, packing and scores against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import SCHEMA, rows

from terracover.llm import line_dedup, lm, minhash, mixing, packing, quality, substrings

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = rows()
TEXTS = [(r[0], r[1]) for r in ROWS]


def words(text, fold=False):
    text = text or ""
    return WORDS.findall(text.translate(LOWER) if fold else text)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_line_dedup(docs, empty):
    out = line_dedup.drop_frequent_lines(docs, min_docs=10)
    assert {c.lower() for c in docs.columns} | {"n_dropped"} == {c.lower() for c in out.columns}
    split = [(i, (t or "").split("\n")) for i, t in TEXTS]
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(LOWER)
    holders = defaultdict(set)  # documents, by id or else by text
    for (i, t), (_, lines) in zip(TEXTS, split):
        for x in lines:
            holders[key(x)].add(i if i is not None else ("text", t))
    seen = {k: len(d) for k, d in holders.items()}
    want = []
    for i, lines in split:
        kept = [x for x in lines if not key(x) or seen[key(x)] < 10]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    same([tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect()], want)
    assert any(w[2] for w in want)
    assert line_dedup.drop_frequent_lines(empty).count() == 0


def test_lines_are_counted_by_document_not_by_row(spark):
    rows_ = [(1, "said often\nown 1")] * 12 + [(i, f"said widely\nown {i}") for i in range(2, 12)] + [(None, "said widely\nx")] * 3
    frame = spark.createDataFrame(rows_, "doc_id bigint, text string").repartition(5)
    got = {(r.doc_id, r.text) for r in line_dedup.drop_frequent_lines(frame, min_docs=10).collect()}
    assert got == {(1, "said often\nown 1"), (None, "x"), *((i, f"own {i}") for i in range(2, 12))}
    assert {r.text for r in line_dedup.drop_frequent_lines(frame, min_docs=12).collect()} == {t for _, t in rows_}


def test_quality_counts(docs, empty):
    want = []
    for i, t in TEXTS:
        w = words(t)
        grams = [tuple(w[j:j + 8]) for j in range(len(w) - 7)]
        times, covered = Counter(grams), set()
        for j, g in enumerate(grams):
            if times[g] > 1:
                covered.update(range(j, j + 8))
        lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
        bad = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), bad))
    got = quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    same([tuple(r) for r in got.collect()], want)
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in quality.judge(docs).collect()) > 0


def test_quality_rejects_depleted_documents_but_not_copies(spark):
    own = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(60)]
    menu = "\n".join(" ".join(f"menu{k}x{j}" for j in range(12)) for k in range(8))
    data = [(i, own[i] + "\n" + (menu if i < 30 else "")) for i in range(60)] + [(100 + i, own[59]) for i in range(50)]
    frame = spark.createDataFrame([(i, t, "host") for i, t in data], "doc_id bigint, text string, source string")
    judged = {r.doc_id: r for r in quality.judge(frame, min_docs=20).collect()}
    assert all(judged[i].n_removed == 96 and not judged[i].kept for i in range(30))
    assert all(judged[i].kept for i in [*range(30, 60), *range(100, 150)])


def test_boilerplate_lines_leave_the_texts(spark):
    menu = ["Home | About us | Contact", "all rights reserved by the publisher of this site"]
    own = {i: [" ".join(f"w{i}x{j}" for j in range(k, 60, 3)) for k in range(3)] for i in range(40)}
    texts = {i: "\n".join(["", menu[0].upper() if i % 2 else menu[0], own[i][0], "", *own[i][1:], f"  {menu[1]}\t", *([menu[0]] * (i % 3))]) for i in range(30)}
    texts |= {i: "\n".join([*own[i], menu[1], ""]) for i in range(30, 40)}
    data = [(i, t, "host" if i < 30 else "other", None) for i, t in texts.items()] + [(50, menu[0] + "\n" + " ".join("abcdefghijklmnopqrstuvw"), "host", 1), (50, texts[3], "host", 2), (51, None, "host", 3)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, source string, gone int")
    bad = {" ".join(x.lower().split()) for x in menu}
    clean = lambda t: "\n".join(x for x in t.split("\n") if " ".join(x.lower().split()) not in bad)
    got = quality.clean_good(frame)
    assert got.columns == frame.columns
    same([(r.doc_id, r.text, r.gone) for r in got.collect()],
         [(i, clean(t) if s == "host" else t, g) for i, t, s, g in data if t is not None])
    tail = spark.createDataFrame([("a\nb\nc\n", [0, 1, 2, 3]), ("a\nb\nc\n", [1, 3]), ("a", []), ("", [0])], "t string, gone array<int>")
    assert [r[0] for r in tail.select(quality.without_places(tail["t"], tail["gone"])).collect()] == ["", "a\nc", "a", ""]


def test_registered_rule_equals_its_sql_where_documents_are_rejected(spark, tmp_path):
    from compare import connect, differences
    from terracover.llm.oracles import ORACLES
    from terracover.llm.queries import REGISTRY

    menu = "\n".join(" ".join(f"menu{k} x{j}" for j in range(12)) for k in range(8))
    own = lambda i: "\n".join(" ".join(f"w{i}x{j}" for j in range(k, 60, 2)) for k in range(2))
    data = [(i, own(i) + ("\n" + menu.upper() if i < 30 else ""), "a" if i % 4 else None) for i in range(120)]
    data += [(200 + i, own(7), "a") for i in range(40)] + [(300, None, "a"), (301, "", None)]
    spark.createDataFrame(data, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/parts")
    con = connect(str(tmp_path))
    con.execute(f"COPY (SELECT * FROM read_parquet('{tmp_path}/parts/*.parquet')) TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    found = REGISTRY["op4_quality_rules"](spark, str(tmp_path)).cache()
    assert differences(found, connect(str(tmp_path)), ORACLES["op4_quality_rules"]) == []
    verdicts = Counter((r.n_removed > 0, r.base_failed, r.kept) for r in found.collect())
    assert verdicts[True, False, False] >= 20 and verdicts[False, False, True] >= 100


def test_quality_counts_documents_that_share_their_longest_line(spark):
    notice = " ".join(f"notice{j}" for j in range(60))
    data = [(i, f"short line of {i} with a few words\n{notice}", "host") for i in range(30)]
    data += [(100 + i, "\n".join(" ".join(f"w{i}x{j}" for j in range(k, 40, 4)) for k in range(4)), "host") for i in range(5)]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(data, "doc_id bigint, text string, source string")).collect()}
    assert all(judged[i].n_removed == 60 and not judged[i].kept and not judged[i].base_failed for i in range(30))
    assert all(judged[100 + i].n_removed == 0 and judged[100 + i].kept for i in range(5))


def test_quality_limit_does_not_grow_with_the_source(spark):
    notice = " ".join(f"notice{j}" for j in range(60))
    data = [(i, f"short line of {i} with a few words\n{notice}" if i < 30 else f"document {i}", "host") for i in range(2000)]
    judged = quality.judge(spark.createDataFrame(data, "doc_id bigint, text string, source string")).where("doc_id < 30").collect()
    assert len(judged) == 30 and all(r.n_removed == 60 and not r.kept and not r.base_failed for r in judged)


def water(sizes, weights, total, most):
    """Targets by raising a level until the budget is spent."""
    budget, full = total * sum(sizes), set()
    while True:
        rest = [i for i in range(len(sizes)) if i not in full]
        left = budget - sum(most * sizes[i] for i in full)
        share = {i: left * weights[i] / sum(weights[j] for j in rest) for i in rest}
        over = {i for i in rest if share[i] > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in full else share[i] for i in range(len(sizes))]
        full |= over


def test_mixing(docs, empty):
    out = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = water([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2)
    taken = defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and r.taken <= 2 * r.size
        assert r.target == pytest.approx(targets[order.index(r.source)])
        assert r.taken == r.copies * r.size and r.copies >= math.floor(r.target / r.source_size)
        taken[r.source] += r.taken
    for s, t in zip(order, targets):
        assert abs(taken[s] - t) <= max(len(words(r[1])) for r in ROWS if r[3] == s)
    same([(r.doc_id, r.size) for r in out], [(i, len(words(t))) for i, t in TEXTS])
    again = mixing.mix(docs.repartition(5)).collect()
    same([(r.doc_id, r.taken) for r in again], [(r.doc_id, r.taken) for r in out])
    applied = mixing.apply_mix(docs, mixing.mix(docs))
    assert applied.columns == docs.columns and applied.count() == sum(r.copies for r in out)
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty, mixing.mix(empty)).count() == 0


def test_heavier_documents_are_drawn_more(spark):
    from pyspark.sql import functions as F

    data = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h i j").alias("text"), F.lit("s").alias("source"), (F.col("id") % 2).alias("good"))
    mixed = mixing.mix(data, total=0.5, quality=F.when(F.col("good") == 1, 1.0).otherwise(0.5))
    taken = mixed.withColumn("good", F.col("doc_id") % 2).groupBy("good").agg(F.sum("taken").alias("n")).collect()
    by = {r.good: r.n for r in taken}
    assert by[0] + by[1] == 20000 and 1.25 < by[1] / by[0] < 1.75


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, empty, width, percent):
    sets = []
    for i, t in TEXTS:
        w = words(t, True)
        n = min(width, len(w))
        sets.append({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if w else set())
    parent = list(range(len(TEXTS)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(TEXTS):
        rank = (i is None, i or 0)
        least[find(x)] = min(least.get(find(x), rank), rank)
    pick = lambda x: None if least[find(x)][0] else least[find(x)][1]
    want = [(i, len(sets[x]), pick(x)) for x, (i, _) in enumerate(TEXTS)]
    got = minhash.near_duplicates(docs, width=width, percent=percent)
    same([tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()], want)
    kept = minhash.keep_one(docs, width=width, percent=percent)
    groups = len({find(x) for x in range(len(sets)) if sets[x]}) + sum(not s for s in sets)
    assert kept.columns == docs.columns and kept.count() == groups
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0


def test_many_near_copies_meet_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "MEMBERS", 8)
    base = [f"w{j}" for j in range(200)]
    data = [(i, " ".join(base[:i] + [f"new{i}"] + base[i + 1:])) for i in range(60)]
    got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_drifting_copies_in_small_chunks_equal_brute_force(spark, monkeypatch):
    """Chains whose ends are not alike, in chunks of a few members: links across chunks decide the groups."""
    import random

    monkeypatch.setattr(minhash, "MEMBERS", 3)
    monkeypatch.setattr(minhash, "LARGE", 5)
    rng = random.Random(12)
    data = []
    for chain in range(8):
        current = [f"c{chain}w{j}" for j in range(60)]
        for step in range(14):
            data.append((len(data), " ".join(current)))
            for _ in range(rng.choice([1, 1, 2])):
                current[rng.randrange(60)] = f"n{rng.random()}"
    data += [(1000 + i, f"lonely {i} " + " ".join(f"l{i}x{j}" for j in range(30))) for i in range(10)]
    rng.shuffle(data)
    sets = {i: {tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)} for i, t in data}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    found = minhash.near_duplicates(spark.createDataFrame(data, "doc_id bigint, text string").repartition(5), width=3, percent=75)
    got = {r.doc_id: r.component_id for r in found.collect()}
    assert got == {i: find(i) for i in sets}
    assert 10 < len(set(got.values())) < len(data)


def test_meetings_of_near_copies_grow_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(minhash, "MEMBERS", 8)
    seen, plain = {}, minhash.stage

    def watched(df, name):
        out = plain(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(minhash, "stage", watched)
    rows_of_sets = {}
    for n in (80, 320):
        seen.clear()
        base = [f"w{j}" for j in range(400)]
        data = [(i, " ".join(base[:i] + [f"new{i}"] + base[i + 1:])) for i in range(n)]
        frame = spark.createDataFrame(data, "doc_id bigint, text string")
        assert {r.component_id for r in minhash.near_duplicates(frame).collect()} == {0}
        assert seen["near-meetings"] == 0  # the first round connects them all
        rows_of_sets[n] = seen["near-chunks"]
    assert rows_of_sets[320] <= 1.1 * 4 * rows_of_sets[80]


def test_substrings(docs, empty):
    seen, want = {}, []
    for i, t in TEXTS:
        w = words(t)
        for p in range(len(w) - 49):
            k = tuple(w[p:p + 50])
            rank = (i is None, i or 0)
            seen[k] = min(seen.get(k, rank), rank)
    for i, t in TEXTS:
        w, gone = words(t), set()
        for p in range(len(w) - 49):
            if seen[tuple(w[p:p + 50])] < (i is None, i or 0):
                gone.update(range(p, p + 50))
        left = " ".join(x for p, x in enumerate(w) if p not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    got = substrings.repeated_spans(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same([tuple(r) for r in got], want)
    cut = substrings.without_repeats(docs)
    assert cut.columns == docs.columns
    same([(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in cut.collect()], [(w[0], w[3]) for w in want])
    assert substrings.repeated_spans(empty).count() == 0


def test_compaction_of_paths_and_cycles(spark):
    edges = [(i, i, i + 1) for i in range(1, 40)] + [(100, 20, 200), (300, 300, 301), (301, 301, 300)]
    found = {r.eid: (r.path, r["rank"]) for r in substrings.compact(spark.createDataFrame(edges, "eid bigint, u bigint, v bigint")).collect()}
    assert all(found[i] == (1, i - 1) for i in range(1, 20))
    assert all(found[i] == (20, i - 20) for i in range(20, 40))
    assert found[100] == (100, 0) and found[300] == (300, 0) and found[301] == (301, 0)


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    capacity, want, ids_of = 256, [], {}
    for i, t in TEXTS:
        ids = coder.encode(t or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            held = np.array(ids[at:at + capacity], "<u4").tobytes()
            want.append((i, n, at, len(held) // 4, zlib.crc32(held)))
            ids_of[zlib.crc32(held)] = held
    packed = packing.pack_documents(docs, path, capacity=capacity, with_ids=True).cache()
    rows_ = packed.collect()
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows_], want)
    by = defaultdict(list)
    for r in rows_:
        by[r.sequence_id].append((r.offset, r.length, r.ids_crc32))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    counts = np.bincount([r.length for r in rows_], minlength=capacity + 1)
    assert len(by) <= packing.lower_bound(counts, capacity) + 1
    for r in packing.sequences(packed).collect():
        assert bytes(r.ids) == b"".join(ids_of[c] for _, _, c in sorted(by[r.sequence_id]))
    assert packing.pack_documents(empty, path).count() == 0


def test_partitions_with_gaps_exchange_pieces(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "PART", 50)
    pieces = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 700).otherwise(300 + F.col("id") % 40).cast("bigint").alias("length"))
    packed = packing.pack(pieces, capacity=1000).collect()
    counts = np.bincount([r.length for r in packed], minlength=1001)
    first = -(-1000 // 50)
    assert len(packed) == 1000 and len({r.sequence_id for r in packed}) <= packing.lower_bound(counts, 1000) + first


@pytest.mark.parametrize("sizes,bins", [([6, 6, 6], 3), ([5, 5, 5, 5], 2), ([10], 1), ([4, 4, 4, 4, 4, 4], 3), ([7, 3, 7, 3], 2), ([], 0)])
def test_lower_bounds_are_bounds(sizes, bins):
    counts = np.bincount(sizes or [0], minlength=11)
    counts[0] = 0
    assert packing.lower_bound(counts, 10) == bins
    assert packing.best_fit(np.array(sizes, np.int64), 10)[2] == bins


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(docs, empty, order):
    texts = [(i, zlib.crc32(str(i).encode() if i is not None else b"") % 7, [*words(t, True), None]) for i, t in TEXTS]

    def grams(tokens):
        padded = [0] * order + tokens
        for j in range(order, len(padded)):
            yield [tuple(padded[j - m:j + 1]) for m in range(order)]

    def count(folds):
        c, documents = Counter(), 0
        for _, f, tokens in texts:
            if f in folds:
                documents += 1
                c.update(g for each in grams(tokens) for g in each)
        return c, documents, sum(len(t) for _, f, t in texts if f in folds)

    def parts(each, c, documents, total):
        before = [total] + [documents if set(each[m][:-1]) == {0} else c[each[m][:-1]] for m in range(1, order)]
        longest = max([m for m in range(order) if before[m] > 0] or [0])
        power = min(47, int(math.log2(before[longest]))) if longest else 0
        return (longest, power), [1 / (vocabulary + 1)] + [c[each[m]] / before[m] if before[m] else 0.0 for m in range(order)]

    every, kept = count({0, 1, 3, 4, 5, 6}), count({0, 1, 3, 4, 6})
    vocabulary = sum(1 for g in every[0] if len(g) == 1)
    held = Counter(tuple(each) for _, f, t in texts if f == 5 for each in grams(t))
    weights = {}
    default = lambda b: [1 / (b[0] + 2) if m < b[0] + 2 else 0 for m in range(order + 1)]
    last = None
    for _ in range(20):
        mass, fit = {}, 0.0
        for each, n in held.items():
            b, p = parts(each, *kept)
            mixed = [w * x for w, x in zip(weights.get(b) or default(b), p)]
            fit += n * math.log(sum(mixed))
            own = mass.setdefault(b, [0.01 if m < b[0] + 2 else 0 for m in range(order + 1)])
            for m, x in enumerate(mixed):
                own[m] += n * x / sum(mixed)
        weights = {b: [x / sum(m) for x in m] for b, m in mass.items()}
        if last is not None and abs(fit - last) <= 1e-5 * abs(last):
            break
        last = fit
    got = lm.lm_scores(docs, order=order).collect()
    want = []
    for i, f, tokens in texts:
        score = 0.0
        for each in grams(tokens):
            b, p = parts(each, *every)
            score += math.log10(sum(w * x for w, x in zip(weights.get(b) or default(b), p)))
        base = sum(math.log10((every[0][(t,)] + 1) / (every[2] + vocabulary + 1)) for t in tokens)
        known = sum(every[0][(t,)] > 0 for t in tokens)
        want.append((i, f == 2, len(tokens), known, every[2], round(base, 4), round(score, 2)))
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 2)) for r in got], want)
    assert lm.lm_scores(empty).count() == 0


def test_registered_scores_use_trigrams(spark, sf_dir):
    from terracover.llm.queries import op3_lm_scoring

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: r.score for r in lm.lm_scores(docs, order=3).collect()}
    got = {r.doc_id: r.score for r in op3_lm_scoring(spark, sf_dir).collect()}
    assert got == pytest.approx(want)
    less = {r.doc_id: r.score for r in lm.lm_scores(docs, order=2).collect()}
    assert got != pytest.approx(less)


def test_chunks_fall_back_to_the_whole_tokenizer(spark):
    """A file whose splitter keeps blanks gets its own ids; the Latin short cut gives the tokenizer's."""
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [t for _, t in TEXTS] + ["ÀÉ Õñ straße ŒUVRE ſz ı İ ŉ ǅ", "Été. naïve, <|x ÉTÉ", "a" * 3000, "word " * 50_000]
    for name, whole in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        coder, chunks = Tokenizer.from_file(path), packing.ChunkIds(path)
        assert chunks.whole == whole
        for _ in range(2):
            ids, begins = chunks.encode(pa.array(texts))
            got = [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]
            assert got == [coder.encode(t or "", add_special_tokens=False).ids for t in texts]
    ids, begins = chunks.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and begins.tolist() == [0]


def test_full_cache_is_emptied_and_learnt_again(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    monkeypatch.setattr(packing, "CACHE", 20)
    chunks = packing.ChunkIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"w{i}x{j}" for j in range(15)) for i in range(6)]
    ids, begins = chunks.encode(pa.array(texts + texts))
    half = len(ids) // 2
    assert ids[:half].tolist() == ids[half:].tolist()
    again, _ = chunks.encode(pa.array(texts[:1]))
    assert again.tolist() == ids[begins[0]:begins[1]].tolist()


def test_packing_says_whether_the_bound_is_met(spark):
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate([6, 6, 4, 4, 7, 3])], "id int, length bigint")
    row = packing.packing_quality(packing.pack(pieces, 10), 10).first()
    assert (row["sequences"], row["bound"], row["tokens"], row["certified"]) == (3, 3, 30, True)


def test_steps_of_the_model_hold_little_beside_their_grams(monkeypatch):
    """Peak bytes per n-gram of a batch and of a hash range; the estimates of a batch are made part by part."""
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    import zstandard

    from terracover.llm.sketch import WordHashes

    rng, cache = random.Random(3), WordHashes()
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(1000)).encode() for _ in range(200)]
    sizes, raw = np.array([len(t) for t in texts], np.int64).tobytes(), zstandard.compress(b"".join(texts))
    lm.Grams(sizes, raw, 3, cache)

    def peak(work):
        tracemalloc.start()
        try:
            return work(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    grams, most = peak(lambda: lm.Grams(sizes, raw, 3, cache))
    tokens = 200 * 1001
    assert most < 55 * 3 * tokens
    assert (np.diff(grams.distinct.astype(object)) > 0).all() and grams.place.shape == (3, tokens)
    marks = grams.distinct[grams.place] & np.uint64(7)
    assert (marks == np.array([[1], [2], [3]], np.uint64)).all()
    asked = lm._zip_sorted(grams.distinct, 3)
    counts = np.bincount(grams.place.ravel(), minlength=len(grams.distinct))
    rows = pa.table({
        "range": pa.array([0] * 6, pa.int32()), "batch": pa.array(range(6), pa.int64()), "apart": [False, True] * 3,
        "grams": pa.array([asked] * 6, pa.list_(pa.binary())), "counts": pa.array([lm._zip_planes(counts)] * 6, pa.binary()),
    })
    found, most = peak(lambda: lm._answer(rows).to_pylist())
    assert most < 50 * 6 * len(grams.distinct)
    assert [(r["batch"], r["kept"] is None) for r in found] == [*((i, i % 2 == 0) for i in range(6)), (None, True)]
    assert all((lm._unzip_planes(r["every"], np.int64) == 6 * counts).all() for r in found[:6])
    assert all((lm._unzip_planes(r["kept"], np.int64) == 3 * counts).all() for r in found[1:6:2])
    assert (found[6]["tokens"], found[6]["kept_tokens"]) == (6 * tokens, 3 * tokens)
    monkeypatch.setattr(lm, "PART", 1000)
    whole = grams.estimates(counts, tokens, 200, slice(None))
    parts = [grams.estimates(counts, tokens, 200, part) for part in grams.parts()]
    assert len(parts) == -(-len(grams.one) // 1000) and all((np.concatenate(p, -1) == w).all() for p, w in zip(zip(*parts), whole))


def test_hashes_travel_in_little_more_than_their_information():
    """Sorted 61-bit hashes of a range and an order need log2(step) + log2(e) bits each; messages may take 3 % more."""
    import numpy as np

    rng, many, order = np.random.default_rng(5), 16, 3
    hashes = rng.integers(0, 1 << 61, 300_000, dtype=np.uint64) << np.uint64(3)
    marks = rng.choice([1, 2, 3], len(hashes), p=[0.1, 0.4, 0.5]).astype(np.uint64)
    values = np.unique(hashes | marks)
    least = sum(n * (61 - math.log2(n) + math.log2(math.e)) / 8 for n in np.bincount((values & np.uint64(7)).astype(int))[1:])
    edges = np.searchsorted(values, np.array([r << 60 for r in range(1, many)], np.uint64))
    sent = 0
    for part in np.split(values, edges):
        asked = lm._zip_sorted(part, order)
        assert (lm._unzip_sorted(asked) == part).all()
        sent += sum(map(len, asked))
    assert least < sent < 1.03 * least
    for part in (values[:0], values[:1], values[marks.argmax():][:2], np.array([1, 3, (1 << 64) - 7, (1 << 64) - 5], np.uint64)):
        assert lm._unzip_sorted(lm._zip_sorted(part, order)).tolist() == part.tolist()


def test_short_words_are_hashed_at_once_and_told_apart():
    """Same hash for same word, wherever its text begins or ends; only long words go through the cache."""
    import numpy as np

    from terracover.llm.sketch import WordHashes

    lengths = [1, 2, 7, 8, 9, 15, 16, 17, 23, 24, 25, 26, 60]
    near = [x * n for n in lengths for x in ("a", "b", "\0")] + ["a" * n + "\0" for n in lengths] + ["ab", "ba", "é", "\x85", "\xa0x", "\x1fy", "語" * 8, "語" * 9]
    texts = [
        "", " ", "a", "a", "", "b a", "\t\n\v\f\r a\n\nb \r\n", *near, "\n".join(near), " " + "\x0b".join(near[::-1]) + "\t", "", "a" * 8 + " " + "a" * 16, "  ",
    ]
    for some in (texts, texts[::-1], [""], ["", ""], [" "], ["a" * 30], ["x", "", "", "y"]):
        raw, cache = [t.encode() for t in some], WordHashes()
        split = [t.split() for t in raw]
        found, counts = lm._word_hashes(b"".join(raw), np.array([len(t) for t in raw], np.int64), cache)
        assert counts.tolist() == [len(w) for w in split]
        plain = [w for each in split for w in each]
        assert len(found) == len(plain) and len(set(zip(plain, found.tolist()))) == len(set(plain)) == len(set(found.tolist()))
        assert set(cache) == {w for w in plain if len(w) > 24}


def test_questions_of_the_model_do_not_stay_on_disk(spark):
    """Shuffle files of staged steps are gone when the scores are asked for, whenever the driver collects garbage."""
    import os
    import random

    import terracover.sources.staging as staging

    folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffled():
        return {p: os.path.getsize(p) for f in folders for at, _, names in os.walk(f) for n in names if n.startswith("shuffle_") for p in [os.path.join(at, n)]}

    rng, held = random.Random(8), spark.conf.get(staging.FREE_KEY, None)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(500))) for i in range(400)]
    docs, before = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), shuffled()
    scores = lm.lm_scores(docs, order=3, rounds=1)
    left = sum(n for p, n in shuffled().items() if p not in before)
    assert left < 500_000  # 600,000 n-grams of five bytes and more were asked for
    assert spark.conf.get(staging.FREE_KEY, None) == held
    assert scores.count() == len(rows)
