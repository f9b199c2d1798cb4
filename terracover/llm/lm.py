"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of orders 1 to ``order`` and a uniform share
``1 / (V + 1)``. Mixture weights depend on a bucket: the longest context that was seen, and
the power of two of its count. Part of the training documents (one remainder) is deleted
from the counts while the weights are learned: expectation-maximisation finds the weights
under which the others predict its n-grams best. Scores then use the counts of all
training documents with these weights.

Shape of the job: texts are staged in batches of some megabytes, one compressed row each.
A batch asks once for each distinct n-gram it holds, in arrays cut by hash range; the task
of a range adds up the counts of all batches and answers each in its own order. So n-grams
travel as differences of sorted hashes without a row of their own, and a word that every document holds
costs a range one entry per batch. No table of n-grams is collected or broadcast; the
driver sees weights, at most 48 per order and component, and totals. Ranges grow in number
with the corpus, so their size stays.

Defined results: a null or empty text is the end token alone. Rows are scored one by one,
repeated rows alike; null ids count as training. Without training documents the uniform
share is all there is. N-grams are told apart by 61-bit hashes. A very long text is scored
whole, in a batch of its own. Only the two named columns are read, clashing names have no
effect. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.llm.sketch import _GOLD, WordHashes, mix64
from terracover.llm.text import row_key
from terracover.sources.staging import stage

BATCH = 4 << 20  # bytes of text in a batch
RANGE = 3 << 20  # n-grams asked for in a hash range, about
PART = 1 << 17  # tokens of a batch estimated at once
POWERS = 48
RANDOM = 5  # low bytes of a difference between sorted hashes that no code shortens
SHORT = 24  # bytes of a word that is hashed with all others at once
BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


def _zip(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _unzip(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _batches(deleted: int):
    """One row per batch of documents; deleted documents go to batches of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made, kind = TaskContext.get().partitionId() << 32, 0, None
        waiting: dict[bool, list] = {False: [], True: []}
        held = {False: 0, True: 0}

        def flush(apart: bool) -> pa.RecordBatch:
            nonlocal made
            keys, ids, folds, texts = zip(*waiting[apart])
            waiting[apart], held[apart] = [], 0
            sizes = np.array([len(t) for t in texts], np.int64)
            made += 1
            row = [
                ([base + made], pa.int64()), ([apart], pa.bool_()), ([list(keys)], pa.list_(pa.binary())),
                ([list(ids)], pa.list_(kind)), ([list(folds)], pa.list_(pa.int32())),
                ([sum(len(t.split()) + 1 for t in texts)], pa.int64()),
                ([sizes.tobytes()], pa.binary()), ([zstandard.compress(b"".join(texts), 6)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in row], names=["batch", "apart", "keys", "ids", "folds", "tokens", "sizes", "texts"]
            )

        for batch in batches:
            kind = batch.column("id").type
            for key, id_, fold, text in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "fold", "text"))):
                raw, apart = (text or "").encode().lower(), fold == deleted
                waiting[apart].append((key, id_, fold, raw))
                held[apart] += len(raw) + 64
                if held[apart] >= BATCH:
                    yield flush(apart)
        for apart in (False, True):
            if waiting[apart]:
                yield flush(apart)

    return run


def _zip_planes(values: np.ndarray) -> bytes:
    """Byte by byte, as many as the largest number has: the high bytes of small numbers are all but empty."""
    values = values.view(np.uint64)
    many = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.empty((many, len(values)), np.uint8)
    for i in range(many):
        planes[i] = values >> np.uint64(8 * i) & np.uint64(255)
    return bytes([many]) + zstandard.compress(planes, 1)


def _unzip_planes(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(memoryview(data)[1:]), np.uint8).reshape(data[0], -1)
    values = planes[0].astype(np.uint64)
    for i in range(1, len(planes)):
        values |= planes[i].astype(np.uint64) << np.uint64(8 * i)
    return values.view(kind)


def _zip_sorted(values: np.ndarray, order: int) -> list[bytes]:
    """Ascending hashes, order by order without its mark, as differences.

    Their low bytes are random and go as they are; the high ones are compressed apart, byte by byte,
    so that the code for them is not spoilt by the low ones.
    """
    marks = values & np.uint64(7)
    parts = [np.diff(values[marks == np.uint64(m)] >> np.uint64(3), prepend=np.uint64(0)) for m in range(1, order + 1)]
    low = [x.view(np.uint8).reshape(-1, 8)[:, :RANDOM].tobytes() for x in parts]
    return [*low, _zip_planes(np.concatenate(parts) >> np.uint64(8 * RANDOM))]


def _unzip_sorted(parts: list[bytes]) -> np.ndarray:
    *low, high = parts
    ends = np.cumsum([len(x) // RANDOM for x in low])
    found = np.zeros((ends[-1], 8), np.uint8)
    found[:, :RANDOM] = np.frombuffer(b"".join(low), np.uint8).reshape(-1, RANDOM)
    found = found.view(np.uint64).ravel()
    found |= _unzip_planes(high, np.uint64) << np.uint64(8 * RANDOM)
    for m, (i, j) in enumerate(zip([0, *ends[:-1]], ends), 1):
        found[i:j] = np.cumsum(found[i:j], dtype=np.uint64) << np.uint64(3) | np.uint64(m)
    found.sort(kind="stable")
    return found


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, where each given value is among them, the sorting order, and where a value begins in it.

    As ``np.unique``, in half the memory.
    """
    order = np.argsort(values)
    values = values[order]
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    number = np.cumsum(fresh, dtype=np.int32)
    number -= 1
    inverse = np.empty(len(values), np.int32)
    inverse[order] = number
    return values[fresh], inverse, order, np.flatnonzero(fresh)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: a row is a whole batch of texts."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _word_hashes(raw: bytes, sizes: np.ndarray, cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that follow each other in ``raw``, and their number by text.

    Short words are mixed eight bytes at a time, all words at once; longer ones go through the cache.
    """
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[sizes > 0]
    inside = ~BLANK[np.frombuffer(raw, np.uint8)]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    edge[starts] = inside[starts]
    begins = np.flatnonzero(edge)
    np.copyto(edge, inside)
    edge[:-1] &= ~inside[1:]
    edge[starts[1:] - 1] = inside[starts[1:] - 1]
    lengths = np.flatnonzero(edge) + 1 - begins
    del inside, edge
    # Any eight bytes of the texts, as one number.
    eights = np.ndarray(len(raw) + 1, "<u8", raw + bytes(8), strides=1)
    found = lengths.astype(np.uint64)
    with np.errstate(over="ignore"):
        found *= _GOLD
        for at in range(0, SHORT, 8):
            live = np.flatnonzero(lengths > at)
            chunk = eights[begins[live] + at] & LOW_BYTES[np.minimum(lengths[live] - at, 8)]
            found[live] = mix64(found[live] ^ chunk)
    long = np.flatnonzero(lengths > SHORT)
    found[long] = cache.of([raw[i:i + n] for i, n in zip(begins[long].tolist(), lengths[long].tolist())])
    return found, np.diff(np.searchsorted(begins, ends), prepend=0)


class Grams:
    """N-grams of a batch: sorted distinct ones, and for every token where its own are."""

    def __init__(self, sizes: bytes, texts: bytes, order: int, cache: WordHashes):
        words, lengths = _word_hashes(zstandard.decompress(texts), np.frombuffer(sizes, np.int64), cache)
        lengths += 1
        # ``order`` start marks before each document: the context of its first token is all marks.
        token = np.ones(len(words) + len(lengths) * (order + 1), bool)
        begins = np.cumsum(lengths + order) - lengths - order
        for k in range(order):
            token[begins + k] = False
        items, ends = np.full(len(token), START), begins + order + lengths - 1
        items[ends], token[ends] = END, False
        items[token] = words
        token[ends] = True
        self.document = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.first = np.zeros(len(self.document), bool)
        self.first[np.cumsum(lengths) - lengths] = True
        del words
        # One order at a time: the mark in the low bits tells the orders apart, and so where each order's values are among all.
        found, level = [], np.zeros(len(items), np.uint64)
        self.order, self.place = order, np.empty((order, len(self.document)), np.int32)
        with np.errstate(over="ignore"):
            for m in range(1, order + 1):
                level = mix64(np.concatenate([[np.uint64(0)], level[:-1]]) * np.uint64(m > 1) + _GOLD ^ mix64(items + np.uint64(m)))
                distinct, self.place[m - 1] = _distinct((level & ~np.uint64(7) | np.uint64(m))[token])[:2]
                found.append(distinct)
        del items, level, token, distinct
        self.distinct = np.concatenate(found)
        del found
        self.distinct.sort()
        for m in range(1, order + 1):
            self.place[m - 1] = np.flatnonzero((self.distinct & np.uint64(7)) == m).astype(np.int32)[self.place[m - 1]]
        # The longest n-gram of a token settles its estimates: one token stands for all of the same.
        longest = self.place[-1]
        # These tokens are kept in their order in the texts, so that what is looked up for neighbours lies together.
        number, tokens = np.empty(len(self.distinct), np.int32), np.arange(len(longest), dtype=np.int32)
        number[longest[::-1]] = tokens[::-1]
        self.one = tokens[number[longest] == tokens]
        number[longest[self.one]] = tokens[:len(self.one)]
        self.like = number[longest]

    def ranges(self, many: int) -> list[tuple[int, int]]:
        """Slices of ``distinct`` by equal hash ranges."""
        edges = np.array([(r << 64) // many for r in range(1, many)], np.uint64)
        cuts = [0, *np.searchsorted(self.distinct, edges).tolist(), len(self.distinct)]
        return list(zip(cuts[:-1], cuts[1:]))

    def parts(self) -> list[slice]:
        """Slices of ``one`` whose estimates are held at once."""
        return [slice(i, i + PART) for i in range(0, len(self.one), PART)]

    def estimates(self, counts: np.ndarray, total: float, documents: float, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and likelihood estimates by order for a part of the tokens ``one``, from counts of ``distinct``."""
        at = self.one[part]
        own = counts[self.place[:, at]].astype(np.float64)
        context = np.empty_like(own)
        context[0] = total
        for m in range(1, self.order):
            context[m] = np.where(self.first[at], documents, counts[self.place[m - 1, at - 1]])
        with np.errstate(divide="ignore", invalid="ignore"):
            estimate = np.where(context > 0, own / context, 0.0)
        longest = np.maximum.reduce([np.where(context[m] > 0, m, 0) for m in range(self.order)])
        seen = np.take_along_axis(context, longest[None, :], 0)[0]
        power = np.where(longest > 0, np.minimum(POWERS - 1, np.log2(np.maximum(seen, 1)).astype(np.int64)), 0)
        return longest * POWERS + power, estimate


def _ask(order: int, many: int):
    names = ["range", "batch", "apart", "grams", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for row in _rows(batches):
            grams = Grams(row["sizes"], row["texts"], order, cache)
            trains = np.array(row["trains"], np.float64)[grams.document]
            counts = sum(np.bincount(grams.place[m], trains, len(grams.distinct)) for m in range(order)).astype(np.int64)
            for r, (low, high) in enumerate(grams.ranges(many)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([r], pa.int32()), pa.array([row["batch"]], pa.int64()), pa.array([row["apart"]]),
                    pa.array([_zip_sorted(grams.distinct[low:high], order)], pa.list_(pa.binary())), pa.array([_zip_planes(counts[low:high])], pa.binary()),
                ], names=names)

    return run


def _answer(rows: pa.Table) -> pa.Table:
    """Counts of a hash range over all batches, in the order each batch asked; and the range's totals."""
    asked = [_unzip_sorted(g.as_py()) for g in rows.column("grams")]
    cuts = np.cumsum([0, *[len(a) for a in asked]])
    asked = np.concatenate(asked)
    distinct, inverse, order, begins = _distinct(asked)
    del asked
    counts = np.concatenate([_unzip_planes(c.as_py(), np.int64) for c in rows.column("counts")])
    every = np.add.reduceat(counts[order], begins) if len(counts) else counts
    for held, i, j in zip(rows.column("apart").to_pylist(), cuts[:-1], cuts[1:]):
        counts[i:j] *= not held
    kept = np.add.reduceat(counts[order], begins) if len(counts) else counts
    del counts, order, begins
    word = (distinct & np.uint64(7)) == 1
    # Only deleted batches ask for the counts without the deleted ones.
    out = [(b, _zip_planes(every[inverse[i:j]]), _zip_planes(kept[inverse[i:j]]) if held else None, 0, 0, 0)
           for b, held, i, j in zip(rows.column("batch").to_pylist(), rows.column("apart").to_pylist(), cuts[:-1], cuts[1:])]
    out.append((None, None, None, int((every[word] > 0).sum()), int(every[word].sum()), int(kept[word].sum())))
    number = rows.column("range")[0].as_py()
    types = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.Table.from_arrays(
        [pa.array([number] * len(out), pa.int32()), *[pa.array(c, t) for c, t in zip(zip(*out), types)]],
        names=["range", "batch", "every", "kept", "vocabulary", "tokens", "kept_tokens"],
    )


def _answered(row: dict, which: str) -> np.ndarray:
    return np.concatenate([_unzip_planes(a[which], np.int64) for a in sorted(row["answers"], key=lambda a: a["range"])])


def _held_out(order: int, total: int, documents: int):
    """Distinct n-grams of a deleted batch: bucket, estimates from the other batches, count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for row in _rows(batches):
            grams = Grams(row["sizes"], row["texts"], order, cache)
            counts = _answered(row, "kept")
            buckets, estimates = np.empty(len(grams.one), np.int16), np.empty((order, len(grams.one)), np.float32)
            for part in grams.parts():
                buckets[part], estimates[:, part] = grams.estimates(counts, total, documents, part)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (
                _zip(buckets), _zip(estimates), _zip(np.bincount(grams.like).astype(np.int32))
            )], names=["buckets", "estimates", "times"])

    return run


def mixed(weights: np.ndarray, bucket: np.ndarray, estimate: np.ndarray, uniform: float) -> np.ndarray:
    """Components of the mixture per n-gram: the uniform share, then the orders."""
    parts = np.empty((len(estimate) + 1, len(bucket)))
    parts[0] = uniform
    parts[1:] = estimate
    return parts * weights[bucket].T


def _expect(weights: np.ndarray, uniform: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, fit = np.zeros_like(weights), 0.0
        for row in _rows(batches):
            buckets, every = _unzip(row["buckets"], np.int16), _unzip(row["times"], np.int32)
            estimates = _unzip(row["estimates"], np.float32).reshape(-1, len(buckets))
            for i in range(0, len(buckets), PART):
                part = slice(i, i + PART)
                bucket, times = buckets[part].astype(np.int64), every[part].astype(np.float64)
                parts = mixed(weights, bucket, estimates[:, part].astype(np.float64), uniform)
                mass = parts.sum(axis=0)
                fit += float((times * np.log(mass)).sum())
                for c in range(len(parts)):
                    total[:, c] += np.bincount(bucket, times * parts[c] / mass, len(weights))
        used = np.flatnonzero(total.sum(axis=1) > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *used.tolist()], pa.int32()), pa.array([[fit], *total[used].tolist()], pa.list_(pa.float64()))],
            names=["bucket", "mass"],
        )

    return run


def initial_weights(order: int) -> np.ndarray:
    """Equal shares of the uniform part and the orders whose context was seen."""
    weights = np.zeros((order * POWERS, order + 1))
    for m in range(order):
        weights[m * POWERS:(m + 1) * POWERS, :m + 2] = 1 / (m + 2)
    return weights


def learn_weights(held: DataFrame, order: int, uniform: float, rounds: int, tolerance: float) -> np.ndarray:
    """Expectation-maximisation over held-out n-grams; a hundredth of a count per component keeps all weights positive."""
    weights, last = initial_weights(order), None
    prior = 0.01 * (weights > 0)
    for _ in range(rounds):
        found = held.mapInArrow(_expect(weights, uniform), "bucket int, mass array<double>").select("bucket", F.posexplode("mass").alias("c", "x"))
        mass, fit = prior.copy(), 0.0
        for bucket, c, x in found.groupBy("bucket", "c").agg(F.sum("x")).collect():
            if bucket < 0:
                fit = x
            else:
                mass[bucket, c] += x
        used = mass.sum(axis=1) > prior.sum(axis=1)
        weights = np.where(used[:, None], mass / mass.sum(axis=1, keepdims=True), weights)
        if last is not None and abs(fit - last) <= tolerance * abs(last):
            break
        last = fit
    return weights


def _score(order: int, weights: np.ndarray, vocabulary: int, total: int, documents: int):
    names = ["key", "id", "fold", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            kind = batch.column("ids").type.value_type
            for row in _rows([batch]):
                grams = Grams(row["sizes"], row["texts"], order, cache)
                counts = _answered(row, "every")
                score = np.empty(len(grams.one))
                for part in grams.parts():
                    bucket, estimate = grams.estimates(counts, total, documents, part)
                    score[part] = np.log10(mixed(weights, bucket, estimate, 1 / (vocabulary + 1)).sum(axis=0))
                own = counts[grams.place[0, grams.one]]
                many = len(row["keys"])
                add = lambda x: np.bincount(grams.document, x[grams.like], many)
                base = np.log10((own + 1) / (total + vocabulary + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["keys"], pa.binary()), pa.array(row["ids"], kind), pa.array(row["folds"], pa.int32()),
                    pa.array(np.bincount(grams.document, minlength=many)), pa.array(add(own > 0).astype(np.int64)),
                    pa.array(add(base)), pa.array(add(score)),
                ], names=names)

    return run


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2, folds: int = 7, unseen: int = 2,
    deleted: int = 5, rounds: int = 20, tolerance: float = 1e-5,
) -> DataFrame:
    """Per row: ``key``, id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Documents with crc32(id) mod ``folds`` = ``unseen`` are scored only; those with
    ``deleted`` train, and are the deleted part while the weights are learned. The base
    score is that of an add-one unigram model; both scores are log10 probabilities.
    """
    if not 1 <= order <= 7:
        raise ValueError("order must be 1 to 7")
    fold = F.pmod(F.crc32(F.coalesce(docs[id_col].cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")
    source = docs.select(row_key(docs[id_col], docs[text_col]).alias("key"), docs[id_col].alias("id"), fold.alias("fold"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    held = stage(source.mapInArrow(
        _batches(deleted), f"batch bigint, apart boolean, keys array<binary>, ids array<{kind}>, folds array<int>, tokens bigint, sizes binary, texts binary"
    ), "lm-batches")
    trains = F.transform("folds", lambda f: (f != unseen).cast("int"))
    held = held.withColumn("trains", trains)
    n_train = F.aggregate("trains", F.lit(0), lambda s, t: s + t)
    tokens, documents, kept_documents = held.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum(n_train), F.lit(0)),
        F.coalesce(F.sum(F.when(~F.col("apart"), n_train)), F.lit(0)),
    ).first()
    many = max(32, -(-tokens * order // RANGE))
    answers = stage(
        held.select("batch", "apart", "sizes", "texts", "trains")
        .mapInArrow(_ask(order, many), "range int, batch bigint, apart boolean, grams array<binary>, counts binary")
        .groupBy("range").applyInArrow(
            _answer, "range int, batch bigint, every binary, kept binary, vocabulary bigint, tokens bigint, kept_tokens bigint"
        ), "lm-answers", free=True,
    )
    vocabulary, total, kept_total = [x or 0 for x in answers.agg(F.sum("vocabulary"), F.sum("tokens"), F.sum("kept_tokens")).first()]

    def met(batches: DataFrame, which: str) -> DataFrame:
        own = answers.where("batch IS NOT NULL").groupBy("batch").agg(F.collect_list(F.struct("range", which)).alias("answers"))
        return batches.join(own, "batch")

    apart = met(held.where("apart").select("batch", "sizes", "texts"), "kept")
    grams = stage(apart.mapInArrow(
        _held_out(order, kept_total, kept_documents), "buckets binary, estimates binary, times binary"
    ), "lm-held-out", free=True)
    weights = learn_weights(grams, order, 1 / (vocabulary + 1), rounds, tolerance)
    scored = met(held.select("batch", "keys", "ids", "folds", "sizes", "texts"), "every").mapInArrow(
        _score(order, weights, vocabulary, total, documents),
        f"key binary, id {kind}, fold int, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scored.select(
        "key", F.col("id").alias(id_col), (F.col("fold") == unseen).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
    )
