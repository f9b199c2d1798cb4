"""Substring dedup: long repeated spans found by compacting a de Bruijn graph of token k-mers.

A word is removed if it lies in a window of ``length`` words whose word sequence also
starts in a document with a smaller id. The steps:

1. Every window holds the least of its k-mer hashes, so equal windows select equal k-mers.
   Only selected k-mers become nodes; two that follow one another in a document are joined
   by an edge, named by both k-mers and a hash of the words between.
2. Nodes found in one document only are left out; what remains is where repeats can be.
   Edges found in several documents form the graph. Paths through nodes with one way in and
   one way out are compacted by pointer doubling: every edge gets a path and a rank.
3. Runs of a document along a path become spans of source coordinates. Documents with the
   same stretch of the same path, whose k-mers and words between agree by a 128-bit digest
   over 64-bit hashes, hold the same words there; all but the least are covered.
4. Windows around repeated nodes that no such span covers are compared by their hash, which
   settles ends of spans, branches and repeats too short for an edge. The least document
   that holds a window never covers it, so none is missed.

The graph holds the selected k-mers only, about two in 35. Results stay exact: every window
holds a selected k-mer, so equal windows meet at one, and windows that no path covers are
compared one by one.

Shape of the job: the first pass stages a few numbers per selected k-mer. Copies share a
class (128 bits of the digest of all words) and are handled once; repeated rows are dropped
by a grouping before texts move. Counting is by partial aggregates; what is counted is staged
before rows meet it, so joins on hot k-mers have plain inputs, which the adaptive rules
broadcast if small and split otherwise. Texts move once, compressed, to meet the places
found in them.

Defined results: null texts have no words; texts shorter than a window keep all words. Null
ids rank after all others; documents with equal ids remove nothing from each other, so
repeated rows keep equal results. Very long texts are handled whole, one at a time. Only the
two named columns are read; :func:`without_repeats` keeps all columns whatever their names.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terracover.llm.sketch import WordHashes, mix64
from terracover.llm.text import packed, row_key, rows_in_chunks, unpacked, words_of
from terracover.operators.joins import large_join
from terracover.sources.staging import stage

KMER = 16
BATCH = 4 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2 ** 64
_EMPTY_SHA = sha256(b"").hexdigest()


class RollingHash:
    """Hashes of any run of words from prefix sums modulo 2 ** 64."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = 1 << n.bit_length()
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.append(np.uint64(1), np.full(size, _BASE, np.uint64)))
                self.down = np.cumprod(np.append(np.uint64(1), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)))

    def prefix(self, words: np.ndarray) -> np.ndarray:
        self._powers(len(words))
        with np.errstate(over="ignore"):
            return np.append(np.uint64(0), np.cumsum(words * self.up[:len(words)]))

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words [start, end) of each pair."""
        with np.errstate(over="ignore"):
            return mix64((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:len(x) - step], x[step:])
        done += step
    return x


def selected(kmers: np.ndarray, width: int) -> np.ndarray:
    """Places of k-mers that are the least of some ``width`` consecutive ones; ties are all selected."""
    least = _slide(kmers, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_slide(np.concatenate([pad, least, pad]), width, np.maximum) == kmers)


def _first_pass(length: int):
    names = ["key", "id", "n_words", "sha", "cls", "pos", "node", "seg"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, rolling = WordHashes(), RollingHash()
        for batch in rows_in_chunks(batches, "text", BATCH):
            out: list[list] = [[] for _ in range(6)]
            for text in batch.column("text").to_pylist():
                words = words_of(text, False)
                n = len(words)
                digest = sha256(b" ".join(words))
                row: list = [n, digest.hexdigest(), None, None, None, None]
                if n >= length:
                    h = cache.of(words)
                    prefix = rolling.prefix(h)
                    at = np.arange(n - KMER + 1)
                    kmers = rolling.spans(prefix, at, at + KMER)
                    pos = selected(kmers, length - KMER + 1)
                    seg = rolling.spans(prefix, pos[:-1], pos[1:]).view(np.int64)
                    row[2:] = [digest.digest()[:16], pos.astype(np.int32), kmers[pos].view(np.int64), np.append(seg, np.int64(0))]
                for column, value in zip(out, row):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").cast(pa.binary()), batch.column("id"), *[pa.array(c, t) for c, t in zip(out, types)]],
                names=names,
            )

    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = zstandard.ZstdCompressor(level=1)
    for batch in rows_in_chunks(batches, "text", BATCH):
        texts = [coder.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key").cast(pa.binary()), pa.array(texts, pa.binary())], names=["key", "packed"])


def _open_windows(length: int):
    """Per class the hashes of its windows around repeated nodes that no known span covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, rolling, coder = WordHashes(), RollingHash(), zstandard.ZstdDecompressor()
        for batch in rows_in_chunks(batches, "packed", BATCH // 4):
            starts, hashes = [], []
            for row in batch.select(["packed", "nodes", "spans"]).to_pylist():
                h = cache.of(words_of(coder.decompress(row["packed"]).decode(), False))
                last = len(h) - length
                nodes = np.array(row["nodes"], np.int64)
                change = np.zeros(last + 2, np.int64)
                np.add.at(change, np.maximum(0, nodes - (length - KMER)), 1)
                np.add.at(change, np.minimum(last, nodes) + 1, -1)
                wanted = np.cumsum(change[:-1]) > 0
                for span in row["spans"] or ():
                    wanted[span["start"]:span["end"] - length + 1] = False
                at = np.flatnonzero(wanted)
                starts.append(at.astype(np.int32))
                hashes.append(rolling.spans(rolling.prefix(h), at, at + length).view(np.int64))
            some = batch.select(["num", "id", "packed", "spans"])
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(starts, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))],
                names=["num", "id", "packed", "spans", "starts", "windows"],
            )

    return run


def merged(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(pairs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _cut(length: int):
    """Removed word ranges of a class, their size, and the digest of what is left."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in rows_in_chunks(batches, "packed", BATCH // 4):
            rows = []
            for row in batch.select(["num", "packed", "spans", "found"]).to_pylist():
                gone = merged([(s["start"], s["end"]) for s in row["spans"] or ()] + [(p, p + length) for p in row["found"] or ()])
                words = words_of(coder.decompress(row["packed"]).decode(), False)
                left, at = [], 0
                for start, end in gone:
                    left += words[at:start]
                    at = end
                left += words[at:]
                rows.append((row["num"], len(words) - len(left), sha256(b" ".join(left)).hexdigest(), [{"start": s, "end": e} for s, e in gone]))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), span))], names=["num", "lost", "left_sha", "gone"]
            )

    return run


def compact(edges: DataFrame) -> DataFrame:
    """(eid, path, rank): edges (eid, u, v) numbered along their nonbranching paths.

    An edge follows another on a path if the node between them has one way in and one way
    out. Pointers to the path's first edge double in every round. A cycle has no first edge;
    when only cycles still move, their edges become paths of their own.
    """
    into = edges.groupBy("v").agg(F.count("*").alias("n_in"), F.min("eid").alias("before"))
    out = edges.groupBy("u").agg(F.count("*").alias("n_out"))
    through = into.join(out, F.col("v") == F.col("u")).where("n_in = 1 AND n_out = 1").select(F.col("v").alias("node"), "before")
    table = stage(
        edges.join(through, F.col("u") == F.col("node"), "left").select(
            "eid", F.coalesce("before", "eid").alias("first"), F.col("before").isNotNull().cast("long").alias("rank")
        ), "paths-0",
    )
    heads = table.where("rank = 0").select("eid")
    turn, moving = 0, -1
    while True:
        turn += 1
        further = table.select(F.col("eid").alias("at"), F.col("first").alias("next"), F.col("rank").alias("more"))
        table = stage(table.join(further, F.col("first") == F.col("at")).select(
            "eid", F.col("next").alias("first"), (F.col("rank") + F.col("more")).alias("rank"), (F.col("more") > 0).alias("moved")
        ), f"paths-{turn}")
        last, moving = moving, table.where("moved").count()
        if moving in (0, last):  # every unfinished path loses edges in every round
            break
    ended = heads.select(F.col("eid").alias("head"))
    return table.join(ended, F.col("first") == F.col("head"), "left").select(
        "eid", F.coalesce("head", "eid").alias("path"), F.when(F.col("head").isNotNull(), F.col("rank")).otherwise(F.lit(0)).alias("rank")
    )


def path_spans(places: DataFrame, ranks: DataFrame, length: int) -> DataFrame:
    """(num, spans): long stretches that a class shares with one of lower rank, by paths of the graph.

    ``places``: (num, i, pos, node, seg) of repeated nodes; ``ranks``: (num, rank).
    """
    order = Window.partitionBy("num").orderBy("i")
    after = F.lead(F.struct("i", "node", "pos")).over(order)
    steps = places.withColumn("after", after).where("after.i = i + 1").select(
        "num", "i", "pos", F.col("after.pos").alias("to"), "seg", F.xxhash64("node", "after.node", "seg").alias("eid"),
        F.col("node").alias("u"), F.col("after.node").alias("v"),
    )
    steps = stage(steps, "graph-steps")
    edges = stage(
        steps.groupBy("eid", "u", "v").agg(F.min("num").alias("low"), F.max("num").alias("high"))
        .where("low <> high").select("eid", "u", "v"), "graph-edges",
    )
    paths = stage(compact(edges), "graph-paths")
    along = steps.join(paths, "eid").withColumn(
        # A run moves along its path one rank at a time.
        "step", F.coalesce(
            (F.lag(F.struct("i", "path", "rank")).over(order) == F.struct(
                (F.col("i") - 1).cast("int").alias("i"), "path", (F.col("rank") - 1).alias("rank"))).cast("int"), F.lit(0))
    ).withColumn("run", F.sum(1 - F.col("step")).over(order))
    content = ["rank", "u", "v", "seg"]
    runs = along.groupBy("num", "path", "run").agg(
        F.min("rank").alias("low"), F.max("rank").alias("high"), F.min("pos").alias("start"), (F.max("to") + KMER).alias("end"),
        F.bit_xor(F.xxhash64(*content)).alias("digest"), F.bit_xor(F.xxhash64(F.lit(1), *content)).alias("digest2"),
    ).where(F.col("end") - F.col("start") >= length).join(ranks, "num")
    runs = stage(runs.withColumn("size", F.col("end") - F.col("start")), "graph-runs")
    # Names of edges may clash: stretches are equal if their k-mers, the words between and their lengths are.
    same = ["path", "low", "high", "size", "digest", "digest2"]
    owner = stage(runs.groupBy(*same).agg(F.min("rank").alias("least")), "graph-owners")
    shared = runs.join(owner, same).where(F.col("rank") > F.col("least"))
    return shared.groupBy("num").agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))).alias("spans"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """Per row: ``key``, id, ``n_words``, ``n_removed``, ``kept_sha256`` and ``gone``, the removed word ranges."""
    source = docs.select(row_key(docs[id_col], docs[text_col]).alias("key"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    table = stage(source.mapInArrow(
        _first_pass(length),
        f"key binary, id {kind}, n_words bigint, sha string, cls binary, pos array<int>, node array<bigint>, seg array<bigint>",
    ), "kmers")
    rank = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    longs = table.where("cls IS NOT NULL")
    # One row and a short number per class, whatever the number of its copies; all later steps see this table.
    classes = stage(longs.groupBy("cls").agg(
        F.min(F.struct(rank.alias("rank"), "key")).alias("least"), F.first(F.struct("node", "pos", "seg")).alias("held")
    ).select("cls", F.monotonically_increasing_id().alias("num"), F.col("least.rank").alias("rank"), F.col("least.key").alias("rep"), "held"), "kmer-classes")
    repeated = stage(
        classes.select(F.explode(F.array_distinct("held.node")).alias("node")).groupBy("node")
        .agg(F.count("*").alias("n")).where("n > 1").select("node"), "kmer-repeated"
    )
    each = classes.select("num", F.posexplode(F.arrays_zip("held.node", "held.pos", "held.seg")).alias("i", "x")).select(
        "num", "i", *[F.col("x").getField(c).alias(c) for c in ("node", "pos", "seg")]
    )
    places = stage(large_join(each, repeated, "node").select("num", "i", "pos", "node", "seg"), "kmer-places")
    spans = path_spans(places, classes.select("num", "rank"), length)
    where = places.groupBy("num").agg(F.sort_array(F.collect_list("pos")).alias("nodes"))
    asked = classes.select("num", "rep", F.col("rank.id").alias("id")).join(where, "num").join(spans, "num", "left")
    # Equal rows share a key: one of them is kept, and the join needs no exchange after that.
    texts = source.select("key", "text").mapInArrow(_compress, "key binary, packed binary").dropDuplicates(["key"])
    met = texts.join(asked.hint("shuffle_hash"), F.col("key") == F.col("rep")).select("num", "id", "packed", "nodes", "spans")
    opened = stage(met.mapInArrow(
        _open_windows(length),
        f"num bigint, id {kind}, packed binary, spans array<struct<start:int,end:int>>, starts array<int>, windows array<bigint>",
    ), "windows")
    first = stage(
        opened.select(rank.alias("rank"), F.explode(F.array_distinct("windows")).alias("window")).groupBy("window")
        .agg(F.min("rank").alias("least"), F.max("rank").alias("most")).where("least < most").select("window", "least"), "windows-first"
    )
    held = opened.select("num", rank.alias("rank"), F.explode(F.arrays_zip("windows", "starts")).alias("x"))
    found = (
        large_join(held.select("num", "rank", F.col("x.windows").alias("window"), F.col("x.starts").alias("start")), first, "window").where(F.col("rank") > F.col("least"))
        .groupBy("num").agg(F.collect_list("start").alias("found"))
    )
    cut = opened.select("num", "packed", "spans").join(found.hint("shuffle_hash"), "num", "left").where("found IS NOT NULL OR size(spans) > 0").mapInArrow(
        _cut(length), "num bigint, lost bigint, left_sha string, gone array<struct<start:int,end:int>>"
    )
    known = classes.select("cls", "num", "rank").join(cut, "num", "left")
    rows = table.select("key", "id", "n_words", "sha", "cls").join(known.withColumnRenamed("cls", "of"), F.col("cls") == F.col("of"), "left")
    copy = rank > F.col("rank")  # null for texts shorter than a window
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return rows.select(
        "key", F.col("id").alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("lost", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.col("gone")).alias("gone"),
    )


@F.arrow_udf(StringType())
def _left_words(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, ranges in zip(texts.to_pylist(), gone.to_pylist()):
        words, left, at = words_of(text, False), [], 0
        for r in ranges or ():
            left += words[at:r["start"]]
            at = r["end"]
        out.append(b" ".join(left + words[at:]).decode())
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``docs`` whose texts are the kept words joined by one space."""
    spans = repeated_spans(docs, id_col, text_col, length).select("key", "gone").dropDuplicates(["key"])
    source = docs.select(packed(docs).alias("row"), row_key(docs[id_col], docs[text_col]).alias("key"))
    met = source.join(spans.hint("shuffle_hash"), "key")
    return unpacked(met, docs.columns, {text_col: _left_words(F.col("row").getField(text_col), "gone")})
