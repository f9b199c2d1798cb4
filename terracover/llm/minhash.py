"""Near-duplicate detection: fast similarity sketches, banding, exact verification.

Documents with equal shingle sets form one class (a 128-bit digest of the set), so copies
cost one row. Classes are sketched (``sketch.sketches``) and banded; a class is compared
with all classes that share a band with it. The band's width follows from the threshold:
the widest that misses a pair at the threshold with probability below ``miss``.

Comparisons never become rows. Classes get a *home*, the least class they meet over their
bands, and homes are cut into chunks of bounded total set size by hash. In a first round each
chunk meets by itself, with its home among its members, in one task, which intersects the full
sets with matrix products and returns at most one edge per class: a spanning forest of the
links it found. Classes so connected are settled among themselves: in a second round only
chunks meet that share a band and belong to different groups. A large group of near copies so
costs about one bounded meeting per chunk instead of one per pair of chunks, what is left is
compared exhaustively, and no link is lost by a cap.

Shape of the job: one pass makes signatures; band rows hold a hash and a class; full sets
are made again, for the first round, for classes that share a band, and for the second for
those whose bands are not settled; they move once per meeting.

Defined results: null and blank texts have no shingles and are linked with nothing. A text
of fewer words than the shingle width is one shingle. Rows with equal values are one
class; null ids rank after all others. Similarity is compared in integers. An empty table
gives an empty table. Very long texts are sketched and compared whole, one at a time. Only the
two named columns are read; :func:`keep_one` keeps all columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.llm.components import connected_components
from terracover.llm.sketch import WordHashes, band_hashes, shingle_set, sketches
from terracover.llm.text import packed, row_key, rows_in_chunks, unpacked, words_of
from terracover.operators.joins import large_join
from terracover.sources.staging import stage

CHUNK, MEMBERS = 1 << 18, 512  # shingles (about 2 MB) and classes of a chunk
LARGE = 64  # classes from which a connected group has chunks of its own
BATCH = 4 << 20  # bytes of text handled at a time


def band_width(threshold: float, coordinates: int, miss: float) -> int:
    """Widest band for which a pair at the threshold shares no band with probability below ``miss``."""
    fit = [r for r in range(1, coordinates + 1) if (1 - threshold ** r) ** (coordinates // r) <= miss]
    return max(fit, default=1)


def _signatures(width: int, coordinates: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in rows_in_chunks(batches, "text", BATCH):
            sets = [shingle_set(cache.of(words_of(t, True)), width) for t in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            bands = iter(band_hashes(sketches(full, coordinates), rows).view(np.int64))
            prints = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("key").cast(pa.binary()), batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(prints, pa.binary()), pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], names=["key", "id", "n", "cls", "bands"])

    return run


def _sets_for(width: int):
    """Rows (meeting, cls, shingles): the full set of a class for each chunk pair it takes part in."""
    schema = pa.schema([("meeting", pa.binary()), ("cls", pa.binary()), ("side", pa.int32()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, done = WordHashes(), set()
        for batch in rows_in_chunks(batches, "text", BATCH):
            for row in batch.select(["text", "cls", "meetings"]).to_pylist():
                if row["cls"] in done:  # a repeated row
                    continue
                done.add(row["cls"])
                held = shingle_set(cache.of(words_of(row["text"], True)), width).tobytes()
                for i in range(0, len(row["meetings"]), 32):
                    some = row["meetings"][i:i + 32]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([m["meeting"] for m in some], pa.binary()), pa.array([row["cls"]] * len(some), pa.binary()),
                        pa.array([m["side"] for m in some], pa.int32()), pa.array([held] * len(some), pa.binary()),
                    ], schema=schema)

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of slices of the incidence matrix."""
    out = np.zeros((len(sets), len(sets)), np.float64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    use = counts[place] > 1
    owner, column = owner[use], shared[place[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(256, (1 << 22) // max(1, len(sets)))
    for start in range(0, int((counts > 1).sum()), step):
        low, high = np.searchsorted(column, [start, start + step])
        part = np.zeros((len(sets), step), np.float32)
        part[owner[low:high], column[low:high] - start] = 1
        out += part @ part.T
    return out


def _links(percent: int):
    """Spanning forest of the links among the classes of one chunk pair."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        seen: dict[bytes, tuple[np.ndarray, int]] = {}
        for cls, held, side in zip(*(rows.column(c).to_pylist() for c in ("cls", "shingles", "side"))):
            seen.setdefault(cls, (np.frombuffer(held, np.uint64), side))
        names = sorted(seen)
        sets = [seen[c][0] for c in names]
        if len(names) < 2:
            return pa.Table.from_arrays([pa.array([], pa.binary())] * 2, schema=schema)
        size = np.array([len(s) for s in sets], np.float64)
        common = overlaps(sets)
        linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
        label, before = np.arange(len(names)), None
        while before is None or (label != before).any():
            before = label
            label = np.where(linked, label[None, :], len(names)).min(axis=1)
            label = np.minimum(label, before)
            label = label[label]
        edges = [(names[i], names[j]) for i, j in enumerate(label) if i != j]
        return pa.Table.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], schema=schema)

    return run


def _shared_bands(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(band, cls) of the bands that several classes share, and (cls, home, n): the least class each can reach over them."""
    rows = classes.select("cls", "n", F.explode("bands").alias("band"))
    # Counted sides are staged: joins on a hot band or home then have plain inputs, which the
    # adaptive rules broadcast if small and split otherwise.
    shared = stage(rows.groupBy("band").agg(F.count("*").alias("members"), F.min("cls").alias("home")).where("members > 1"), "near-shared")
    held = stage(large_join(rows, shared.select("band", "home"), "band").select("band", "cls", "n", "home"), "near-bands")
    # A class takes the least home over its bands, once more over the homes of those it meets there.
    for turn in range(2):
        own = held.groupBy("cls").agg(F.min("home").alias("own"))
        met = held.drop("home").join(own, "cls")
        best = stage(met.groupBy("band").agg(F.min("own").alias("home")), "near-best")
        held = stage(met.drop("own").join(best, "band"), f"near-homes-{turn}")
    own = stage(held.groupBy("cls").agg(F.min("home").alias("home"), F.first("n").alias("n")), "near-own")
    return held.select("band", "cls"), own


def _chunks(own: DataFrame, group: str) -> DataFrame:
    """(cls, group, chunk): each group cut by hash into chunks of bounded size."""
    parts = stage(own.groupBy(group).agg(F.ceil(F.greatest(F.sum("n") / CHUNK, F.count("*") / MEMBERS)).alias("parts")), "near-parts")
    chunk = F.unhex(F.md5(F.concat(group, F.pmod(F.xxhash64("cls"), F.col("parts")).cast("string").cast("binary"))))
    return stage(own.join(parts, group).select("cls", group, chunk.alias("chunk")), "near-chunks")


def _asked(sides: DataFrame, chunks: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, rep, meetings) from (meeting, chunk, side)."""
    by_chunk = stage(sides.groupBy("chunk").agg(F.collect_list(F.struct("meeting", "side")).alias("meetings")), "near-sides")
    return chunks.select("cls", "chunk").join(by_chunk, "chunk").join(classes.select("cls", "rep"), "cls").select("cls", "rep", "meetings")


def _at_home(own: DataFrame, classes: DataFrame) -> DataFrame:
    """Meetings of the first round: every chunk of a home by itself, with the home among its members."""
    chunks = _chunks(own, "home")
    members = chunks.select("cls", "chunk").union(chunks.select(F.col("home").alias("cls"), "chunk")).distinct()
    asked = members.groupBy("cls").agg(F.collect_list(F.struct(F.col("chunk").alias("meeting"), F.lit(0).alias("side"))).alias("meetings"))
    return asked.join(classes.select("cls", "rep"), "cls").select("cls", "rep", "meetings")


def _across(bands: DataFrame, own: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Meetings of the second round: chunks of classes that share a band and are not connected yet.

    Connected classes need no comparison, whatever their similarity, so a band whose members
    are all connected is settled. Of the others, members of a large group are cut into chunks
    of their own, which do not meet each other; the rest is cut by home and meets all.
    """
    known = stage(own.join(labels, F.col("cls") == F.col("node"), "left").select(
        "cls", "n", "home", F.coalesce("label", "cls").alias("label")
    ), "near-labels")
    labelled = bands.join(known.select("cls", "label"), "cls")
    unsettled = stage(labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band"), "near-open")
    left = stage(large_join(labelled, unsettled, "band").select("band", "cls"), "near-left")
    members = known.join(left.select("cls").distinct(), "cls")
    large = stage(members.groupBy("label").agg(F.count("*").alias("many")).where(F.col("many") >= LARGE).select(F.col("label").alias("own_label")), "near-large")
    tagged = lambda mark, column: F.unhex(F.md5(F.concat(F.lit(mark).cast("binary"), column)))
    grouped = members.join(large, F.col("label") == F.col("own_label"), "left").withColumn(
        "group", F.when(F.col("own_label").isNotNull(), tagged("label", F.col("own_label"))).otherwise(tagged("home", F.col("home")))
    )
    grouped = stage(grouped.select("cls", "n", "own_label", "group"), "near-grouped")
    chunks = _chunks(grouped.select("cls", "n", "group"), "group")
    there = left.join(chunks.join(grouped.select("cls", "own_label"), "cls"), "cls").select("band", "chunk", "own_label").distinct()
    other = there.select(F.col("band").alias("at"), F.col("chunk").alias("mate"), F.col("own_label").alias("theirs"))
    apart = ~F.coalesce(F.col("own_label") == F.col("theirs"), F.lit(False))
    pairs = there.join(other, (F.col("band") == F.col("at")) & (F.col("chunk") <= F.col("mate")) & apart).select("chunk", "mate").distinct()
    # A chunk that meets others is compared with itself there, too.
    busy = pairs.where("chunk <> mate")
    alone = pairs.where("chunk = mate").join(busy.select("chunk").union(busy.select("mate")).distinct(), "chunk", "left_anti")
    pairs = stage(
        alone.unionByName(busy).select(F.unhex(F.md5(F.concat("chunk", "mate"))).alias("meeting"), "chunk", "mate"), "near-meetings"
    )
    sides = pairs.select("meeting", "chunk", F.lit(0).alias("side")).union(
        pairs.where("chunk <> mate").select("meeting", "mate", F.lit(1))
    )
    return _asked(sides, chunks, classes)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
    coordinates: int = 128, miss: float = 1e-6,
) -> DataFrame:
    """One row per input row: ``key``, id, ``n_shingles``, ``component_id`` (the least id of its
    group) and ``group`` (a digest that names the group; null without shingles).

    Two sets are linked if 100 * intersection >= ``percent`` * union.
    """
    rows = band_width(percent / 100, coordinates, miss)
    source = docs.select(row_key(docs[id_col], docs[text_col]).alias("key"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    signed = stage(source.mapInArrow(
        _signatures(width, coordinates, rows), f"key binary, id {id_type}, n bigint, cls binary, bands array<bigint>"
    ), "near-signatures")
    ranked = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("key"))
    named = signed.drop("bands")
    least = named.where("cls IS NOT NULL").groupBy("cls").agg(F.min(ranked).alias("rank"))
    shapes = signed.where("cls IS NOT NULL").groupBy("cls").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stage(least.join(shapes, "cls").select(
        "cls", "n", "bands", F.col("rank.key").alias("rep"), F.struct("rank.no_id", "rank.id").alias("rank")
    ), "near-classes")
    named_classes = classes.select("cls", "rep")

    def linked(meetings: DataFrame, name: str) -> DataFrame:
        needed = source.select("key", "text").join(
            meetings.hint("shuffle_hash"), F.col("key") == F.col("rep")
        ).select("text", "cls", "meetings")
        return stage(
            needed.mapInArrow(_sets_for(width), "meeting binary, cls binary, side int, shingles binary")
            .groupBy("meeting").applyInArrow(_links(percent), "a binary, b binary"), name,
        )

    bands, own = _shared_bands(classes.select("cls", "n", "bands"))
    first = linked(_at_home(own, named_classes), "near-links-1")
    some = connected_components(first, "near-groups")
    second = linked(_across(bands, own, some, named_classes), "near-links-2")
    labels = connected_components(first.unionByName(second), "near-components")
    labelled = classes.join(labels, F.col("cls") == F.col("node"), "left").select(
        "cls", "rank", F.coalesce("label", "cls").alias("label")
    )
    best = labelled.groupBy("label").agg(F.min("rank").alias("best"))
    found = labelled.join(best, "label").select(F.col("cls").alias("of"), F.col("best.id").alias("component"), "label")
    return named.join(found, F.col("cls") == F.col("of"), "left").select(
        "key", F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.col("label").alias("group"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents, one of each near-duplicate group: that with the least id.

    Of several rows that share this id, the one with the least key stays, once. Documents
    without words are linked with nothing and all stay.
    """
    groups = near_duplicates(docs, id_col, text_col, **how)
    alone = groups.where("group IS NULL").select("key", F.lit(False).alias("once")).distinct()
    rank = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("key"))
    first = groups.where("group IS NOT NULL").groupBy("group").agg(F.min(rank).alias("rank"))
    first = first.select(F.col("rank.key").alias("key"), F.lit(True).alias("once"))
    source = docs.select(packed(docs).alias("row"), row_key(docs[id_col], docs[text_col]).alias("key"))
    met = source.join(alone.unionByName(first).hint("shuffle_hash"), "key")
    # Only rows that occur more than once go through another grouping.
    again = stage(groups.groupBy("key").count().where("count > 1").select("key"), "near-again")
    single = met.join(again, "key", "left_anti").select("row")
    several = met.join(again, "key", "left_semi")
    one = several.where("once").dropDuplicates(["key"]).select("row")
    return unpacked(single.unionByName(several.where("NOT once").select("row")).unionByName(one), docs.columns, {})
