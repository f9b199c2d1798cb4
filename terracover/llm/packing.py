"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

Documents become token ids plus one end id and are cut only where they exceed the capacity.
Pieces are dealt round robin to partitions of ``PART`` rows; each partition runs best-fit
decreasing and computes a lower bound on its bins from dual feasible functions (rounding
functions under which no set of pieces that fits a bin sums to more than a bin). A
partition whose bin count equals its bound is certified. Partitions with gaps release the
pieces of their bins that have room, certified ones those of their emptiest bins; released
pieces are dealt anew among fewer partitions and packed again. A round is kept only if it
saves bins, and rounds end when the total meets the bound of all pieces together, when
nothing is saved, or after ``rounds``.

Shape of the job: one Python pass makes the pieces; the table of pieces (numbers, no text)
is staged, as is every round. The driver sees counts and a histogram of piece lengths,
which has at most ``capacity`` rows. Tokenising splits batches of texts into distinct words
by array kernels, looks these up in a cache per task and sends only new ones through the
tokenizer, which treats blank-separated words apart.

Defined results: a null or empty text is the end id alone. Repeated rows are packed one by
one. Null ids are carried along. Very long texts are cut into pieces like any other, whole.
Only the two named columns are read, clashing names have no effect. An empty table gives an
empty table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.llm.alignment import byte_letters
from terracover.llm.text import rows_in_chunks
from terracover.sources.staging import stage

PART = 1 << 16
CACHE = 400_000
BATCH = 8 << 20
#: What chunks must not change: cases, marks, digits, blanks of all kinds, letters beyond ASCII.
PROBE = "Hello, World's  don't 1234 a1b2?! x.y;\n\n\tTab\r\nÜber naïve 漢字 e\u0301 (re) it's...  #tag 3.14 <|a ß\x0bz\u00a0q -- ok"
#: Latin letters that are composed already and whose lower case is one letter.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
_SEPARATOR, _MARK, _TAIL = "<|endoftext|>", b"<|", b".,;:!?#$%&*"


class ChunkIds(dict):
    """Little-endian uint32 ids of blank-free chunks of text, made by a public tokenizer.

    Made for tokenizers whose normaliser and splitter treat what blanks separate apart and
    that know ``<|endoftext|>``: new chunks are encoded together with that token between
    them. Chunks of ASCII without capitals pass the normaliser unchanged and skip it; words of
    these letters, and runs of common marks, go to the tokenizer's model directly. A probe is
    encoded both ways at the start; where the ids differ, texts go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.coder = Tokenizer.from_file(path)
        self.normal, self.none = self.coder.normalizer, normalizers.Sequence([])
        self.model = self.coder.model
        self.code = [i.to_bytes(4, "little") for i in range(self.coder.get_vocab_size())]
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.gap = self.coder.token_to_id(_SEPARATOR)
        self.whole = self.gap is None
        if not self.whole:
            plain = np.array(self.coder.encode(PROBE, add_special_tokens=False).ids, "<u4").tobytes()
            try:
                self.whole = self.encode(pa.array([PROBE]))[0].tobytes() != plain
            except (KeyError, ValueError):  # other ids between the separators
                self.whole = True
            self.coder.normalizer = self.normal
            self.clear()

    def _together(self, chunks: list[bytes], normalizer) -> None:
        self.coder.normalizer = normalizer
        for i in range(0, len(chunks), 4096):
            some = chunks[i:i + 4096]
            coded = self.coder.encode(f" {_SEPARATOR} ".encode().join(some).decode(), add_special_tokens=False).ids
            ids = np.array(coded, "<u4")
            ends = np.append(np.flatnonzero(ids == self.gap), len(ids)) * 4
            raw, start = ids.tobytes(), 0
            for chunk, end in zip(some, ends.tolist(), strict=True):
                self[chunk] = raw[start:end]
                start = end + 4

    def _word(self, letters: str) -> bytes:
        """Ids of a word of byte-level letters, which is one token to the splitter."""
        return b"".join([self.code[t.id] for t in self.model.tokenize(letters)])

    def learn(self, chunks: set[bytes]) -> None:
        """Encode what is new. Letters with marks behind them are two tokens to the splitter: each part is looked up."""
        if len(self) + len(chunks) > CACHE:
            self.clear()
        parts, new = [], set()
        for c in chunks - self.keys():
            core = c.rstrip(_TAIL)
            if len(core) < len(c) and (core.isalpha() or core.decode().isalpha()):
                parts.append((c, core, c[len(core):]))
                new.add(core)
                new.add(c[len(core):])
            else:
                new.add(c)
        plain, other = [], []
        for c in new - self.keys():
            if c.isalpha() and c.islower() or not c.strip(_TAIL):
                # One token to the splitter, nothing to normalise, bytes that stand for themselves.
                self[c] = self._word(c.decode())
            elif c.isascii() and _MARK not in c:
                (plain if c == c.lower() else other).append(c)
            elif _LATIN.fullmatch(text := c.decode()):
                self[c] = self._word(text.lower().encode().decode("latin-1").translate(self.letters))
            elif _MARK in c:  # may hold special tokens of its own
                self.coder.normalizer = self.normal
                self[c] = np.array(self.coder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                other.append(c)
        self._together(plain, self.none)
        self._together(other, self.normal)
        for c, core, tail in parts:
            self[c] = self[core] + self[tail]

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk; what is not known yet is learnt."""
        found = list(map(self.get, chunks))
        if None in found:
            self.learn({c for c, ids in zip(chunks, found) if ids is None})
            found = [ids if ids is not None else self[c] for c, ids in zip(chunks, found)]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and where each text begins; a last entry ends them."""
        texts = texts.fill_null("")
        if self.whole:
            coded = [x.ids for x in self.coder.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in coded for i in ids], "<u4"), np.cumsum([0, *map(len, coded)])
        # A-Z may be folded early unless a special token could be spelled.
        marked = pc.match_substring(texts, _MARK.decode())
        split = pc.ascii_split_whitespace(pc.if_else(marked, texts, pc.ascii_lower(texts)))
        words = split.flatten().dictionary_encode()
        ids = self.ids_of(words.dictionary.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        index = words.indices.to_numpy()
        lengths = sizes[index]
        ends = np.append(0, np.cumsum(lengths))
        offsets = split.offsets.to_numpy()
        return flat[np.repeat(starts[index] - ends[:-1], lengths) + np.arange(ends[-1])], ends[offsets - offsets[0]]


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = ChunkIds(path), np.array([end_id], "<u4").tobytes()
        for batch in rows_in_chunks(batches, "text", BATCH):
            rows: list[int] = []
            out: list[tuple] = []
            flat, begins = coder.encode(batch.column("text"))
            for i, (begin, stop) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
                ids = flat[begin:stop].tobytes() + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    held = ids[at:at + 4 * capacity]
                    rows.append(i)
                    out.append((n, at // 4, len(held) // 4, crc32(held), held if with_ids else None))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(rows, pa.int32())), pa.array(columns[0], pa.int32()),
                *[pa.array(c, pa.int64()) for c in columns[1:4]],
                *([pa.array(columns[4], pa.binary())] if with_ids else []),
            ], names=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return run


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document; ``ids`` (packed uint32) on request."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return source.mapInArrow(_pieces(tokenizer_path, capacity, end_id, with_ids), schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Least number of bins for ``counts[x]`` pieces of size ``x``, by two families of dual feasible functions."""
    x = np.arange(capacity + 1)
    if not counts.sum():
        return 0
    best = 0
    for t in range(capacity // 2 + 1):
        value = np.where(x > capacity - t, capacity, np.where(x < t, 0, x))
        best = max(best, -(-int((counts * value).sum()) // capacity))
    for k in range(1, 33):
        # In units of capacity * k: pieces at exact multiples of capacity / (k + 1) keep their size.
        value = np.where((k + 1) * x % capacity == 0, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every piece by best-fit decreasing, and the number of bins."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, made = 0, 0  # bit r: some bin has r tokens of room
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                open_rooms &= ~(1 << room)
        else:
            room, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - room
        if room > n:
            free[room - n].append(b)
            open_rooms |= 1 << (room - n)
    return bins, offsets, made


def _pack_partition(capacity: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lengths = table.column("length").to_numpy()
        bins, offsets, made = best_fit(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=made)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        loose = fill < (capacity if made > bound else capacity * 3 // 4)
        base = (turn << 56) | (TaskContext.get().partitionId() << 24)
        for name, values in (("sequence_id", base + bins), ("offset", offsets), ("loose", loose[bins])):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches()

    return run


def _round(pieces: DataFrame, rows: int, capacity: int, turn: int) -> tuple[DataFrame, int, int]:
    """Packed pieces of one round, its bins, and the number of pieces it could release."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = pieces.repartition(max(1, -(-rows // PART)))
    packed = stage(dealt.mapInArrow(
        _pack_partition(capacity, turn), f"{fields}, sequence_id bigint, offset bigint, loose boolean"
    ), f"packed-{turn}")
    made = packed.where("offset = 0").agg(F.count("*")).first()[0]
    return packed, made, packed.where("loose").count()


def pack(pieces: DataFrame, capacity: int = 2048, rounds: int = 4) -> DataFrame:
    """``pieces`` (any columns and ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    pieces = stage(pieces, "pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        histogram[length] = n
    bound = lower_bound(histogram, capacity)
    packed, total, loose = _round(pieces, int(histogram.sum()), capacity, 0)
    for turn in range(1, rounds):
        if total <= bound or not loose:
            break
        left = packed.where("loose").drop("sequence_id", "offset", "loose")
        before = packed.where("loose AND offset = 0").count()
        again, made, still = _round(left, loose, capacity, turn)
        if made >= before:
            break
        packed, total, loose = packed.where("NOT loose").unionByName(again), total - before + made, still
    return packed.drop("loose")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = 2048, end_id: int = 0, rounds: int = 4, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset; see :func:`sequences` for the ids."""
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids)
    return pack(pieces, capacity, rounds).withColumnRenamed("id", id_col)


def packing_quality(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: sequences used, the lower bound of all pieces together, tokens, and whether the bound is met."""
    spark = packed.sparkSession
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in packed.groupBy("length").count().collect():  # at most ``capacity`` rows
        histogram[length] = n
    used = packed.where("offset = 0").count()
    bound, tokens = lower_bound(histogram, capacity), int((histogram * np.arange(capacity + 1)).sum())
    return spark.createDataFrame([(used, bound, tokens, used == bound)], "sequences bigint, bound bigint, tokens bigint, certified boolean")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the training sequences of pieces that carry ``ids``."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(placed.alias("parts"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("parts", F.unhex(F.lit("")), lambda s, p: F.concat(s, p["ids"]))
    return grouped.select("sequence_id", "n_tokens", joined.alias("ids"))
