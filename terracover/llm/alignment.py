"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, corpus-wide.

A text is encoded by a byte-level BPE (A, space and text) and by a piece model with byte
fallback (B, which adds the space itself). Byte offsets at which tokens of both end cut the
tokens into groups; tokens whose byte ranges overlap are linked. Two ways to cut one range
overlap once per distinct end, so the links of a text are the stretches between ends of
either tokenizer, found for whole batches of texts by sorted offsets.

Identity-map fast path: an array gives for every A id the B id of the same bytes. A group of
one A and one B token that this array predicts is a link of a known pair: it is counted in a
vector as long as A's vocabulary, one per task. Only the other, irregular groups yield pairs,
which are counted per batch and then shuffled. A pair may occur both ways; both are summed.

Shape of the job: one Python pass tokenises and stages one row per batch of texts (numbers of
its documents, its regular ids, its distinct irregular pairs). Pair counts are summed with
map-side combine and ranked within a B id, of which there are as many pairs as A has ids at
most. The counts of regular pairs, one per A id, go to the second pass as an array of bounded
size; counts of irregular pairs meet their batches by a join. Texts are not shuffled and not
tokenised again.

Defined results: texts that are null, empty, or whose joined tokens differ from space and text
(U+2581 in a text, say) have no tokens: zeros and an empty digest. Special-token strings in a
text are plain text. Repeated rows count as often as they occur. Very long texts are a batch
of their own. Only the two named columns are read, clashing names have no effect. An empty
table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracover.llm.text import rows_in_chunks
from terracover.sources.staging import stage

BATCH = 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, and its byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


#: Fixed value: how byte-level tokenizers split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes all Unicode tables agree on, in runs short enough for merges in quadratic time.
_RARE = re.compile(r"[^\x00-\x7f\u00a0-\u024f\u2010-\u2027\u20ac\u2122\u4e00-\u9fa5]|\S{1000}|\s{1000}")


class ByteLevel:
    """Encoder A, from a tokenizers file with a byte-level vocabulary.

    If merges are ranked as their ids are, common texts go through ranks of the same
    vocabulary, which gives the same ids in a quarter of the time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.coder.get_vocab()
        self.bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.ranks = self._ranks(path, letters)

    def _ranks(self, path: str, letters: dict[str, int]):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, splitter = made["model"], made["pre_tokenizer"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if made["normalizer"] or model["type"] != "BPE" or {k: splitter.get(k) for k in plain} != plain:
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"].get(x + y, -1) for x, y in pairs]
        if order != sorted(set(order)) or order[:1] == [-1] or len(order) + 256 != sum(all(c in letters for c in t) for t in model["vocab"]):
            return None
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        slow = [i for i, t in enumerate(texts) if self.ranks is None or _RARE.search(t)]
        out: list[list[int]] = [[]] * len(texts)
        for i, x in zip(slow, self.coder.encode_batch_fast([" " + texts[i] for i in slow], add_special_tokens=False)):
            out[i] = x.ids
        for i in sorted(set(range(len(texts))) - set(slow)):
            out[i] = self.ranks.encode_ordinary(" " + texts[i])
        return out


class Pieces:
    """Encoder B, from a sentencepiece model that adds a leading space."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        self.fallback = []
        for i in range(self.coder.get_piece_size()):
            piece = self.coder.id_to_piece(i)
            self.fallback.append(self.coder.is_byte(i))
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.fallback[-1] else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


def identity_map(a: list[bytes], b: list[bytes], fallback: list[bool]) -> np.ndarray:
    """For every A id the B id of the same bytes, -1 if there is none; whole pieces go before byte fallback."""
    of: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: (fallback[i], i)):
        of.setdefault(b[i], i)
    return np.array([of.get(x, -1) if x else -1 for x in a], np.int32)


class Aligner:
    """Groups and links of batches of texts; bounded tables of both vocabularies."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.same = identity_map(self.a.bytes, self.b.bytes, self.b.fallback)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        most = max(len(self.a.bytes), len(self.b.bytes))
        # Text of an id with what follows it: another of the group, the other side, the next group, nothing.
        self.marked = [f"{i}{mark}" for i in range(most) for mark in (",", "|", ";", "")]

    def tokens(self, texts: list[str | None]) -> tuple[list[int], list[list[int]], list[list[int]]]:
        """Places of the texts with tokens, and the ids of both encoders."""
        asked = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in asked]
        places, first, second = [], [], []
        for i, t, x, y in zip(asked, given, self.a.encode(given), self.b.encode(given)):
            raw = b" " + t.encode()
            if b"".join(map(self.a.bytes.__getitem__, x)) == raw and b"".join(map(self.b.bytes.__getitem__, y)) == raw:
                places.append(i)
                first.append(x)
                second.append(y)
        return places, first, second

    def align(self, texts: list[str | None]) -> dict:
        """Per text n_a, n_b, n_groups, n_links and the groups; regular ids and irregular pairs by text."""
        places, first, second = self.tokens(texts)
        n = len(texts)
        out = {"counts": np.zeros((4, n), np.int64), "groups": [""] * n}
        ids = [np.fromiter(chain.from_iterable(side), np.int64, sum(map(len, side))) for side in (first, second)]
        if not places:
            return out | {"regular": (np.zeros(0, np.int64),) * 2, "irregular": (np.zeros(0, np.int64),) * 3}
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids)]
        # Stretches between ends of either side are the links; groups end where both do.
        marks = np.zeros((2, ends[0][-1] + 1), bool)
        for mark, e in zip(marks, ends):
            mark[e] = True
        either, common = np.flatnonzero(marks[0] | marks[1]), np.flatnonzero(marks[0] & marks[1])
        # The token that holds a byte follows all ends before it.
        before = [np.cumsum(mark, dtype=np.int32) - mark for mark in marks]
        link = [x[either] for x in before]
        a, b = ids[0][link[0]], ids[1][link[1]]
        group = (np.cumsum(marks[0] & marks[1], dtype=np.int32) - (marks[0] & marks[1]))[either]
        last = [x[common] for x in before]
        held = [np.diff(x, prepend=-1) for x in last]
        text_ends = np.cumsum([len(t) for t in first]) - 1
        text_of_group = np.searchsorted(ends[0][text_ends], common)
        text = text_of_group[group]
        alone = (held[0] == 1) & (held[1] == 1)
        regular = alone[group] & (self.same[a] == b)
        where = np.array(places)
        out["counts"][0][where] = [len(x) for x in first]
        out["counts"][1][where] = [len(x) for x in second]
        out["counts"][2][where] = np.bincount(text_of_group, minlength=len(places))
        out["counts"][3][where] = np.bincount(text, minlength=len(places))
        for place, groups in zip(places, self._written(ids, last, held, text_of_group, len(places))):
            out["groups"][place] = groups
        return out | {
            "regular": (where[text[regular]], a[regular]),
            "irregular": (where[text[~regular]], a[~regular], b[~regular]),
        }

    def _written(self, ids, last, held, text_of_group, n: int) -> Iterator[str]:
        """Groups of each text as decimal ids: A ids, a bar, B ids, groups apart by semicolons."""
        total = len(ids[0]) + len(ids[1])
        starts = np.cumsum(held[0] + held[1]) - held[0] - held[1]
        code = np.empty(total, np.int64)
        for side in (0, 1):
            group = np.repeat(np.arange(len(held[side])), held[side])
            first = last[side] - held[side] + 1
            at = starts[group] + np.arange(len(group)) - first[group] + (held[0][group] if side else 0)
            mark = np.zeros(len(group), np.int64)
            mark[last[side]] = 1 + side
            if side:
                final = np.append(text_of_group[1:] != text_of_group[:-1], True)
                mark[last[side][final]] = 3
            code[at] = 4 * ids[side] + mark
        sizes = np.bincount(text_of_group, weights=held[0] + held[1], minlength=n).astype(np.int64)
        words, at = code.tolist(), 0
        for size in sizes.tolist():
            yield "".join(map(self.marked.__getitem__, words[at:at + size]))
            at += size


def _counted(owner: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, value) in order, with how often they occur."""
    keys, n = np.unique(owner * width + value, return_counts=True)
    return keys // width, keys % width, n


_LISTS = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string"}
_TABLES = ["reg_doc", "reg_id", "reg_n", "irr_doc", "irr_pair", "irr_n"]


def _first_pass(a_path: str, b_path: str, with_groups: bool):
    arrow = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, part, seq = Aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        vector = np.zeros(len(aligner.same), np.int64)

        def row(ids: pa.Array, values: dict) -> pa.RecordBatch:
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int64())]
            names = ["part", "seq", "ids", *_LISTS, "groups", *_TABLES, "pair_a", "pair_b", "pair_n"]
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
            for name in names[3:]:
                value = values.get(name)
                if name in _TABLES:
                    columns.append(pa.array([None if value is None else np.asarray(value, "<i4").tobytes()], pa.binary()))
                elif name in ("groups", "groups_sha256"):
                    columns.append(pa.array([value], pa.list_(pa.string())))
                else:
                    kind = pa.int32() if name in ("pair_a", "pair_b") else pa.int64()
                    flat = pa.array(np.asarray([] if value is None else value), kind)
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
            return pa.RecordBatch.from_arrays(columns, names=names)

        kind = None
        for batch in rows_in_chunks(batches, "text", BATCH):
            kind = batch.column("id").type
            found = aligner.align(batch.column("text").to_pylist())
            doc, a = found["regular"]
            vector += np.bincount(a, minlength=len(vector))
            regular = _counted(doc, a, 1 << 32)
            doc, a, b = found["irregular"]
            pairs, index = np.unique(a << 32 | b, return_inverse=True)
            irregular = _counted(doc, index, 1 << 32)
            digests = [sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
            yield row(batch.column("id"), {
                **dict(zip(_LISTS, found["counts"])), "groups_sha256": digests, "groups": found["groups"] if with_groups else None,
                **dict(zip(_TABLES, (*regular, *irregular))),
                "pair_a": pairs >> 32, "pair_b": pairs & 0xFFFFFFFF, "pair_n": np.bincount(index, minlength=len(pairs)),
            })
            seq += 1
        if vector.any():
            seen = np.flatnonzero(vector)
            seq = -1  # the vector of the task: no documents
            yield row(pa.array([], kind), {"pair_a": seen, "pair_b": aligner.same[seen], "pair_n": vector[seen]})

    return run


def _batches(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, with_groups: bool) -> DataFrame:
    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    fields = [
        "part int", "seq bigint", f"ids array<{kind}>", *[f"{n} array<{t}>" for n, t in _LISTS.items()], "groups array<string>",
        *[f"{n} binary" for n in _TABLES], "pair_a array<int>", "pair_b array<int>", "pair_n array<bigint>",
    ]
    return stage(source.mapInArrow(_first_pass(a_path, b_path, with_groups), ", ".join(fields)), "aligned")


def _pairs(batches: DataFrame) -> DataFrame:
    return batches.select("part", "seq", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("i", "x")).select(
        "part", "seq", "i", F.col("x.pair_a").alias("a"), F.col("x.pair_b").alias("b"), F.col("x.pair_n").alias("n")
    )


def _totals(batches: DataFrame) -> DataFrame:
    """(a, b, n, best): links of every id pair, and whether its B id has no pair with more."""
    summed = _pairs(batches).groupBy("a", "b").agg(F.sum("n").alias("n"))
    # A B id meets as many A ids as A's vocabulary has, at most.
    return summed.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a_id, b_id, n_links, best): the alignment of the two vocabularies."""
    totals = _totals(_batches(docs, a_path, b_path, id_col, text_col, False))
    return totals.select(F.col("a").alias("a_id"), F.col("b").alias("b_id"), F.col("n").alias("n_links"), "best")


def _second_pass(counts: bytes, best: bytes, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_of, best_of = np.frombuffer(counts, "<i8"), np.frombuffer(best, np.int8)
        for batch in batches:
            for k in range(batch.num_rows):
                of = {name: batch.column(name)[k] for name in batch.schema.names}
                size = len(of["ids"])
                reg_doc, reg_id, reg_n, irr_doc, irr_pair, irr_n = [np.frombuffer(of[t].as_py() or b"", "<i4") for t in _TABLES]
                pair_n, pair_best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if of["known"].is_valid:
                    known = of["known"].values
                    place = known.field("i").to_numpy()
                    pair_n, pair_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                    pair_n[place] = known.field("n").to_numpy()
                    pair_best[place] = known.field("best").cast(pa.int64()).to_numpy()
                sums = []
                for regular, irregular in ((best_of, pair_best), (n_of, pair_n)):
                    total = np.zeros(size, np.int64)
                    np.add.at(total, reg_doc, regular[reg_id].astype(np.int64) * reg_n)
                    np.add.at(total, irr_doc, irregular[irr_pair] * irr_n)
                    sums.append(pa.array(total))
                lists = [of[n].values for n in ["ids", *_LISTS]]
                groups = [of["groups"].values if of["groups"].is_valid else pa.nulls(size, pa.string())] if "groups" in names else []
                yield pa.RecordBatch.from_arrays([*lists, *sums, *groups], names=names)

    return run


def align_documents(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False,
) -> DataFrame:
    """One row per document: token, group and link counts, ``n_best``, ``count_sum`` and the digest of its groups.

    ``with_groups`` adds the groups themselves. Both paths must exist on all executors.
    """
    batches = _batches(docs, a_path, b_path, id_col, text_col, with_groups)
    kind = docs.select(docs[id_col]).schema[0].dataType.simpleString()
    totals = stage(_totals(batches), "pair-totals")
    pairs = _pairs(batches)
    # One pair per A id, so at most a vocabulary of rows comes here.
    regular = pairs.where("seq < 0").select("a", "b").distinct().join(totals, ["a", "b"]).select("a", "n", "best").toArrow()
    size = max(regular.column("a").to_pylist(), default=-1) + 1
    counts, best = np.zeros(size, "<i8"), np.zeros(size, np.int8)
    counts[regular.column("a").to_numpy()] = regular.column("n").to_numpy()
    best[regular.column("a").to_numpy()] = regular.column("best").to_numpy()
    known = (
        pairs.where("seq >= 0").select("part", "seq", "i", "a", "b").join(totals, ["a", "b"])
        .groupBy("part", "seq").agg(F.collect_list(F.struct("i", "n", "best")).alias("known"))
    )
    met = batches.where("seq >= 0").drop("pair_a", "pair_b", "pair_n").join(known, ["part", "seq"], "left")
    names = ["id", *_LISTS, "n_best", "count_sum"] + ["groups"] * with_groups
    types = {"id": kind, **_LISTS, "groups": "string"}
    schema = ", ".join(f"{n} {types.get(n, 'bigint')}" for n in names)
    return met.mapInArrow(_second_pass(counts.tobytes(), best.tobytes(), names), schema).withColumnRenamed("id", id_col)
