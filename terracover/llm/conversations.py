"""Conversation structure repair: cheapest edits that make the roles of a conversation legal.

Roles must spell ``(s?(ua)+)?`` by their initials. Rows may be kept (0), given the role the
grammar asks for (2) or deleted (3, forced for blank and duplicate rows); empty user or
assistant rows may be inserted (2); an undeleted truncated row adds 1. Among the cheapest
edits the one whose initials (D, I, K, R) are ASCII-least is taken.

Every row is a symbol of role and fault, a conversation is its signature. Which edits are
best depends on what follows only, so signatures are read from the end: sorted by their
reversal, those with a common suffix are neighbours and share the nodes of that suffix (a
suffix-shared word graph). A node holds, per grammar state, the cost to go and the first
edit of the best audit suffix, whose rest is read off the nodes behind it; it is computed
once, whatever the number of conversations that pass it. Nodes whose costs differ by a
constant have equal edits, so a step is looked up by (normalised costs, symbol): the states
of the minimised machine.

Shape of the job: rows are range-partitioned by (conversation, turn, role, text), so a
conversation with a third of all rows spreads over tasks. Each task cuts its stretch into
pieces of bounded size. Pieces of conversations that fit one piece go straight to the word
graph; the others first exchange 16 costs (piece by piece, backwards) and then their
grammar state (forwards). Piece and signature range-partition the graph, so a frequent
signature spreads as well. The digest of a conversation of many pieces is one sequential
hash by definition: its lines stream through one task in order and are not held there.

Defined results: rows of equal turn are ordered by role and digest of the text, null turns
first. A null id is a conversation of its own and a space in the damage key; null roles and
texts are one space. Roles count by their first character, case matters; an empty role is
none of s, u, a. Equal rows count as often as they occur: all after the first are
duplicates. Very long texts stay whole, a piece holds at least one row. Only the four named
columns are read, extra or clashing names have no effect. An empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracover.llm.text import BLANKS, row_key
from terracover.sources.staging import stage

PIECE_ROWS, PIECE_BYTES = 2048, 256 << 10
FAR = 1 << 40
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
WANTED = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
END = (0, 4, 2, 0)
#: Symbols: role initial (o: another), upper case if truncated; X must be deleted.
MUST_GO = "X"


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, n): rows after the seeded damage; n copies of each."""
    conv, turn = rows[id_col], rows[turn_col]
    role, text = F.coalesce(rows[role_col], F.lit(" ")), F.coalesce(rows[text_col], F.lit(" "))
    name = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    return rows.select(
        conv.alias("conv"), turn.alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"), kind.alias("kind"),
    ).where("kind <> 0").drop("kind")


def with_faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``n``, ``symbol`` of the first copy and counts of their faults.

    ``rows``: (conv, turn, role, text, n). Equal rows are merged map-side before texts move.
    """
    rows = rows.select(row_key(F.col("conv")).alias("ck"), "*", F.unhex(F.md5("text")).alias("digest"))
    merged = stage(
        rows.groupBy("ck", "conv", "turn", "role", "digest").agg(F.first("text").alias("text"), F.sum("n").alias("n")),
        "conversation-rows",
    )
    # The copies that stand first are the ones of the least turn; few texts occur at several turns.
    again = stage(
        merged.groupBy("ck", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1").select(*[F.col(c).alias(f"of_{c}") for c in ("ck", "role", "digest")], "first"),
        "conversation-repeats",
    )
    same = [F.col(c) == F.col(f"of_{c}") for c in ("ck", "role", "digest")]
    met = merged.join(again, same, "left")
    bare = F.btrim("text", F.lit(BLANKS))
    blank = bare == ""
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    cut = ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")

    def count(condition: Column, of: Column | str) -> Column:
        return F.when(condition, of).otherwise(0).cast("long")

    return met.select(
        "ck", "conv", "turn", "role", "digest", "text", "n", letter.alias("initial"),
        F.when(blank | later, MUST_GO).when(cut, F.upper(letter)).otherwise(letter).alias("symbol"),
        count(blank, F.col("n")).alias("blank"), count(~blank, F.when(later, F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        count(~blank & ~later & cut, F.lit(1)).alias("truncated"),
    )


class Steps(dict):
    """(normalised costs to go, symbol) to (costs before it, their offset, best edit per state)."""

    def __missing__(self, at):
        costs, symbol = at
        edits = "" if symbol == MUST_GO else symbol.lower()
        late = int(bool(edits) and symbol.isupper())
        base = []
        for q in range(4):
            options = [(3 + costs[q], "D")]
            if edits:
                to = AFTER[edits][q] if edits in AFTER else None
                if to is not None:
                    options.append((late + costs[to], "K"))
                options.append((2 + late + costs[WANTED[q]], "R"))
            base.append(options)
        best = [min(cost for cost, _ in options) for options in base]
        # Inserting more than twice leads back to the same state.
        full = [min(best[q], 2 + best[WANTED[q]], 4 + best[WANTED[WANTED[q]]]) for q in range(4)]
        edit = "".join(
            min([e for cost, e in base[q] if cost == full[q]] + ["I"] * (2 + full[WANTED[q]] == full[q])) for q in range(4)
        )
        low = min(full)
        self[at] = found = (tuple(min(c - low, FAR) for c in full), low, edit)
        return found


class SuffixGraph:
    """Nodes of the suffixes of one signature; the next signature keeps the nodes it shares."""

    def __init__(self):
        self.steps, self.end, self.read = Steps(), None, ""
        self.nodes: list[tuple[tuple[int, ...], int, str]] = []
        self.made = 0

    def hold(self, end: tuple[int, ...], signature: str) -> None:
        back = signature[::-1]
        shared = 0
        if end == self.end:
            low, high = 0, min(len(back), len(self.read))
            while low < high:
                middle = (low + high + 1) // 2
                if back[:middle] == self.read[:middle]:
                    low = middle
                else:
                    high = middle - 1
            shared = low
        else:
            self.end, self.nodes = end, [(end, 0, "")]
        del self.nodes[shared + 1:]
        costs, total, _ = self.nodes[-1]
        for symbol in back[shared:]:
            costs, more, edit = self.steps[costs, symbol]
            total += more
            self.nodes.append((costs, total, edit))
        self.made += len(back) - shared
        self.read = back

    def cost(self, state: int) -> int:
        return self.nodes[-1][0][state] + self.nodes[-1][1]

    def audit(self, state: int, last: bool) -> tuple[str, int]:
        """Best edits from ``state`` and the state they lead to; ``last`` pieces end legally."""
        out = []
        read = self.read
        for k in range(len(read), 0, -1):
            edit = self.nodes[k][2]
            while edit[state] == "I":
                out.append("I")
                state = WANTED[state]
            out.append(edit[state])
            if edit[state] == "K":
                state = AFTER[read[k - 1].lower()][state]
            elif edit[state] == "R":
                state = WANTED[state]
        while last and state not in (0, 3):
            out.append("I")
            state = WANTED[state]
        return "".join(out), state


def repaired(start: int, audit: str, signature: str, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts that the edits leave; the given ones skip rows that must go."""
    new_roles, new_texts = [], []
    state, held, symbols = start, 0, iter(signature)
    for edit in audit:
        if edit == "I":
            new_roles.append(ROLE[state])
            new_texts.append("")
            state = WANTED[state]
            continue
        symbol = next(symbols)
        if edit != "D":
            new_roles.append(roles[held] if edit == "K" else ROLE[state])
            new_texts.append(texts[held])
            state = AFTER[symbol.lower()][state] if edit == "K" else WANTED[state]
        held += symbol != MUST_GO
    return new_roles, new_texts


_PIECE = pa.schema([
    ("ck", pa.binary()), ("part", pa.int32()), ("seq", pa.int64()), ("signature", pa.string()), ("initials", pa.string()),
    ("illegal", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to pieces of one conversation each."""
    from pyspark import TaskContext

    part, seq, ck, size = TaskContext.get().partitionId(), 0, None, 0
    signature, initials, roles, texts, ready, weight = [], [], [], [], [], 0

    def piece() -> tuple:
        letters = "".join(initials)
        legal = letters.count("su") + letters.count("ua") + letters.count("au")
        return (ck, part, seq, "".join(signature), letters[:1] + letters[-1:], len(letters) - 1 - legal, list(roles), list(texts))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("ck", "n", "initial", "symbol", "role", "text")]
        for key, n, initial, symbol, role, text in zip(*columns):
            while n:
                if signature and (key != ck or len(signature) >= PIECE_ROWS or size >= PIECE_BYTES):
                    ready.append(piece())
                    weight += size + 200
                    seq += 1
                    signature, initials, roles, texts, size = [], [], [], [], 0
                    if weight > 4 << 20:
                        yield batch_of(ready)
                        ready, weight = [], 0
                ck = key
                signature.append(symbol)
                initials.append(initial)
                if symbol != MUST_GO:
                    roles.append(role)
                    texts.append(text)
                    size += len(text) + len(role)
                n, symbol = n - 1, MUST_GO
    if signature:
        ready.append(piece())
    if ready:
        yield batch_of(ready)


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cheapest cost of every piece from each state to each state."""
    graph = SuffixGraph()
    for batch in batches:
        out = []
        for signature in batch.column("signature").to_pylist():
            found = []
            for end in range(4):
                graph.hold(tuple(0 if q == end else FAR for q in range(4)), signature)
                found.append([min(graph.cost(q), FAR) for q in range(4)])
            out.append([c for row in found for c in row])
        yield pa.RecordBatch.from_arrays(
            [batch.column("ck"), batch.column("part"), batch.column("seq"), pa.array(out, pa.list_(pa.int64()))], names=["ck", "part", "seq", "costs"]
        )


def _ends(group: pa.Table) -> pa.Table:
    """Costs to go behind every piece of a conversation, from the last piece to the first."""
    rows = group.sort_by([("part", "descending"), ("seq", "descending")])
    costs, out = END, []
    for k, flat in enumerate(rows.column("costs").to_pylist()):
        out.append([*costs, int(k == 0)])
        before = [min(flat[4 * e + q] + costs[e] for e in range(4)) for q in range(4)]
        costs = tuple(min(c - min(before), FAR) for c in before)
    kept = rows.select(["ck", "part", "seq"])
    return kept.append_column("end", pa.array(out, pa.list_(pa.int64())))


def _moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State that every piece leads to from each state."""
    graph = SuffixGraph()
    for batch in batches:
        out = []
        for signature, end in zip(batch.column("signature").to_pylist(), batch.column("end").to_pylist()):
            graph.hold(tuple(end[:4]), signature)
            out.append([graph.audit(q, bool(end[4]))[1] for q in range(4)])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("ck", "part", "seq", "end")], pa.array(out, pa.list_(pa.int64()))], names=["ck", "part", "seq", "end", "to"]
        )


def _starts(group: pa.Table) -> pa.Table:
    rows = group.sort_by([("part", "ascending"), ("seq", "ascending")])
    state, out = 0, []
    for to in rows.column("to").to_pylist():
        out.append(state)
        state = to[state]
    return rows.select(["ck", "part", "seq", "end"]).append_column("start", pa.array(out, pa.int64()))


_REPAIRED = pa.schema([
    ("ck", pa.binary()), ("part", pa.int32()), ("seq", pa.int64()), ("initials", pa.string()), ("illegal", pa.int64()),
    ("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by end and reversed signature, with their edits and repaired lines."""
    graph, done = SuffixGraph(), None
    for batch in batches:
        costs, audits, new = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("signature", "end", "start", "roles", "texts")]
        for signature, end, start, roles, texts in zip(*columns):
            if done is None or done[:3] != (signature, end, start):
                graph.hold(tuple(end[:4]), signature)
                audit, to = graph.audit(start, bool(end[4]))
                # Costs of this piece alone: what is to go behind it is left out.
                done = (signature, end, start, audit, graph.cost(start) - (0 if end[4] else end[to]))
            costs.append(done[4])
            audits.append(done[3])
            new.append(repaired(start, done[3], signature, roles, texts))
        yield pa.RecordBatch.from_arrays([
            *[batch.column(c).cast(_REPAIRED.field(c).type) for c in ("ck", "part", "seq", "initials", "illegal")],
            pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
            *[pa.array([x[i] for x in new], pa.list_(pa.string())) for i in (0, 1)],
        ], schema=_REPAIRED)


_WHOLE = pa.schema([("ck", pa.binary()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and place to one row per conversation; lines are hashed as they come."""
    ck, state = None, None
    ready: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _WHOLE)], schema=_WHOLE)

    def whole() -> tuple:
        return ck, state[0], state[1], "".join(state[2]), state[3].hexdigest()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("ck", "initials", "illegal", "cost", "audit", "roles", "texts")]
        for key, initials, illegal, cost, audit, roles, texts in zip(*columns):
            if key != ck:
                if state:
                    ready.append(whole())
                ck, state = key, [0, 0, [], sha256(), "", False]
            state[0] += illegal + (bool(state[4]) and state[4] + initials[:1] not in ("su", "ua", "au"))
            state[1] += cost
            state[2].append(audit)
            state[4] = initials[-1:]
            for role, text in zip(roles, texts):
                state[3].update(f"{chr(10) if state[5] else ''}{role}:{text}".encode())
                state[5] = True
        if ready:
            yield batch_of(ready)
            ready = []
    if state:
        yield batch_of([whole()])


def repairs(faulted: DataFrame) -> DataFrame:
    """Pieces (ck, part, seq, illegal, cost, audit, roles, texts) of the repaired rows of :func:`with_faults`."""
    names = "ck binary, part int, seq bigint, signature string, initials string, illegal bigint, roles array<string>, texts array<string>"
    order = ["ck", "turn", "role", "digest"]
    rows = faulted.select(*order, "n", "initial", "symbol", "text")
    pieces = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, names), "conversation-pieces")
    place = ["ck", "part", "seq"]
    many = pieces.groupBy("ck").agg(F.count("*").alias("n")).where("n > 1").select("ck")
    split = stage(pieces.select(*place, "signature").join(many, "ck"), "conversation-split")
    ends = split.mapInArrow(_costs, "ck binary, part int, seq bigint, costs array<bigint>").groupBy("ck").applyInArrow(
        _ends, "ck binary, part int, seq bigint, end array<bigint>"
    )
    moves = split.join(ends, place).mapInArrow(_moves, "ck binary, part int, seq bigint, end array<bigint>, to array<bigint>")
    starts = stage(moves.groupBy("ck").applyInArrow(_starts, "ck binary, part int, seq bigint, end array<bigint>, start bigint"), "conversation-states")
    whole = F.array(*[F.lit(c).cast("long") for c in (*END, 1)])
    known = pieces.join(starts, place, "left").withColumns({
        "end": F.coalesce("end", whole), "start": F.coalesce("start", F.lit(0).cast("long")), "back": F.reverse("signature"),
    })
    graph_order = ["end", "back", *place]
    return known.repartitionByRange(*graph_order).sortWithinPartitions(*graph_order).mapInArrow(
        _repair, "ck binary, part int, seq bigint, initials string, illegal bigint, cost bigint, audit string, roles array<string>, texts array<string>"
    )


def _source(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, seeded: bool) -> tuple[DataFrame, DataFrame]:
    """Ids of all conversations, and the rows to repair with their faults."""
    source = rows.select(*[rows[c].alias(n) for c, n in ((id_col, "conv"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))])
    space = F.lit(" ")
    hurt = damage(source, "conv", "turn", "role", "text") if seeded else source.withColumns(
        {"role": F.coalesce("role", space), "text": F.coalesce("text", space), "n": F.lit(1).cast("long")}
    )
    every = source.select("conv").distinct().select(row_key(F.col("conv")).alias("ck"), "conv")
    return every, stage(with_faults(hurt), "conversation-faults")


def repair_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", seeded: bool = False,
) -> DataFrame:
    """One row per conversation: gaps, fault counts, cost, audit and digest of the repaired rows.

    With ``seeded`` the rows take the seeded damage first.
    """
    every, faulted = _source(rows, id_col, turn_col, role_col, text_col, seeded)
    turns = faulted.groupBy("ck").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    pieces = stage(repairs(faulted), "conversation-repairs")
    results = pieces.repartition("ck").sortWithinPartitions("ck", "part", "seq").mapInArrow(
        _joined, "ck binary, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    met = every.join(turns, "ck", "left").join(results, "ck", "left")
    return met.select(
        F.col("conv").alias(id_col), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def repaired_rows(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", seeded: bool = False,
) -> DataFrame:
    """(id, place, role, text): the repaired conversations themselves, ``place`` from 0."""
    every, faulted = _source(rows, id_col, turn_col, role_col, text_col, seeded)
    pieces = stage(repairs(faulted), "conversation-repairs")
    # Rows of a conversation ahead of a piece: one number per piece, not per row.
    order = Window.partitionBy("ck").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select("ck", "part", "seq", F.arrays_zip("roles", "texts").alias("rows")).withColumn(
        "ahead", F.coalesce(F.sum(F.size("rows")).over(order), F.lit(0))
    ).select("ck", "ahead", F.posexplode("rows").alias("at", "row"))
    return placed.join(every.withColumnRenamed("conv", id_col), "ck").select(
        id_col, (F.col("ahead") + F.col("at")).alias("place"), F.col("row.roles").alias("role"), F.col("row.texts").alias("text")
    )
