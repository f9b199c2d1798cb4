"""Conversation repair against an exhaustive search and plain Python."""

import random
import sys
from functools import lru_cache
from hashlib import sha256
from zlib import crc32

import pytest

from terracover.llm import conversations
from terracover.llm.queries import REGISTRY

BLANK = " \t\n\x0b\f\r"


def damaged(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(symbols):
    """(cost, audit) by trying every edit; at most two insertions in a row can help."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    wanted = {0: 2, 1: 2, 2: 3, 3: 2}

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(symbols) and state in (0, 3):
            options.append((0, ""))
        if inserted < 3:
            cost, rest = best(i, wanted[state], inserted + 1)
            options.append((cost + 2, "I" + rest))
        if i < len(symbols):
            must, late, letter = symbols[i]
            cost, rest = best(i + 1, state, 0)
            options.append((cost + 3, "D" + rest))
            if not must:
                if (state, letter) in after:
                    cost, rest = best(i + 1, after[state, letter], 0)
                    options.append((cost + late, "K" + rest))
                cost, rest = best(i + 1, wanted[state], 0)
                options.append((cost + 2 + late, "R" + rest))
        return min(options, default=(10**9, ""))

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        return best(0, 0, 0)
    finally:
        sys.setrecursionlimit(limit)


def expected(rows, seeded):
    from hashlib import md5

    rows = list(rows)
    left = list(damaged(rows)) if seeded else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], md5(r[3].encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, symbols, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            bare = text.strip(BLANK)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols.append((fault in (0, 1), int(fault == 2), role[:1]))
        initials = [s[2] for s in symbols]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple(symbols))
        lines, state, i = [], 0, 0
        for edit in audit:
            name, to = (("assistant", 3) if state == 2 else ("user", 2))
            if edit == "I":
                lines.append(f"{name}:")
                state = to
                continue
            _, _, role, text = own[i]
            i += 1
            if edit == "K":
                lines.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            elif edit == "R":
                lines.append(f"{name}:{text}")
                state = to
        out[conv] = (gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_conversations(n=150):
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "umpire"]
    texts = ["Yes.", "No", "", " \t", None, "What?", "Go on!  ", "Ünï 漢.", "a:b.", "x\ny.", "."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn if rng.random() > 0.1 else rng.choice([None, turn + 2, 0]),
                         rng.choice(roles) if rng.random() < 0.4 else roles[turn % 2], rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}."))
    return rows + rows[:20] + [(None, None, None, None), (None, 1, "user", "Hi."), (900, None, "user", "A."), (900, None, "user", "B")]


def frame(spark, rows):
    shaped = [(*r, "x", 1) for r in rows]
    return spark.createDataFrame(shaped, "conv_id bigint, turn bigint, role string, text string, ck string, n bigint")


def results(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


@pytest.mark.parametrize("seeded", [True, False])
def test_equals_exhaustive_search(spark, seeded):
    rows = odd_conversations()
    got = results(conversations.repair_conversations(frame(spark, rows), seeded=seeded))
    assert got == expected(rows, seeded)


def test_long_conversation_in_many_pieces(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "tool", "system"]), rng.choice(["a.", "b", "", f"c{t}."])) for t in range(400)]
    rows += [(2, 0, "user", "same.")] * 300 + [(3, t, "user", "again!") for t in range(50)] + [(4, 0, "user", "y" * 300_000 + "."), (4, 1, "assistant", "z " * 200_000)]
    monkeypatch.setattr(conversations, "PIECE_ROWS", 7)
    got = results(conversations.repair_conversations(frame(spark, rows)))
    assert got == expected(rows, False)


def test_empty_table(spark):
    assert conversations.repair_conversations(frame(spark, []), seeded=True).count() == 0
    assert conversations.repaired_rows(frame(spark, [])).count() == 0


def test_repaired_rows_are_legal(spark):
    import re

    rows = odd_conversations(60)
    out = {}
    for r in conversations.repaired_rows(frame(spark, rows)).collect():
        out.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    want = expected(rows, False)
    for conv, held in out.items():
        held.sort()
        assert [p for p, _, _ in held] == list(range(len(held)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role, _ in held))
        assert sha256("\n".join(f"{role}:{text}" for _, role, text in held).encode()).hexdigest() == want[conv][-1]


def test_nodes_are_shared():
    graph = conversations.SuffixGraph()
    for signature in sorted(["uaua", "xuaua".replace("x", "o"), "suaua", "uaua", "aua"], key=lambda s: s[::-1]):
        graph.hold(conversations.END, signature)
    assert graph.made == 6  # aua, u, and o or s before it


def test_query_equals_exhaustive_search(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert results(REGISTRY["op11_conversations"](spark, sf_dir)) == expected(rows, True)
