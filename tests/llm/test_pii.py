"""Personal data: base spans against the plain patterns, added spans against planted cases."""

import random
import re
import time
from hashlib import sha256

import pytest
from odd import SCHEMA, rows

from terracover.llm import pii
from terracover.llm.queries import REGISTRY

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_sum(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and check_sum(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_base_equals_plain_patterns():
    rng = random.Random(5)
    for alphabet in ("a1.@-", "0123456789 -", "+1 ().5-", "12.30", "aB9_.%+-@ ", "1.2345 -+()@a漢"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == plain(text), text


def test_candidates_hold_every_number_span():
    for text in ("call +1 (017) 555-7713 now", "4556 7375 8689 9855", "1.2.3.4"):
        base = pii.base_spans(text)
        assert {(s, k, e) for s, k, e, y, _ in pii.candidates(text, base) if y == 1} == set(base) != set()
    found = pii.candidates(text := "x@y.org " * 3, pii.base_spans(text))
    assert [y for *_, y, _ in found] == [1, 1, 1]
    assert len({len(f) for *_, f in found}) == 1


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 200_000, "+" * 200_000, "+1 " * 100_000, "a@" * 100_000, "12 " * 100_000, "a" * 200_000 + "@b"])
def test_long_texts_take_linear_time(text):
    start = time.perf_counter()
    pii.candidates(text, pii.base_spans(text))
    assert time.perf_counter() - start < 20


def numbers(rng):
    def card():
        head = "".join(rng.choice("0123456789") for _ in range(15))
        return next(head + c for c in "0123456789" if check_sum(head + c))

    phone = lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
    ip = lambda: ".".join(str(rng.randint(10, 250)) for _ in range(4))
    mail = lambda: f"{rng.choice(['anna', 'tom', 'lee'])}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
    return card, phone, ip, mail


def corpus():
    rng = random.Random(2)
    card, phone, ip, mail = numbers(rng)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    docs, hidden = [], {}
    for i in range(600):
        docs.append((i, f"{prose(6)} {rng.choice([card, phone, ip, mail])()} {prose(4)}. {prose(3)} {rng.choice([card, phone, ip, mail])()} {prose(2)}"))
    for i in range(600, 700):
        token = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        clean = ["on 2024-01-05 at 10:30:15", f'token = "{token}"', f"order {rng.randint(10**9, 10**10)} paid 1,204.50", "version 10.400.3.999",
                 "pages 12-15, 18-21 and 30", next(n for n in (str(rng.randint(10**15, 10**16)) for _ in range(99)) if not check_sum(n))]
        docs.append((i, f"{prose(6)} {rng.choice(clean)} {prose(5)}"))
        hidden[i] = []
    for i in range(700, 800):
        case = i % 4
        a, b = [(phone(), ip()), (card(), card()), (f"anna{i}", f"mail{i % 9}.example.com"), (phone(), card())][case]
        joint = " (at) " if case == 2 else " "
        lead = prose(5) + " "
        docs.append((i, f"{lead}{a}{joint}{b} {prose(4)}"))
        second = len(lead) + len(a) + len(joint)
        hidden[i] = [
            [f"phone:{len(lead)}:{second - 1}"], [f"card:{len(lead)}:{second - 1}", f"card:{second}:{second + 16}"],
            [f"email:{len(lead)}:{second + len(b)}"], [f"phone:{len(lead)}:{second - 1}", f"card:{second}:{second + 16}"],
        ][case]
    return docs, hidden


def test_added_spans_catch_planted_cases_and_leave_clean_texts(spark):
    docs, hidden = corpus()
    got = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    caught = wanted = 0
    for i, text in docs:
        base = [f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in plain(text)]
        spans = got[i]["spans"].split(",") if got[i]["spans"] else []
        assert set(base) <= set(spans)
        assert got[i]["base_sha256"] == sha256(",".join(base).encode()).hexdigest()
        if i in hidden:
            caught += len(set(hidden[i]) & set(spans))
            wanted += len(hidden[i])
            assert set(spans) <= set(hidden[i]) | set(base), (text, spans)
        else:
            assert set(spans) == set(base), (text, spans)
    assert caught >= 0.9 * wanted


def test_odd_rows_and_redaction(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    got = pii.personal_data(frame).collect()
    assert len(got) == len(rows())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["spans"]) for r in got) == sorted(
        (r[0] is None, r[0] or 0, ",".join(f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in plain(r[1] or ""))) for r in rows()
    )
    data = [(1, "mail x@y.org, ip 1.2.3.4 end", "k", "s"), (2, None, "k", "s"), (1, "mail x@y.org, ip 1.2.3.4 end", "k", "s")]
    clean = pii.redact(spark.createDataFrame(data, "doc_id bigint, text string, key string, spans string"))
    assert clean.columns == ["doc_id", "text", "key", "spans"]
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted(
        [(1, "mail [EMAIL], ip [IP] end", "k", "s"), (2, None, "k", "s"), (1, "mail [EMAIL], ip [IP] end", "k", "s")], key=repr
    )


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.personal_data(frame).count() == 0 and pii.redact(frame).count() == 0


def test_query_keeps_base_spans(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = REGISTRY["op13_pii"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x == i for _, x, _ in base) for i in range(4)]
        named = [f"{list(PLAIN)[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r["spans"].split(","))
