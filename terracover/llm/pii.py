"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

Base spans (email, ip, card, phone) follow fixed patterns with checks and always stay. They
miss data that runs into its surroundings: a phone number followed by an address, two cards
in a row, an address written with ``(at)``. Generators of high recall therefore propose
overlapping spans: stretches of digit groups that may be cards, phones or ips, and texts
around ``@`` or a bracketed ``at``. A candidate is described by its shape (digits, groups,
separators, check digit, largest part) and its context (characters and words beside it).
Whether the number goes on is left out, as base spans swallow what follows them. Base spans
are positive examples; candidates that cut into a base span, fail a check or sit inside a
word are negative; the rest is undecided.

Gradient-boosted trees learn from the distinct described examples (weighted by their counts,
at most ``sample`` of them, by hash); the plus sign of phones is not described, so numbers of
the same shape without it can be found. One in ``left_out`` documents calibrates: per kind the
threshold is the least score, in hundredths and at least one half, from which labelled
candidates reach ``precision``; a kind with fewer than ``least`` positive examples there adds
nothing. Undecided candidates above the threshold are taken best first where they overlap
neither a base span nor a taken one.

Shape of the job: one Python pass per document stages spans and candidates (no text); the
fit sees a bounded table, scoring is a column expression over all candidates, and what is
taken is grouped by document. Patterns are written so that their time is linear in the text.

Defined results: a null text is empty, its spans are the empty string. Offsets are code
points. Rows with equal id and text get equal results. Very long texts are scanned whole.
Only the two named columns are read; :func:`redact` keeps all columns whatever their names.
Without examples of either class, and for an empty table, there are base spans only.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terracover.llm.text import packed, row_key, rows_in_chunks, unpacked
from terracover.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
BATCH = 4 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A match starts where its run of digits starts, as all that precede end with one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBERS = re.compile(r"[0-9]++(?:[ ().+/\-–]{1,3}[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]+")
_AT = re.compile(r"@| ?[\(\[\{<](?i:at)[\)\]\}>] ?")
_LOOSE_DOMAIN = re.compile(r"[^\W_][\w-]*+(?: ?(?:\.|[\(\[\{<](?i:dot)[\)\]\}>]) ?[^\W_][\w-]*+)*+")
_LOOSE_LOCAL = re.compile(r"[\w.%+-]")
_HINTS = re.compile(r"(?i)\b(?:tel|phone|call|fax|mobile|card|visa|mastercard|ip|host|server|e-?mail|contact|payment)\b")
GROUPS = 6


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        if k % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def small_part(digits: str) -> bool:
    bare = digits.lstrip("0")
    return len(bare) <= 3 and int(bare or 0) <= 255


def digits_of(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns that pass their checks, in order."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((start, EMAIL, free))
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(map(small_part, m.group().split("."))):
            out.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            out.append((m.start(), PHONE, m.end()))
    out.sort()
    return out


def _beside(c: str) -> float:
    """What stands beside a span: nothing or a blank, a mark, a letter, a digit."""
    return 0.0 if not c or c.isspace() else 3.0 if c.isdigit() else 2.0 if c.isalpha() or c == "_" else 1.0


def _context(text: str, start: int, end: int) -> list[float]:
    before, after = text[max(0, start - 24):start], text[end:end + 24]
    return [
        _beside(before[-1:]), _beside(after[:1]), float(bool(_HINTS.search(before))), float(bool(_HINTS.search(after))),
    ]


def _number_candidates(text: str) -> Iterator[tuple[int, int, int, list[float], bool]]:
    """(start, kind, end, shape, bad) of stretches of digit groups; ``bad``: a check fails."""
    for run in _NUMBERS.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [(m.start(), m.end()) for m in _DIGITS.finditer(text, run.start(), run.end())]
        for i in range(len(groups)):
            n = 0
            for j in range(i, min(len(groups), i + GROUPS)):
                n += groups[j][1] - groups[j][0]
                if n > 19:
                    break
                count = j - i + 1
                if n < 9 and count < 4:
                    continue
                start, end = groups[i][0], groups[j][1]
                inner = text[start:end]
                marks = [text[a:b] for (_, a), (b, _) in zip(groups[i:j], groups[i + 1:j + 1])]
                joined = "".join(marks)
                sizes = [e - s for s, e in groups[i:j + 1]]
                shape = [
                    float(n), float(count), float(sizes[0]), float(sizes[1] if count > 1 else 0), float(sizes[-1]), float(max(sizes)), float(min(sizes)),
                    float(joined.count(" ")), float(joined.count("-")), float(joined.count(".")), float(joined.count("(") + joined.count(")")),
                    float(len(joined)),
                ]
                if count == 4 and joined == "...":
                    fits = all(small_part(x) for x in inner.split("."))
                    yield start, IP, end, [*shape, float(fits)], not fits
                if 12 <= n <= 19 and all(m in (" ", "-") for m in marks):
                    fits = luhn(digits_of(inner))
                    yield start, CARD, end, [*shape, float(fits)], not fits
                if 9 <= n <= 15 and not set(joined) & set("+/–"):
                    first = start
                    while first and text[first - 1] in "(+" and start - first < 2:
                        first -= 1
                    if text[first] == "+" or "(" in text[first:end] or count > 2:
                        yield first, PHONE, end, [*shape, 0.0], False


def _address_candidates(text: str) -> Iterator[tuple[int, int, int, list[float], bool]]:
    """Texts around ``@`` or a bracketed ``at``, in any letters, with blanks or bracketed dots."""
    for m in _AT.finditer(text):
        start, end = m.start(), m.end()
        while start and m.start() - start < 64 and _LOOSE_LOCAL.match(text[start - 1]):
            start -= 1
        domain = _LOOSE_DOMAIN.match(text, end, end + 256)
        if start == m.start() or not domain:
            continue
        labels = re.split(r" ?(?:\.|[\(\[\{<](?i:dot)[\)\]\}>]) ?", domain.group())
        good = len(labels) > 1 and labels[-1].isalpha() and len(labels[-1]) > 1
        shape = [
            float(m.start() - start), float(len(labels)), float(len(labels[0])), float(len(labels[-1])), float(labels[-1].isalpha()),
            float(max(map(len, labels))), float(any(map(str.isdigit, domain.group()))),
        ]
        yield start, EMAIL, domain.end(), [*shape, *[0.0] * 5, float(good)], not good


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list[float]]]:
    """(start, kind, end, label, features); label 1 or 0, -1 if undecided."""
    out = []
    known = set(base)
    starts = [s for s, _, _ in base]
    reach, farthest = [], 0
    for _, _, e in base:
        farthest = max(farthest, e)
        reach.append(farthest)
    for found in (_number_candidates(text), _address_candidates(text)):
        for start, kind, end, shape, bad in found:
            k = bisect_left(starts, end)
            cuts = k > 0 and reach[k - 1] > start
            context = _context(text, start, end)
            if (start, kind, end) in known:
                label = 1
            else:
                label = 0 if cuts or bad or 2.0 in context[:2] else -1
            out.append((start, kind, end, label, [*[float(kind == x) for x in range(4)], *shape, *context]))
    return out


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_CANDIDATE = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("features", pa.list_(pa.float64()))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_in_chunks(batches, "text", BATCH):
        spans, proposed = [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
            proposed.append([{"start": s, "kind": k, "end": e, "label": y, "features": f} for s, k, e, y, f in candidates(text or "", base)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").cast(pa.binary()), batch.column("id"), pa.array(spans, pa.list_(_SPAN)), pa.array(proposed, pa.list_(_CANDIDATE))],
            names=["key", "id", "base", "candidates"],
        )


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_RESULT = "id {kind}, key binary, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and the best candidates that overlap none of them."""
    for batch in batches:
        rows = []
        for base, more in zip(batch.column("base").to_pylist(), batch.column("more").to_pylist()):
            held = [(x["start"], x["kind"], x["end"]) for x in base]
            # Undecided candidates never overlap a base span; the taken ones are apart from each other.
            taken: list[tuple[int, int, int]] = []
            for x in sorted(more or (), key=lambda x: (-x["score"], x["start"] - x["end"], x["start"], x["kind"])):
                k = bisect_left(taken, (x["end"],))
                if not k or taken[k - 1][1] <= x["start"]:
                    taken.insert(k, (x["start"], x["end"], x["kind"]))
            found = sorted([*held, *[(s, kind, e) for s, e, kind in taken]])
            counts = [sum(k == kind for _, k, _ in held) for kind in range(4)]
            rows.append((*counts, sha256(_written(held).encode()).hexdigest(), _written(found)))
        types = [pa.int64()] * 4 + [pa.string()] * 2
        columns = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key").cast(pa.binary()), *[pa.array(c, t) for c, t in zip(columns, types)]],
            names=["id", "key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )


def fit(examples: DataFrame, sample: int, trees: int, depth: int):
    """Boosted trees from (features, label, n), or None if a class is missing."""
    hashed = examples.withColumn("order", F.md5(F.concat_ws(" ", F.col("features").cast("array<string>"), "label")))
    # The bounded table is one partition in a fixed order, so sums of the fit do not vary.
    chosen = stage(hashed.orderBy("order").limit(sample).select(
        array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"), F.col("n").cast("double").alias("weight"), "order"
    ).coalesce(1), "pii-examples")
    if chosen.select("label").distinct().count() < 2:
        return None
    learner = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, seed=13)
    return learner.fit(chosen.coalesce(1).sortWithinPartitions("order"))


def thresholds(scored: DataFrame, precision: float, least: int) -> dict[int, float]:
    """Per kind the least score, in hundredths, from which labelled candidates (kind, label, n, score) are precise."""
    step = F.floor(F.col("score") * 100).cast("int")
    bins = scored.groupBy("kind", step.alias("bin")).agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("yes"), F.sum("n").alias("all")
    ).collect()  # 101 bins of 4 kinds
    out = {}
    for kind in range(4):
        own = sorted(((r["bin"], r["yes"], r["all"]) for r in bins if r["kind"] == kind and r["bin"] >= 50), reverse=True)
        yes = every = 0
        for at, y, n in own:
            yes, every = yes + y, every + n
            if yes >= precision * every:
                out[kind] = at / 100
        if sum(y for _, y, _ in own) < least:
            out.pop(kind, None)
    return out


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 100_000, trees: int = 20, depth: int = 4,
    left_out: int = 5, precision: float = 0.99, least: int = 20,
) -> DataFrame:
    """Per row: id, ``key``, counts and digest of the base spans, and ``spans``, all spans as text."""
    key = row_key(docs[id_col], docs[text_col])
    source = docs.select(key.alias("key"), docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    candidate = "array<struct<start:int,kind:int,end:int,label:int,features:array<double>>>"
    scanned = stage(
        source.mapInArrow(_scan, f"key binary, id {kind}, base array<struct<start:int,kind:int,end:int>>, candidates {candidate}"), "pii-spans"
    )
    each = scanned.where("size(candidates) > 0").select("key", F.explode("candidates").alias("x")).select("key", "x.*")
    fold = F.crc32("key") % left_out
    described = stage(
        each.where("label >= 0").withColumn("held", fold == 0).groupBy("held", "kind", "label", "features").agg(F.count("*").alias("n")),
        "pii-described",
    )
    model = fit(described.where("NOT held").groupBy("features", "label").agg(F.sum("n").alias("n")), sample, trees, depth)
    rows = scanned.select("key", "id", "base")
    if model is None:
        met = rows.withColumn("more", F.expr("cast(null as array<struct<score:double,start:int,kind:int,end:int>>)"))
    else:
        def scored(df: DataFrame) -> DataFrame:
            given = df.withColumn("features", array_to_vector("features"))
            return model.transform(given).withColumn("score", vector_to_array("probability")[1])

        cuts = thresholds(scored(described.where("held")), precision, least)
        enough = F.lit(False)
        for k, cut in cuts.items():
            enough = enough | ((F.col("kind") == k) & (F.col("score") >= cut))
        taken = scored(each.where("label = -1")).where(enough)
        more = taken.groupBy("key").agg(F.collect_set(F.struct(F.round("score", 9).alias("score"), "start", "kind", "end")).alias("more"))
        met = rows.join(stage(more, "pii-taken"), "key", "left")
    return met.mapInArrow(_choose, _RESULT.format(kind=kind)).withColumnRenamed("id", id_col)


@F.arrow_udf(StringType())
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, listed in zip(texts.to_pylist(), spans.to_pylist()):
        if not text or not listed:
            out.append(text)
            continue
        parts, at = [], 0
        for kind, start, end in sorted((x.split(":") for x in listed.split(",")), key=lambda x: (int(x[1]), int(x[2]))):
            if int(start) >= at:
                parts += [text[at:int(start)], f"[{kind.upper()}]"]
            at = max(at, int(end))
        out.append("".join(parts) + text[at:])
    return pa.array(out, pa.string())


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; spans that overlap become one."""
    spans = personal_data(docs, id_col, text_col, **limits).select("key", "spans").dropDuplicates(["key"])
    source = docs.select(packed(docs).alias("row"), row_key(docs[id_col], docs[text_col]).alias("key"))
    met = source.join(spans.hint("shuffle_hash"), "key")
    return unpacked(met, docs.columns, {text_col: _without(F.col("row").getField(text_col), "spans")})
