"""Line dedup: lines that many documents share are dropped from every document.

Texts are split at ``\\n``; a line's key is the line stripped of ASCII blanks at both ends
with A-Z lower-cased. Keys are hashed to 128 bits, distinct documents are counted per hash
and lines of frequent keys leave all documents; the others stay in order.

Shape of the job: one pass hashes the lines (a staged table of hashes, a few per cent of
the input). Rows are counted per hash, combined map-side, so a line that a third of all
documents holds costs one row per task; only hashes that enough rows hold are counted by
distinct documents. What is counted is staged before line positions meet it, so Spark
broadcasts it if it is small and splits hot hashes otherwise. Texts move once, to meet their
dropped positions.

Defined results: a null or empty text is one empty line. Documents are told apart by id, so
rows that repeat an id count once; rows without an id are told apart by their text. Repeated
rows get equal results. Blank lines have no key and stay. Very long texts and lines are
handled whole. Input columns are kept; ``text``, ``n_lines`` and ``n_dropped`` of the result
replace input columns of these names. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terracover.llm.text import packed, row_key, unpacked
from terracover.operators.joins import large_join
from terracover.sources.staging import stage

_HASHED = pa.schema([("key", pa.binary()), ("doc", pa.binary()), ("lines", pa.list_(pa.binary()))])


def _line_hashes(least: int):
    def digest(line: bytes) -> bytes | None:
        bare = line.strip().lower()
        if len(bare) < least or (least > 1 and len(bare.decode()) < least):
            return None
        return blake2b(bare, digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            hashes = [[digest(x) for x in (t or "").encode().split(b"\n")] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).cast(pa.binary()) for c in ("key", "doc")], pa.array(hashes, pa.list_(pa.binary()))], schema=_HASHED
            )

    return run


@F.arrow_udf(StringType())
def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the lines at the given positions; null where there is no text."""
    out = []
    for text, positions in zip(texts.to_pylist(), gone.to_pylist()):
        drop = set(positions or ())
        out.append(text and "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop))
    return pa.array(out, pa.string())


def frequent_lines(hashed: DataFrame, min_docs: int) -> DataFrame:
    """Hashes of ``hashed.lines`` that at least ``min_docs`` documents hold, with their counts."""
    each = hashed.select("doc", F.explode(F.array_distinct("lines")).alias("hash")).where("hash IS NOT NULL")
    # Documents have at least one row each, so few hashes are left for the exact count.
    likely = stage(each.groupBy("hash").agg(F.count("*").alias("rows")).where(F.col("rows") >= min_docs).select("hash"), "likely-lines")
    # Dealt anew by document, or the hot hashes of the join could not be split.
    held = large_join(each, likely, "hash").select("hash", "doc").repartition("hash", "doc").distinct()
    return held.groupBy("hash").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)


def drop_frequent_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_key_chars: int = 1,
    with_counts: bool = True,
) -> DataFrame:
    """``docs`` with ``text`` cleaned and, if wanted, ``n_lines`` (before) and ``n_dropped`` per document."""
    key = row_key(docs[id_col], docs[text_col])
    doc = F.when(docs[id_col].isNotNull(), row_key(docs[id_col])).otherwise(key)
    keyed = docs.select(key.alias("key"), doc.alias("doc"), docs[text_col].alias("text"))
    hashed = stage(
        keyed.mapInArrow(_line_hashes(min_key_chars), "key binary, doc binary, lines array<binary>"), "line-hashes"
    )
    frequent = stage(frequent_lines(hashed, min_docs).select("hash"), "frequent-lines")
    lines = hashed.select("key", F.posexplode("lines").alias("pos", "hash")).where("hash IS NOT NULL")
    gone = (
        large_join(lines, frequent, "hash")
        .groupBy("key").agg(F.collect_set("pos").alias("gone"))
    )
    source = docs.select(packed(docs).alias("row"), key.alias("key"))
    text = F.col("row").getField(text_col)
    met = source.join(gone.hint("shuffle_hash"), "key", "left")
    clean = F.when(F.col("gone").isNull(), text).otherwise(_without(F.when(F.col("gone").isNotNull(), text), "gone"))
    counts = {
        "n_lines": F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).cast("long"),
        "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
    }
    return unpacked(met, docs.columns, {text_col: F.coalesce(clean, F.lit("")), **(counts if with_counts else {})})
