"""Text rules shared by the operators: what a word is, ASCII folding, row keys.

A word is a run of characters other than U+0020 and U+0009..U+000D. Folding changes A-Z
only. Python helpers work on UTF-8 bytes, whose ``split``, ``strip`` and ``lower`` follow
exactly these ASCII rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def words_of(text: str | None, fold: bool) -> list[bytes]:
    """Words of one text as UTF-8 bytes; none for a null text."""
    if not text:
        return []
    raw = text.encode()
    return (raw.lower() if fold else raw).split()


def word_array(text: Column) -> Column:
    """Words of a text column as an array; empty for null or blank texts."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare != "", F.split(bare, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def row_key(*columns: Column) -> Column:
    """128-bit key of a row's values; nulls and empty strings differ.

    Rows with equal values share a key. Every decision made on the key is a function of
    these values, so equal rows get equal decisions and nothing depends on row numbers,
    which a recomputed task could deal differently.
    """
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def packed(docs: DataFrame) -> Column:
    """The whole input row as one struct, so that its names cannot clash with working columns."""
    return F.struct(*[docs[f"`{c.replace('`', '``')}`"] for c in docs.columns])


def unpacked(df: DataFrame, columns: list[str], replace: dict[str, Column]) -> DataFrame:
    """Columns of the struct ``row``; ``replace`` overrides equal names (ignoring case) and adds the rest."""
    left = {name.lower(): (name, c) for name, c in replace.items()}
    out = []
    for name in columns:
        hit = left.pop(name.lower(), None)
        out.append(hit[1].alias(name) if hit else F.col("row").getField(name).alias(name))
    return df.select(*out, *[c.alias(name) for name, c in left.values()])


def rows_in_chunks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, each of about ``most`` bytes of ``column`` or a single row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
