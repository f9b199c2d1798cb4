"""Join forms whose physical shape does not depend on size estimates.

Spark's estimates ignore how far ``explode`` multiplies rows, so a grid unfolded from a
tiny extent table looks small enough to broadcast. Side tables are therefore counted, and
joins between large tables ask for a sort-merge join, which AQE splits where it is skewed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows and bytes of a side table that may be broadcast.
LOOKUP_ROWS, LOOKUP_BYTES = 500_000, 64 << 20


def stored_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table: texts are measured, numbers count 8 bytes, anything nested its JSON."""
    fixed, measured = 16, []
    for f in df.schema:
        kind, column = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            measured.append(F.octet_length(column))
        elif kind in ("array", "map", "struct"):
            measured.append(F.octet_length(F.to_json(F.struct(column))))
        else:
            fixed += 8
    one = reduce(lambda a, b: a + b, (F.coalesce(m, F.lit(0)).cast("bigint") for m in measured), F.lit(fixed))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(one), F.lit(0))).first()
    return rows, size


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = LOOKUP_ROWS,
                null_safe: bool = False) -> DataFrame:
    """Join a side table: broadcast when its counted rows allow, else sort-merge.

    ``small`` should be a stored table: its rows and bytes are counted first, which reads
    its columns of text only. With ``null_safe`` NULL keys match each other.
    """
    rows, size = stored_size(small)
    side = F.broadcast(small) if rows <= max_rows and size <= LOOKUP_BYTES else small.hint("merge")
    return null_safe_join(big, side, on, how) if null_safe else big.join(side, on, how)


def null_safe_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the result has the left side's keys once."""
    keys = [on] if isinstance(on, str) else list(on)
    other = right.withColumnsRenamed({k: f"{k}__other" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}__other")) for k in keys))
    joined = left.join(other, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"{k}__other" for k in keys))


def large_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join two tables that both grow with the data."""
    return left.join(right.hint("merge"), on, how)
