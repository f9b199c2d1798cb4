"""Reproducible hash keys: the same rows get the same bucket on any file layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(seed: int, *keys: str) -> Column:
    """md5 hex digest of ``<seed>-<key>-<key>...``; a NULL key counts as a mark of its own."""
    parts = (F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys)
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *parts))


def digest_bucket(digest: Column, digits: int = 6) -> Column:
    """Leading hex digits as a number in ``[0, 16**digits)``."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def unit_interval(digest: Column) -> Column:
    """Leading six hex digits mapped to [0, 1)."""
    return digest_bucket(digest) / F.lit(float(16**6))
