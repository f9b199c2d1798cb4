"""Order statistics of an ascending array column.

Missing readings are carried as NaN, which sorts last: the values are the first ``n``
entries and every expression is NULL when ``n`` is 0. Arrays without NULL elements sort
as plain doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positions(rule: str, q: float, n: Column) -> tuple[Column, Column, Column]:
    """Lower index, upper index and upper weight of a quantile rule over ``n`` values.

    ``median`` averages the two middle values, ``nearest`` rounds ``(n - 1) * q`` half
    up, ``linear`` interpolates at ``(n - 1) * q``.
    """
    if rule == "median":
        return F.floor((n - 1) / 2), F.floor(n / 2), F.lit(0.5)
    position = (n - 1) * F.lit(float(q))
    if rule == "nearest":
        index = F.floor(position + F.lit(0.5))
        return index, index, F.lit(0.0)
    if rule == "linear":
        return F.floor(position), F.ceil(position), position - F.floor(position)
    raise ValueError(f"unknown quantile rule: {rule}")


def blend(rule: str, low: Column, high: Column, weight: Column) -> Column:
    if rule == "median":
        return (low + high) / F.lit(2.0)
    if rule == "nearest":
        return low
    return low + (high - low) * weight


def reading(column: Column) -> Column:
    """Never-null double; NULL becomes NaN."""
    return F.coalesce(column.cast("double"), F.lit(float("nan")))


def n_readings(values: Column) -> Column:
    """Entries before the first NaN of a sorted array."""
    first_gap = F.array_position(values, float("nan"))
    return F.when(first_gap == 0, F.size(values)).otherwise(first_gap - 1)


def array_quantile(values: Column, n: Column, rule: str, q: float = 0.5) -> Column:
    """Quantile of a sorted array whose first ``n`` entries are readings."""
    low, high, weight = positions(rule, q, n)
    pick = lambda index: F.get(values, F.when(n > 0, index.cast("int")))
    return blend(rule, pick(low), pick(high), weight)
