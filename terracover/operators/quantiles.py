"""Exact grouped quantiles.

Two routes give the same numbers. Groups of bounded size gather their rows once and
read every order statistic from sorted arrays. Larger groups are reduced to value
counts first (combined map-side) and the wanted ranks are found on running totals, so a
single hot key never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.functions.ordered import array_quantile, blend, n_readings, positions, reading
from terracover.operators.joins import lookup_join, null_safe_join
from terracover.operators.ranking import GROUP_LIMIT, heavy_groups, running_totals

# (rule, q) pairs, see terracover.functions.ordered.positions
MEDIAN = ("median", 0.5)

# Readings of one gathered group. Spark gathers at most 128 groups by hash in a task before
# it sorts instead, so a task holds at most 512 MB of them.
GROUP_BYTES = 4 << 20


def histogram_quantiles(
    hist: DataFrame, keys, value: str, weight: str, wanted: dict[str, tuple[str, float]],
    limit: int = GROUP_LIMIT, bounded: bool = False,
) -> DataFrame:
    """Quantiles per ``keys`` from one row per ``(keys, value)`` with count ``weight``.

    NULL and NaN values are ignored. ``bounded`` states that no group exceeds ``limit``.
    """
    readings = hist.where(F.col(value).isNotNull() & ~F.isnan(value))
    totals = running_totals(readings, keys, value, [weight], limit=limit, bounded=bounded)
    cum, n = F.col(f"cum_{weight}"), F.col(f"total_{weight}")
    picks, outputs = [], []
    for name, (rule, q) in wanted.items():
        low, high, frac = positions(rule, q, n)
        for side, index in (("low", low), ("high", high)):
            holds = (cum - F.col(weight) <= index) & (index < cum)
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"{name}_{side}"))
        picks.append(F.max(frac).alias(f"{name}_frac"))
        outputs.append(
            blend(rule, *(F.col(f"{name}_{part}") for part in ("low", "high", "frac"))).alias(name)
        )
    return totals.groupBy(*keys).agg(*picks).select(*keys, *outputs)


def _gathered(df, keys, wanted, count_name, together=False):
    columns = sorted({column for column, _, _ in wanted.values()})
    # Gathering does not shrink rows, so they are shuffled flat and gathered once.
    looks = (df if together else df.repartition(*keys)).groupBy(*keys).agg(
        F.collect_list(F.struct(*(reading(F.col(c)).alias(c) for c in columns))).alias("looks")
    )
    # One array per column, handled by one lambda per rule: code generated per column
    # would outgrow what the JVM compiles.
    series = F.array(*(F.col("looks").getField(c) for c in columns))
    ordered = looks.select(
        *keys, F.size("looks").cast("bigint").alias(count_name),
        F.transform(series, lambda v: F.sort_array(v)).alias("series"),
    ).withColumn("filled", F.transform("series", n_readings))
    slot, picked = {c: i for i, c in enumerate(columns)}, {}
    for i, (rule, q) in enumerate(sorted({(rule, q) for _, rule, q in wanted.values()})):
        members = sorted({c for c, *pair in wanted.values() if tuple(pair) == (rule, q)})
        subset = lambda name: F.array(*(F.get(name, F.lit(slot[c])) for c in members))
        ordered = ordered.withColumn(
            f"rule_{i}",
            F.zip_with(subset("series"), subset("filled"), lambda v, n: array_quantile(v, n, rule, q)),
        )
        for name, (c, *pair) in wanted.items():
            if tuple(pair) == (rule, q):
                picked[name] = F.get(f"rule_{i}", F.lit(members.index(c))).alias(name)
    return ordered.select(*keys, *(picked[name] for name in wanted), count_name)


def _counted(df, keys, wanted, count_name, limit):
    columns = sorted({column for column, _, _ in wanted.values()})
    rules = sorted({(rule, q) for _, rule, q in wanted.values()})
    slot = {pair: f"q{i}" for i, pair in enumerate(rules)}
    hist = (
        df.unpivot(list(keys), columns, "measure", "reading")
        .groupBy(*keys, "measure", "reading")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    per_measure = histogram_quantiles(
        hist, [*keys, "measure"], "reading", "weight", {slot[p]: p for p in rules}, limit
    )
    quantiles = per_measure.groupBy(*keys).agg(
        *(
            F.max(F.when(F.col("measure") == c, F.col(slot[rule, q]))).alias(name)
            for name, (c, rule, q) in wanted.items()
        )
    )
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    return null_safe_join(counts, quantiles, keys, "left").select(*keys, *wanted, count_name)


def group_quantiles(
    df: DataFrame, keys, wanted: dict[str, tuple[str, str, float]],
    count_name: str = "n_obs", limit: int = GROUP_LIMIT, at_most: DataFrame | None = None, together: bool = False,
) -> DataFrame:
    """``wanted`` maps an output name to ``(column, rule, q)``; adds the row count.

    NULL and NaN readings are ignored by the quantiles and counted in ``count_name``.
    ``at_most`` may name a cheaper table with at least the rows of ``df`` per key, on
    which group sizes are checked (e.g. ``df`` before an expensive filter). Readings
    become doubles before the route is chosen, and NULL keys are groups like any other, so
    ``limit`` never changes a result. A gathered group holds at most ``GROUP_BYTES``.
    ``together`` says that the rows of a key are in one partition already (stored buckets).
    """
    keys = list(keys)
    columns = sorted({column for column, _, _ in wanted.values()})
    df = df.select(*keys, *(F.col(c).cast("double").alias(c) for c in columns))
    limit = min(limit, GROUP_BYTES // (16 + 8 * len(columns)))
    heavy = heavy_groups(df if at_most is None else at_most, keys, limit)
    if heavy is None:
        return _gathered(df, keys, wanted, count_name, together)
    usual = _gathered(lookup_join(df, heavy, keys, "left_anti", null_safe=True), keys, wanted, count_name)
    hot = _counted(lookup_join(df, heavy, keys, "left_semi", null_safe=True), keys, wanted, count_name, limit)
    return usual.unionByName(hot)
