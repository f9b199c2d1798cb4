"""Temporal composites and observation profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracover.functions.spectral import BANDS, INDICES
from terracover.operators.joins import lookup_join, null_safe_join
from terracover.operators.quantiles import group_quantiles
from terracover.operators.ranking import GROUP_LIMIT
from terracover.sources.staging import stage

CELL = ("zone", "r", "c")
FEATURES = (*BANDS, *INDICES)


def valid_observations(px: DataFrame, first_band: str = "b02", nodata: float = 0.0) -> DataFrame:
    """Rows whose first band differs from nodata; a ``valid`` column wins if present."""
    if "valid" in px.columns:
        return px.where("valid")
    return px.where(F.col(first_band) != F.lit(nodata))


def temporal_composite(
    obs: DataFrame, keys=CELL, bands=FEATURES, index: str = "ndvi", spread=(0.10, 0.90),
    rule: str = "nearest", limit: int = GROUP_LIMIT, at_most: DataFrame | None = None, together: bool = False,
) -> DataFrame:
    """Median of every band, low/high quantile and range of ``index``, and ``n_obs``.

    ``rule`` is the quantile rule of the spread: ``nearest`` (default) or ``linear``.
    ``at_most`` and ``together`` are passed on (see ``group_quantiles``).
    """
    bands = [b for b in bands if b in obs.columns]
    wanted = {f"{b}_med": (b, "median", 0.5) for b in bands}
    if index in bands:
        low, high = (f"{index}_p{round(q * 100)}" for q in spread)
        wanted[low] = (index, rule, spread[0])
        wanted[high] = (index, rule, spread[1])
    composite = group_quantiles(obs, keys, wanted, limit=limit, at_most=at_most, together=together)
    if index in bands:
        composite = composite.withColumn(f"{index}_range", F.col(high) - F.col(low))
    return composite


def index_quantiles(
    obs: DataFrame, keys=CELL, index: str = "ndvi", quantiles=(0.10, 0.25, 0.75, 0.90),
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Nearest-rank and linear quantiles of one index side by side."""
    wanted = {}
    for q in quantiles:
        wanted[f"{index}_p{round(q * 100)}"] = (index, "nearest", q)
        wanted[f"{index}_p{round(q * 100)}_linear"] = (index, "linear", q)
    return group_quantiles(obs, keys, wanted, limit=limit)


def composite_stats(obs: DataFrame, keys=CELL, bands=("ndvi", "ndwi")) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per group, combined map-side."""
    measures = [
        fn(b).alias(f"{b}_{name}")
        for b in bands
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    return obs.groupBy(*keys).agg(*measures, F.count(F.lit(1)).alias("n_obs"))


def requested_stats(
    obs: DataFrame, request: dict[str, tuple[str, ...]], keys=CELL, rule: str = "nearest", limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The statistics asked for by column, named ``<column>_<statistic>``, and ``n_obs``.

    Known are mean, std, min, max (combined map-side), median and ``p<percent>`` (by
    ``rule``). NULL and NaN readings are ignored. The parts meet by key only if both kinds
    are asked for.
    """
    plain = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    measures, wanted = [], {}
    for column, names in request.items():
        value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
        for name in names:
            if name in plain:
                measures.append(plain[name](value).alias(f"{column}_{name}"))
            elif name == "median":
                wanted[f"{column}_{name}"] = (column, "median", 0.5)
            elif name[0] == "p" and name[1:].isdigit() and int(name[1:]) <= 100:
                wanted[f"{column}_{name}"] = (column, rule, int(name[1:]) / 100)
            else:
                raise ValueError(f"unknown statistic: {name}")
    summed = obs.groupBy(*keys).agg(*measures, F.count(F.lit(1)).alias("n_obs"))
    if not wanted:
        return summed
    ranked = group_quantiles(obs, keys, wanted, limit=limit)
    return null_safe_join(summed.drop("n_obs"), ranked, keys) if measures else ranked


def with_window_start(obs: DataFrame, ts: str = "ts", width: str = "30 days") -> DataFrame:
    return obs.withColumn("window_start", F.window(ts, width).start)


def observation_profile(obs: DataFrame, keys=CELL, ts: str = "ts") -> DataFrame:
    """Rows, distinct dates and distinct pixels.

    Both distinct counts come from small pre-aggregates, so the rows are never expanded
    and never meet in one task.
    """
    per_pixel = obs.groupBy(*keys).count().agg(
        F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("n_pixels")
    )
    per_date = obs.select(F.to_date(ts).alias("d")).distinct().agg(F.count(F.lit(1)).alias("n_dates"))
    rows, dates = per_pixel.withColumn("k", F.lit(1)), per_date.withColumn("k", F.lit(1))
    return rows.join(dates, "k").select("n_rows", "n_dates", "n_pixels")


def support_profile(composite: DataFrame, group: Column | str = "zone") -> DataFrame:
    """Smallest, largest and mean number of observations per pixel."""
    return composite.groupBy(group).agg(
        F.min("n_obs").alias("min_obs"),
        F.max("n_obs").alias("max_obs"),
        F.avg("n_obs").alias("mean_obs"),
        F.count(F.lit(1)).alias("n_pixels"),
    )


def min_support(composite: DataFrame, min_obs: int = 3, min_pixels: int = 100) -> DataFrame:
    """Pixels with enough looks, in zones that keep enough such pixels."""
    supported = composite.where(F.col("n_obs") >= min_obs)
    zones = supported.groupBy("zone").count().where(F.col("count") >= min_pixels).select("zone")
    return lookup_join(supported, stage(zones, "supported_zones"), "zone", "left_semi")
