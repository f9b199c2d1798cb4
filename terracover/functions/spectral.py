"""Reflectance scaling and spectral indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default band set and the digital-number scale of the product.
BANDS = ("b02", "b03", "b04", "b05", "b06", "b07", "b8a", "b11", "b12")
DN_SCALE = 1e4

INDICES = ("ndvi", "ndwi")


def reflectance(dn: Column) -> Column:
    """Digital number to reflectance, clipped to [0, 1]."""
    return F.least(F.greatest(dn / F.lit(DN_SCALE), F.lit(0.0)), F.lit(1.0))


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` with 0 for a zero denominator and for NaN; NULL stays NULL."""
    return F.when(den == 0, F.lit(0.0)).otherwise(F.nanvl(num / den, F.lit(0.0)))


def normalized_difference(a: Column, b: Column) -> Column:
    return guarded_ratio(a - b, a + b)


def ndvi(nir: Column, red: Column) -> Column:
    return normalized_difference(nir, red)


def ndwi(green: Column, nir: Column) -> Column:
    return normalized_difference(green, nir)


def ndmi(nir: Column, swir1: Column) -> Column:
    return normalized_difference(nir, swir1)


def ndbi(swir1: Column, nir: Column) -> Column:
    return normalized_difference(swir1, nir)


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return guarded_ratio(F.lit(2.5) * (nir - red), nir + 6.0 * red - 7.5 * blue + 1.0)


def savi(nir: Column, red: Column) -> Column:
    return guarded_ratio(F.lit(1.5) * (nir - red), nir + red + 0.5)


def scale_bands(df: DataFrame, bands=BANDS, prefix: str = "dn_") -> DataFrame:
    """Replace every ``dn_<band>`` column present by its reflectance ``<band>``."""
    present = [b for b in bands if prefix + b in df.columns]
    keep = [c for c in df.columns if c not in {prefix + b for b in present}]
    return df.select(*keep, *(reflectance(F.col(prefix + b)).alias(b) for b in present))


def with_indices(df: DataFrame, indices=INDICES) -> DataFrame:
    """Add each requested index whose input bands exist; others are left out."""
    inputs = {
        "ndvi": (ndvi, ("b8a", "b04")),
        "ndwi": (ndwi, ("b03", "b8a")),
        "ndmi": (ndmi, ("b8a", "b11")),
        "ndbi": (ndbi, ("b11", "b8a")),
        "evi": (evi, ("b8a", "b04", "b02")),
        "savi": (savi, ("b8a", "b04")),
    }
    added = {
        name: fn(*map(F.col, bands))
        for name, (fn, bands) in inputs.items()
        if name in indices and all(b in df.columns for b in bands)
    }
    return df.withColumns(added) if added else df
