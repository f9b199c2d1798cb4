"""UTM to and from geographic coordinates as column arithmetic.

Transverse Mercator series of Snyder (1987), equations 8-9 to 8-25. Shared terms are
columns of their own, so each is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid and UTM parameters.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_EASTING = 500000.0
UTM_NORTHING_SOUTH = 10000000.0

E2 = WGS84_F * (2 - WGS84_F)
EP2 = E2 / (1 - E2)
E1 = (1 - (1 - E2) ** 0.5) / (1 + (1 - E2) ** 0.5)

# Meridian distance over WGS84_A: coefficients of phi, sin 2phi, sin 4phi, sin 6phi.
MERIDIAN = (
    1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256,
    -(3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024),
    15 * E2**2 / 256 + 45 * E2**3 / 1024,
    -(35 * E2**3 / 3072),
)
# Footpoint latitude: coefficients of sin 2mu, sin 4mu, sin 6mu, sin 8mu.
FOOTPOINT = (
    3 * E1 / 2 - 27 * E1**3 / 32,
    21 * E1**2 / 16 - 55 * E1**4 / 32,
    151 * E1**3 / 96,
    1097 * E1**4 / 512,
)


def _false_north():
    return F.when(F.col("south"), F.lit(UTM_NORTHING_SOUTH)).otherwise(F.lit(0.0))


def _central_meridian():
    return F.col("utm_zone") * 6 - 183


def with_utm(df: DataFrame, lon: str, lat: str, east: str = "east", north: str = "north") -> DataFrame:
    """Add easting and northing in the row's ``utm_zone`` / ``south``."""
    terms = (
        df.withColumns({"_phi": F.radians(lat), "_lam": F.radians(F.col(lon) - _central_meridian())})
        .withColumns({"_sin": F.sin("_phi"), "_cos": F.cos("_phi"), "_tan": F.tan("_phi")})
        .withColumns({
            "_n": WGS84_A / F.sqrt(1 - E2 * F.col("_sin") * F.col("_sin")),
            "_t": F.col("_tan") * F.col("_tan"),
            "_c": EP2 * F.col("_cos") * F.col("_cos"),
            "_a": F.col("_cos") * F.col("_lam"),
            "_m": WGS84_A * (
                MERIDIAN[0] * F.col("_phi")
                + sum(MERIDIAN[k] * F.sin(2 * k * F.col("_phi")) for k in (1, 2, 3))
            ),
        })
        .withColumn("_a2", F.col("_a") * F.col("_a"))
    )
    n, t, c, a, a2 = (F.col(x) for x in ("_n", "_t", "_c", "_a", "_a2"))
    easting = UTM_EASTING + UTM_K0 * n * a * (
        1 + a2 * ((1 - t + c) / 6 + a2 * (5 - 18 * t + t * t + 72 * c - 58 * EP2) / 120)
    )
    arc = a2 * (
        0.5 + a2 * ((5 - t + 9 * c + 4 * c * c) / 24
                    + a2 * (61 - 58 * t + t * t + 600 * c - 330 * EP2) / 720)
    )
    northing = UTM_K0 * (F.col("_m") + n * F.col("_tan") * arc) + _false_north()
    return terms.withColumns({east: easting, north: northing}).select(*df.columns, east, north)


def with_lonlat(df: DataFrame, east: str, north: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add longitude and latitude (degrees) of UTM coordinates."""
    terms = (
        df.withColumn("_mu", (F.col(north) - _false_north()) / (UTM_K0 * WGS84_A * MERIDIAN[0]))
        .withColumn(
            "_phi",
            F.col("_mu") + sum(f * F.sin(2 * k * F.col("_mu")) for k, f in enumerate(FOOTPOINT, 1)),
        )
        .withColumns({"_sin": F.sin("_phi"), "_cos": F.cos("_phi"), "_tan": F.tan("_phi")})
        .withColumn("_w", 1 - E2 * F.col("_sin") * F.col("_sin"))
        .withColumns({
            "_c": EP2 * F.col("_cos") * F.col("_cos"),
            "_t": F.col("_tan") * F.col("_tan"),
            "_n": WGS84_A / F.sqrt("_w"),
            "_r": WGS84_A * (1 - E2) / (F.col("_w") * F.sqrt("_w")),
        })
        .withColumn("_d", (F.col(east) - UTM_EASTING) / (F.col("_n") * UTM_K0))
        .withColumn("_d2", F.col("_d") * F.col("_d"))
    )
    c, t, d, d2 = (F.col(x) for x in ("_c", "_t", "_d", "_d2"))
    bend = d2 * (
        0.5 - d2 * ((5 + 3 * t + 10 * c - 4 * c * c - 9 * EP2) / 24
                    - d2 * (61 + 90 * t + 298 * c + 45 * t * t - 252 * EP2 - 3 * c * c) / 720)
    )
    latitude = F.col("_phi") - F.col("_n") * F.col("_tan") / F.col("_r") * bend
    turn = d * (
        1 - d2 * ((1 + 2 * t + c) / 6
                  - d2 * (5 - 2 * c + 28 * t - 3 * c * c + 8 * EP2 + 24 * t * t) / 120)
    ) / F.col("_cos")
    return terms.withColumns(
        {lon: F.degrees(turn) + _central_meridian(), lat: F.degrees(latitude)}
    ).select(*df.columns, lon, lat)
