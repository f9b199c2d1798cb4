"""Grid addresses, product-name parsing and bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted latitude and longitude window.
LAT_RANGE = (-5.0, 15.0)
LON_RANGE = (-80.0, -66.0)



def pixel_center(origin: Column, step: Column, index: Column) -> Column:
    """Centre coordinate of a row or column."""
    return origin + step * (index + F.lit(0.5))


def grid_index(origin: Column, step: Column, coordinate: Column) -> Column:
    """Row or column holding a coordinate, not yet limited to the grid."""
    return F.floor((coordinate - origin) / step).cast("int")


def clamp_index(index: Column, size: Column) -> Column:
    return F.least(F.greatest(index, F.lit(0)), size - 1)


def acquisition_time(name: Column) -> Column:
    """Sensing time in a product name, else a leading yyyyMMdd, else NULL."""
    stamp = F.regexp_extract(name, r"_MSIL2A_(\d{8}T\d{6})_", 1)
    day = F.regexp_extract(name, r"^(\d{8})", 1)
    return F.when(stamp != "", F.to_timestamp_ntz(stamp, F.lit("yyyyMMdd'T'HHmmss"))).when(
        day != "", F.to_timestamp_ntz(day, F.lit("yyyyMMdd"))
    )


def tile_epsg(name: Column) -> Column:
    """UTM EPSG code of the tile in a product name; bands C-M are southern."""
    zone = F.regexp_extract(name, r"_T(\d{2})[A-Z]{3}_", 1)
    band = F.regexp_extract(name, r"_T\d{2}([A-Z])[A-Z]{2}_", 1)
    return F.when(zone != "", F.concat(F.when(band < "N", "EPSG:327").otherwise("EPSG:326"), zone))


def bounds_check(left: Column, bottom: Column, right: Column, top: Column,
                 lat_range=LAT_RANGE, lon_range=LON_RANGE) -> Column:
    """Struct ``(lat_valid, lon_valid, valid)`` for a geographic bounding box."""
    lat = (bottom >= lat_range[0]) & (top <= lat_range[1])
    lon = (left >= lon_range[0]) & (right <= lon_range[1])
    return F.struct(lat.alias("lat_valid"), lon.alias("lon_valid"), (lat & lon).alias("valid"))
