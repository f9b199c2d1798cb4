import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from terracover.functions import grades, grid, spectral
from terracover.functions.ordered import array_quantile, n_readings
from terracover.operators.projection import with_lonlat, with_utm


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_reflectance_is_scaled_and_clipped(spark):
    rows = spark.createDataFrame([(-5.0,), (0.0,), (10000.0,), (12000.0,)], "dn double")
    assert [r[0] for r in rows.select(spectral.reflectance(F.col("dn"))).collect()] == [0.0, 0.0, 1.0, 1.0]


def test_indices_on_zero_denominator_and_range(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (0.6, 0.2), (0.0, 0.5)], "b8a double, b04 double")
    values = [r["ndvi"] for r in spectral.with_indices(rows).collect()]
    assert values[0] == 0.0 and math.isclose(values[1], 0.5) and values[2] == -1.0


def test_index_needs_both_bands(spark):
    rows = spark.createDataFrame([(0.5,)], "b8a double")
    assert spectral.with_indices(rows).columns == ["b8a"]


@pytest.mark.parametrize("name, expected", [
    ("S2A_MSIL2A_20200112T153621_N0500_R025_T18NWL_20200112T153621", dt.datetime(2020, 1, 12, 15, 36, 21)),
    ("20200112_scene", dt.datetime(2020, 1, 12)),
    ("no_date", None),
])
def test_acquisition_time(spark, name, expected):
    assert one(spark, grid.acquisition_time(F.lit(name)))[0] == expected


@pytest.mark.parametrize("name, expected", [
    ("S2A_x_T18NWL_y", "EPSG:32618"), ("S2A_x_T18LWL_y", "EPSG:32718"), ("S2A_x", None),
])
def test_tile_epsg(spark, name, expected):
    assert one(spark, grid.tile_epsg(F.lit(name)))[0] == expected


@pytest.mark.parametrize("issues, expected", [
    ([], None), (["crs_mismatch"], "crs_mismatch"), (["bounds_invalid"], "bounds_invalid"),
    (["crs_mismatch", "bounds_invalid"], "multiple_issues"), (["crs_mismatch", "no_overlap"], "no_overlap"),
    (["clip_error"], "multiple_issues"),
])
def test_issue_type(spark, issues, expected):
    rows = spark.createDataFrame([(issues,)], "issues array<string>")
    assert rows.select(grades.issue_type(F.col("issues"))).first()[0] == expected


@pytest.mark.parametrize("pos, neg, label, training", [
    (1, 11, "significant", "significant"), (1, 4, "moderate", "reasonable"), (2, 2, "reasonable", "reasonable"),
    (11, 1, "reasonable", "significant"), (0, 5, None, None),
])
def test_balance_grades(spark, pos, neg, label, training):
    row = one(spark, grades.label_balance(F.lit(pos), F.lit(neg)), grades.training_balance(F.lit(pos), F.lit(neg)))
    assert tuple(row) == (label, training)


def test_bounds_check(spark):
    row = one(spark, grid.bounds_check(*map(F.lit, (-75.0, 4.0, -74.0, 16.0))).alias("b"))["b"]
    assert (row.lat_valid, row.lon_valid, row.valid) == (False, True, False)


@pytest.mark.parametrize("values, median, nearest, linear", [
    ([3.0], 3.0, 3.0, 3.0), ([1.0, 2.0], 1.5, 1.0, 1.1), ([1.0, 2.0, 4.0, 8.0, 16.0, 32.0], 6.0, 2.0, 1.5),
    ([1.0, float("nan")], 1.0, 1.0, 1.0), ([float("nan")], None, None, None),
])
def test_quantile_rules(spark, values, median, nearest, linear):
    rows = spark.createDataFrame([(values,)], "v array<double>").withColumn("n", n_readings(F.col("v")))
    got = rows.select(
        array_quantile(F.col("v"), F.col("n"), "median"),
        array_quantile(F.col("v"), F.col("n"), "nearest", 0.1),
        array_quantile(F.col("v"), F.col("n"), "linear", 0.1),
    ).first()
    assert tuple(got) == pytest.approx((median, nearest, linear)) if median is not None else tuple(got) == (None,) * 3


def test_utm_known_point_and_round_trip(spark):
    # Published example: the CN Tower, 43 38 33.24 N 79 23 13.7 W, is 17T 630084 4833438.
    rows = spark.createDataFrame(
        [(-79.387139, 43.642567, 17, False), (-73.2, 4.6, 18, False), (-72.9, -3.1, 18, True)],
        "x double, y double, utm_zone int, south boolean",
    )
    got = with_lonlat(with_utm(rows, "x", "y"), "east", "north").collect()
    assert got[0].east == pytest.approx(630084, abs=1) and got[0].north == pytest.approx(4833438, abs=1)
    for row in got:
        assert row.lon == pytest.approx(row.x, abs=1e-7) and row.lat == pytest.approx(row.y, abs=1e-7)
    assert got[2].north > 9_000_000
