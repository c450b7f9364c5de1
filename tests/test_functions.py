import math

from pyspark.sql import functions as F

from affinity.functions import color_position, color_stop, great_circle_km, in_box, safe_ln
from affinity.functions.geo import EARTH_RADIUS_KM


def test_great_circle_known_values(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0), (40.0, -75.0, 40.0, -75.0), (10.0, 20.0, -10.0, 20.0),
                                (40.7128, -74.0060, 34.0522, -118.2437)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(great_circle_km("a", "b", "c", "d")).collect()]
    assert math.isclose(got[0], math.pi / 2 * EARTH_RADIUS_KM, rel_tol=1e-12)
    assert 0.0 <= got[1] < 1e-3  # clamped, never NaN; the cosine formula is coarse near 0
    assert math.isclose(got[2], math.radians(20) * EARTH_RADIUS_KM, rel_tol=1e-12)
    assert 3900 < got[3] < 4000  # New York - Los Angeles


def test_box_is_strict_and_null_fails(spark):
    df = spark.createDataFrame([(-60.0, 30.0), (-60.5, 30.0), (-100.0, 20.0), (-100.0, 20.01), (None, 30.0)],
                               "lon double, lat double")
    got = [r[0] for r in df.select(in_box("lon", "lat")).collect()]
    assert got == [False, True, False, True, None]
    assert df.where(in_box("lon", "lat")).count() == 2


def test_safe_ln_drops_non_positive(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (math.e,)], "x double")
    assert [r[0] for r in df.select(safe_ln("x")).collect()] == [None, None, 1.0]


def test_color_scale(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (500.0,), (1000.0,), (55000.0,), (100000.0,), (1e7,)], "v double")
    got = [tuple(r) for r in df.select(color_stop("v"), F.round(color_position("v"), 6)).collect()]
    assert got == [(0, 0.0), (0, 0.0), (0, 0.5), (1, 0.0), (2, 0.5), (3, 1.0), (3, 1.0)]
