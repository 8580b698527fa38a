from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from pointloom.functions import haversine_km, magnitude, squared_distance

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
lat = st.floats(-90, 90)
lon = st.floats(-180, 180)


def distances(spark, points, ref):
    df = spark.createDataFrame(points, "lat double, lon double")
    return [r[0] for r in df.select(haversine_km("lat", "lon", *ref)).collect()]


def test_known_distances(spark):
    got = distances(spark, [(34.0522, -118.2437), (0.0, 0.0)], (34.0522, -118.2437))
    assert got == pytest.approx([0.0, 12574.353209790605], abs=1e-9)
    assert distances(spark, [(40.7128, -74.0060)], (34.0522, -118.2437)) == pytest.approx(
        [3935.746254609723], abs=1e-9
    )


def test_antipodes_and_poles_are_defined(spark):
    half = math.pi * 6371
    got = distances(spark, [(0.0, 180.0), (90.0, 12.0), (-90.0, -12.0)], (0.0, 0.0))
    assert got == pytest.approx([half, half / 2, half / 2])


def test_what_is_no_number_stays_so(spark):
    nan, inf = float("nan"), float("inf")
    got = distances(spark, [(nan, 1.0), (1.0, nan), (inf, 1.0), (1.0, -inf)], (0.0, 0.0))
    assert all(math.isnan(d) for d in got)


@few
@given(points=st.lists(st.tuples(lat, lon), min_size=1, max_size=30), ref=st.tuples(lat, lon))
def test_distance_is_bounded_and_symmetric(spark, points, ref):
    there = distances(spark, points, ref)
    assert all(0 <= d <= math.pi * 6371 + 1e-6 for d in there)
    back = distances(spark, [ref], points[0])
    assert back[0] == pytest.approx(there[0], abs=1e-6)


@few
@given(points=st.lists(st.tuples(*[st.floats(-1e6, 1e6)] * 3), min_size=1, max_size=30))
def test_magnitude(spark, points):
    df = spark.createDataFrame(points, "x double, y double, z double")
    got = [r[0] for r in df.select(magnitude()).collect()]
    assert got == pytest.approx([math.sqrt(x * x + y * y + z * z) for x, y, z in points])


def test_magnitude_takes_any_numbers_and_names(spark):
    df = spark.sql("SELECT 2 AS `a.b`, 3L AS `c``d`, CAST(6 AS DECIMAL(5, 0)) AS e")
    assert df.select(magnitude("a.b", "c`d", "e")).first()[0] == 7.0


def test_squared_distance(spark):
    df = spark.sql("SELECT 1.0D AS a, 2.0D AS b")
    assert df.select(squared_distance(["a", "b"], [4, 6])).first()[0] == 25.0


def test_expressions_stay_in_generated_code(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        (F.col("c_custkey") % 90).alias("lat"), (F.col("c_custkey") % 180).alias("lon")
    )
    plan = plan_of(df.select(haversine_km("lat", "lon", 34.0522, -118.2437).alias("km")))
    assert "Python" not in plan and "*(1) Project" in plan
    assert "RADIANS(34" not in plan, "the reference point is folded at planning time"
