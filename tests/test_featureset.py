from __future__ import annotations

import pytest

from pointloom.operators import add_features, choose_features


def table(spark, ddl: str):
    return spark.createDataFrame([], ddl)


@pytest.mark.parametrize(
    ("ddl", "kind", "columns"),
    [
        ("x double, y double, z double", "cloud", "x y z magnitude"),
        ("z int, intensity double, y bigint, x decimal(9,0)", "cloud", "x y z magnitude intensity"),
        ("lat double, lon double", "geo", "distance_to_center_km"),
        ("lat double, elevation int, lon double", "geo", "distance_to_center_km elevation"),
        ("lat double, lon double, x double, y double, z double", "cloud", "x y z magnitude"),
        ("X double, Y double, Z double", "numeric", "X Y Z"),
        ("Lat double, Lon double", "numeric", "Lat Lon"),
        ("x double, y double", "numeric", "x y"),
        (
            "id int, big bigint, f double, g float, d decimal(9,2), b boolean, s string, "
            "dt date, ts timestamp",
            "numeric",
            "id f g",
        ),
    ],
)
def test_choice(spark, ddl, kind, columns):
    chosen = choose_features(table(spark, ddl))
    assert (chosen.kind, list(chosen.columns)) == (kind, columns.split())


@pytest.mark.parametrize("ddl", ["s string", "big bigint, s string", "struct<>"])
def test_no_feature_columns(spark, ddl):
    with pytest.raises(ValueError, match="no feature columns"):
        choose_features(table(spark, ddl))


@pytest.mark.parametrize(
    ("ddl", "bad"),
    [
        ("x string, y double, z double", "x"),
        ("lat double, lon string", "lon"),
        ("x int, y int, z int, intensity string", "intensity"),
    ],
)
def test_text_where_a_number_belongs(spark, ddl, bad):
    with pytest.raises(ValueError, match=f"must be numeric: {bad} "):
        choose_features(table(spark, ddl))


def test_fallback_types_are_a_parameter(spark):
    df = table(spark, "id int, big bigint, f double")
    assert choose_features(df, ("bigint", "double")).columns == ("big", "f")


def test_derived_column_is_appended_or_replaced(spark):
    df = spark.sql("SELECT 2.0D AS x, 3.0D AS y, 6.0D AS z, 'old' AS magnitude, 1 AS w")
    out = add_features(df, choose_features(df))
    assert out.columns == ["x", "y", "z", "magnitude", "w"]
    assert out.first()["magnitude"] == 7.0
    geo = spark.sql("SELECT 0.0D AS lat, 0.0D AS lon, 'a' AS name")
    out = add_features(geo, choose_features(geo), (0.0, 180.0))
    assert out.columns == ["lat", "lon", "name", "distance_to_center_km"]
