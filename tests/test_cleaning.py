from __future__ import annotations

from conftest import plan_of
from pointloom.operators import drop_incomplete
from pointloom.sources import read_points

DIRTY = "x,y,z\n1,2,3\n4,5\n7,8,9,10\nNaN,1,1\n,2,3\n"


def test_dirty_csv(spark, write_csv):
    rows = drop_incomplete(read_points(spark, write_csv(DIRTY))).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2, 3), (7.0, 8, 9)]


def test_null_in_any_column_drops_the_row(spark, write_csv):
    path = write_csv("x,y,z,note\n1,2,3,a\n1,2,3,\n")
    assert drop_incomplete(read_points(spark, path)).count() == 1


def test_same_rows_as_na_drop(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, CAST('NaN' AS DOUBLE), 'a', CAST(1 AS FLOAT), true), "
        "(2, 1.0, null, 1, false), (3, 1.0, 'NaN', CAST('NaN' AS FLOAT), false), "
        "(4, 1.0, 'NaN', 2, null), (5, 1.0, '', 3, true) AS t(`i d`, d, s, f, b)"
    )
    assert drop_incomplete(df).collect() == df.na.drop("any").collect()
    assert [r[0] for r in drop_incomplete(df).collect()] == [5]


def test_table_without_columns(spark):
    empty = spark.createDataFrame([], "struct<>")
    assert drop_incomplete(empty).columns == []


def test_null_checks_reach_the_scan(spark, sf_dir):
    plan = plan_of(drop_incomplete(spark.read.parquet(f"{sf_dir}/customer.parquet")))
    assert "PushedFilters: [IsNotNull(c_custkey), IsNotNull(c_name)" in plan


def test_any_column_name(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1.0D), (null, 1.0D), (3, null) AS t(`d.d`, `s``s`)")
    assert [r[0] for r in drop_incomplete(df).collect()] == [1]
