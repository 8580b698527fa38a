from __future__ import annotations

import json
from pathlib import Path

import pytest

from pointloom.operators import assemble
from pointloom.sources import preview, read_metrics, read_points, write_metrics, write_results


@pytest.mark.parametrize(
    ("text", "schema", "rows"),
    [
        ("x,y,z\n1,2.5,a\n", "x int, y double, z string", [(1, 2.5, "a")]),
        ("x,y\n1\n2,3,4\n5,\n", "x int, y int", [(1, None), (2, 3), (5, None)]),
        ("x\n1\nabc\n", "x string", [("1",), ("abc",)]),
        ("x, y\n1,2\n", "x int, ` y` int", [(1, 2)]),
        ("x,x\n1,2\n", "x0 int, x1 int", [(1, 2)]),
        ("b,n\ntrue,3000000000\n", "b boolean, n bigint", [(True, 3000000000)]),
        ("x,y\n", "x string, y string", []),
    ],
)
def test_csv_scan(spark, write_csv, text, schema, rows):
    df = read_points(spark, write_csv(text))
    assert df.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    assert [tuple(r) for r in df.collect()] == rows


def test_empty_file_has_no_columns(spark, write_csv):
    assert read_points(spark, write_csv("")).columns == []


def test_given_schema_starts_no_job(spark, write_csv):
    path = write_csv("x,y\n1,2\n")
    spark.sparkContext.setJobGroup("scan", "scan")
    df = read_points(spark, path, "x double, y double")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("scan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == [] and df.first() == (1.0, 2.0)


def test_parquet_scan_and_folder_of_files(spark, tmp_path):
    spark.range(0, 10, 1, 3).selectExpr("id", "id * 1.5D AS x").write.parquet(f"{tmp_path}/p")
    spark.range(0, 10, 1, 3).selectExpr("id", "id * 1.5D AS x").write.csv(f"{tmp_path}/c", header=True)
    parquet = read_points(spark, f"{tmp_path}/p", file_format="parquet")
    assert sorted(parquet.collect()) == sorted(read_points(spark, f"{tmp_path}/c").collect())


def test_results_are_written_by_the_executors(spark, tmp_path):
    df = assemble(spark.range(0, 100, 1, 4).selectExpr("id", "id / 3 AS a"), ["a"])
    path = write_results(df, f"{tmp_path}/fresh/out")
    assert len(list(Path(path).glob("part-*.csv"))) == 4
    back = read_points(spark, path)
    assert back.columns == ["id", "a"]
    assert sorted(back.collect()) == sorted(df.select("id", "a").collect())
    write_results(df.filter("id < 5"), f"{tmp_path}/fresh/out")
    assert read_points(spark, path).count() == 5


def test_only_vectors_are_left_out_of_results(spark, tmp_path):
    df = assemble(spark.sql("SELECT 1 AS Features, 2 AS b, 3 AS `a.b`"), ["b"], "v")
    assert read_points(spark, write_results(df, str(tmp_path))).columns == ["Features", "b", "a.b"]


def test_results_without_rows_keep_their_header(spark, tmp_path):
    path = write_results(spark.range(0).selectExpr("id", "1 AS cluster"), str(tmp_path))
    assert read_points(spark, path).columns == ["id", "cluster"]


@pytest.mark.parametrize("score", [0.9975246759932097, -0.25, 0.0])
def test_metrics(spark, tmp_path, score):
    path = write_metrics(spark, score, str(tmp_path))
    (part,) = Path(path).glob("part-*")
    assert json.loads(part.read_text()) == {"silhouette_score": score}
    assert read_metrics(spark, str(tmp_path)).collect() == [(score,)]


def test_undefined_score_replaces_an_earlier_one(spark, tmp_path):
    write_metrics(spark, 0.5, str(tmp_path))
    write_metrics(spark, None, str(tmp_path))
    assert read_metrics(spark, str(tmp_path)).collect() == [(None,)]


def test_missing_or_unreadable_metrics(spark, tmp_path):
    assert read_metrics(spark, f"{tmp_path}/none").collect() == [(None,)]
    (tmp_path / "metrics.json").write_text("not json")
    assert read_metrics(spark, str(tmp_path)).collect() == [(None,)]
    (tmp_path / "metrics.json").write_text('{"silhouette_score": 0.5}')
    assert read_metrics(spark, str(tmp_path)).collect() == [(0.5,)]


def test_preview(spark):
    df = spark.range(0, 100, 1, 4)
    assert preview(df).count() == 5
    assert [r[0] for r in preview(df, 3, ["id"]).collect()] == [0, 1, 2]
