from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE, SAMPLE_CENTERS, SAMPLE_SCORE, plan_of
from pointloom import run_job
from pointloom.operators import canonical_ids
from pointloom.plans import inputs
from pointloom.session import scratch_dir
from pointloom.sources import read_metrics, read_points


def test_point_cloud(spark, sample, tmp_path):
    job = run_job(spark, sample, f"{tmp_path}/fresh/out")
    assert job.features.columns == ("x", "y", "z", "magnitude", "intensity")
    assert job.score == pytest.approx(SAMPLE_SCORE)
    assert sorted(job.centers) == [pytest.approx(c, abs=1e-6) for c in SAMPLE_CENTERS]
    assert job.labelled.columns == ["x", "y", "z", "intensity", "magnitude", "cluster"]
    written = read_points(spark, f"{tmp_path}/fresh/out/results.csv")
    assert sorted(written.collect()) == sorted(job.labelled.collect())
    assert dict(written.dtypes)["cluster"] == "int"
    assert read_metrics(spark, f"{tmp_path}/fresh/out").first()[0] == job.score


def test_any_uri_that_spark_reads_and_writes(spark, tmp_path):
    """A file system that only Spark knows: plain file calls would not find these paths."""
    spark._jsc.hadoopConfiguration().set(
        "fs.viewfs.mounttable.store.link./data", f"file://{tmp_path}"
    )
    (tmp_path / "points.csv").write_text(SAMPLE)
    job = run_job(spark, "viewfs://store/data/points.csv", "viewfs://store/data/out")
    written = read_points(spark, "viewfs://store/data/out/results.csv")
    assert sorted(written.collect()) == sorted(job.labelled.collect())
    assert read_metrics(spark, "viewfs://store/data/out").first()[0] == pytest.approx(SAMPLE_SCORE)
    assert read_metrics(spark, f"{tmp_path}/out").first()[0] == job.score


def test_without_output_nothing_is_written(spark, sample, tmp_path):
    run_job(spark, sample)
    assert [p.name for p in tmp_path.iterdir()] == ["sample.csv"]


@pytest.mark.parametrize("splits", [1, 3, 8])
def test_same_groups_however_the_input_is_split(spark, sample, splits):
    df = read_points(spark, sample).repartition(splits)
    job = run_job(spark, df)
    rows = canonical_ids(job.labelled, job.centers).orderBy("x").collect()
    assert [r["cluster"] for r in rows] == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_a_job_run_again_gives_the_same_centers(spark, sf_dir):
    points = inputs.pts(spark, sf_dir)
    first, second = run_job(spark, points), run_job(spark, points)
    assert (first.centers, first.score) == (second.centers, second.score)


def test_shuffled_labels_would_be_noticed(spark, sf_dir):
    """What the registered query reports of the job tells its labels from others."""
    from pointloom.plans.catalogue import cluster_lineitem

    points = inputs.pts(spark, sf_dir)
    right = {tuple(r) for r in cluster_lineitem(spark, sf_dir).collect()}
    others = points.withColumn("cluster", (F.col("l_orderkey") % 3).cast("int"))
    wrong = others.groupBy("cluster").agg(F.count("x"), *[F.round(F.avg(c), 6) for c in "xyz"])
    assert not {r[:5] for r in right} & {tuple(r) for r in wrong.collect()}


def test_more_clusters_than_a_thousand(spark, tmp_path):
    points = spark.sql("SELECT CAST(id AS DOUBLE) AS a, CAST(id % 7 AS DOUBLE) AS b FROM range(1300)")
    start = [[float(i), float(i % 7)] for i in range(1100)]
    job = run_job(spark, points, f"{tmp_path}/out", start=start, max_iterations=1)
    assert len(job.centers) == 1100 and -1 <= job.score <= 1
    assert read_metrics(spark, f"{tmp_path}/out").first()[0] == job.score


@pytest.mark.parametrize(
    "text",
    [
        "x,y,z\n1,2,3\nInfinity,1,1\n4,5,6\n",
        "lat,lon\n1,2\n-Infinity,1\n4,5\n",
        "lat,lon\n1,2\n3,Infinity\n4,5\n",
        "a,b\n1,2\n-Infinity,1\n4,5\n",
    ],
)
def test_infinite_coordinates_are_refused(spark, write_csv, tmp_path, text):
    names = text.split("\n")[0].split(",")
    schema = ", ".join(f"{n} double" for n in names)
    text = text.replace("Infinity", "Inf") if "a,b" not in text else text
    with pytest.raises(ValueError, match="infinite coordinates"):
        run_job(spark, write_csv(text), f"{tmp_path}/out", schema=schema)
    assert not Path(f"{tmp_path}/out").exists()


def test_reserved_names_count_as_the_session_compares_them(spark, write_csv):
    for name in ("Features", "CLUSTER", "cluster"):
        with pytest.raises(ValueError, match=f"already has columns named {name}"):
            run_job(spark, write_csv(f"x,y,z,{name}\n1,2,3,4\n"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        text = "x,y,z,Features,Cluster\n1,2,3,4,77\n5,5,5,5,77\n9,9,9,9,77\n"
        job = run_job(spark, write_csv(text))
        assert job.labelled.columns[3:] == ["Features", "Cluster", "magnitude", "cluster"]
        assert {r["Cluster"] for r in job.labelled.collect()} == {77}
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_metrics_are_written_last(spark, sample, tmp_path, monkeypatch):
    from pointloom.plans import cluster_job

    def fail(*_):
        raise OSError("disk full")

    monkeypatch.setattr(cluster_job, "write_results", fail)
    with pytest.raises(OSError, match="disk full"):
        run_job(spark, sample, f"{tmp_path}/out")
    assert not Path(f"{tmp_path}/out").exists()


def test_geo_points(spark, write_csv):
    path = write_csv("lat,lon,name\n1,1,a\n2,2,b\n60,60,c\n61,61,d\n-50,179,e\n-50,178,f\n")
    job = run_job(spark, path)
    assert job.features.columns == ("distance_to_center_km",)
    assert job.labelled.columns == ["lat", "lon", "name", "distance_to_center_km", "cluster"]
    rows = canonical_ids(job.labelled, job.centers).orderBy("name").collect()
    assert [r["cluster"] for r in rows] == [0, 0, 1, 1, 2, 2]
    moved = run_job(spark, path, reference=(-50.0, 178.5))
    rows = canonical_ids(moved.labelled, moved.centers).orderBy("name").collect()
    assert [r["cluster"] for r in rows][-2:] == [0, 0]


def test_elevation_is_a_feature_unscaled(spark, write_csv):
    """Metres swamp kilometres: rows group by elevation although they are far apart."""
    path = write_csv(
        "lat,lon,elevation\n0,0,0\n60,90,1\n0,0,900000\n60,90,900001\n0,0,1800000\n60,90,1800001\n"
    )
    job = run_job(spark, path)
    assert job.features.columns == ("distance_to_center_km", "elevation")
    by_height = {}
    for row in job.labelled.collect():
        by_height.setdefault(row["elevation"] // 900000, set()).add(row["cluster"])
    assert sorted(map(sorted, by_height.values())) == [[0], [1], [2]]


def test_numeric_fallback(spark, write_csv):
    path = write_csv("a,b,c\n1,0.5,p\n2,0.5,q\n100,0.5,r\n101,0.5,s\n500,0.5,t\n501,0.5,u\n")
    job = run_job(spark, path)
    assert (job.features.kind, job.features.columns) == ("numeric", ("a", "b"))
    rows = canonical_ids(job.labelled, job.centers).orderBy("a").collect()
    assert [r["cluster"] for r in rows] == [0, 0, 1, 1, 2, 2]


def test_incomplete_rows_are_left_out(spark, write_csv):
    extra = "1,1,1,\nNaN,1,1,1\n1,1\n"
    job = run_job(spark, write_csv(SAMPLE + extra))
    assert job.labelled.count() == 9


def test_one_distinct_point_has_no_score(spark, write_csv, tmp_path):
    job = run_job(spark, write_csv("x,y,z\n" + "1,1,1\n" * 5), f"{tmp_path}/out")
    assert job.score is None
    assert [r["cluster"] for r in job.labelled.collect()] == [0] * 5
    assert read_points(spark, f"{tmp_path}/out/results.csv").count() == 5
    assert read_metrics(spark, f"{tmp_path}/out").first()[0] is None


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("", "no feature columns"),
        ("s\na\n", "no feature columns"),
        ("x,y,z\n", "must be numeric"),
        ("x,y,z\nabc,1,2\n1,1,2\n", "must be numeric: x"),
        ("x,y,z\n1,2,\n1,,2\n", "must be numeric|no complete rows"),
        ("x,y,z,w\n1,2,3,\n4,5,6,\n", "no complete rows"),
        ("x,y,z,cluster\n1,2,3,4\n", "already has columns named cluster"),
        ("a,features\n1,2\n", "already has columns named features"),
    ],
)
def test_unusable_inputs_say_so(spark, write_csv, tmp_path, text, message):
    with pytest.raises(ValueError, match=message):
        run_job(spark, write_csv(text), f"{tmp_path}/out")
    assert not Path(f"{tmp_path}/out").exists()


def test_input_column_of_a_derived_name_is_replaced(spark, write_csv):
    text = SAMPLE.replace("intensity", "magnitude")
    job = run_job(spark, write_csv(text))
    assert job.labelled.columns == ["x", "y", "z", "magnitude", "cluster"]
    assert job.labelled.orderBy("x").first()["magnitude"] == pytest.approx(14**0.5)


def test_nothing_stays_persisted(spark, sample, write_csv):
    run_job(spark, sample)
    with pytest.raises(ValueError):
        run_job(spark, write_csv("x,y,z,w\n1,2,3,\n"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_label_stage_has_no_shuffle_and_no_python(spark, sf_dir):
    job = run_job(spark, f"{sf_dir}/part.parquet", file_format="parquet")
    plan = plan_of(job.labelled)
    assert "Exchange" not in plan and "Python" not in plan
    assert "PushedFilters: [IsNotNull(p_partkey)" in plan


def test_scratch_folders_are_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second and first.startswith(f"{shared}/a-")
