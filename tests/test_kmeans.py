from __future__ import annotations

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from conftest import SAMPLE_CENTERS, plan_of
from pointloom.operators import (
    add_features,
    assemble,
    assign_nearest,
    canonical_ids,
    choose_features,
    cluster_points,
    fit_kmeans,
    lloyd_steps,
    staged,
    update_centers,
)
from pointloom.plans import inputs
from pointloom.sources import read_points

CLOUD = ["x", "y", "z", "magnitude"]


@pytest.mark.parametrize("splits", [1, 3, 8])
def test_sample_groups_do_not_depend_on_splits(spark, sample, splits):
    df = read_points(spark, sample).repartition(splits)
    features = choose_features(df)
    labelled, centers = cluster_points(add_features(df, features), features.columns)
    assert sorted(centers) == [pytest.approx(c, abs=1e-6) for c in SAMPLE_CENTERS]
    rows = canonical_ids(labelled, centers).collect()
    assert {(r["x"] > 5) + (r["x"] > 20): r["cluster"] for r in rows} == {0: 0, 1: 1, 2: 2}
    assert len(rows) == 9 and len(rows[0]["features"]) == 5


@pytest.mark.parametrize("splits", [None, 5])
def test_centers_and_labels_are_those_of_mllib(spark, splits):
    """Overlapping groups, so that the whole path of 20 updates counts."""
    points = inputs.pts(spark, "/root/testdata/sf0.01")
    points = add_features(points, choose_features(points))
    with staged(points, CLOUD, splits) as kept:
        assert splits is None or kept.rdd.getNumPartitions() == splits
        model = KMeans(k=3, seed=1).fit(assemble(kept, CLOUD))
        centers = fit_kmeans(kept, CLOUD)
        assert centers == [pytest.approx(list(c), abs=1e-9) for c in model.clusterCenters()]
        labelled = assign_nearest(model.transform(assemble(kept, CLOUD)), CLOUD, centers)
        assert labelled.filter("cluster != prediction").count() == 0
        assert labelled.select("cluster").distinct().count() == 3


def test_ties_go_to_the_lowest_index(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS x FROM range(5)")
    rows = assign_nearest(df, ["x"], [[4.0], [0.0], [0.0]]).collect()
    assert [r["cluster"] for r in rows] == [1, 1, 0, 0, 0]
    assert {r["cluster"] for r in assign_nearest(df, ["x"], [[4.0]]).collect()} == {0}


def test_many_centers(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS x FROM range(300)")
    rows = assign_nearest(df, ["x"], [[float(i)] for i in range(300)]).collect()
    assert all(r["cluster"] == r["x"] for r in rows)


def test_labelling_is_a_projection_in_the_scan_stage(spark, sf_dir):
    plan = plan_of(assign_nearest(inputs.pts(spark, sf_dir), ["x", "y", "z"], inputs.START))
    assert "Exchange" not in plan and "Python" not in plan and "UDF" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice" in plan


@pytest.mark.parametrize(("values", "found"), [([1.0] * 5, 1), ([1.0, 1.0, 9.0], 2)])
def test_fewer_distinct_points_than_clusters(spark, values, found):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert sorted(fit_kmeans(df, ["a"])) == [[v] for v in sorted(set(values))][:found]


def test_k_and_output_name(spark):
    df = spark.sql("SELECT CAST(id % 4 * 100 AS DOUBLE) AS a FROM range(40)")
    labelled, centers = cluster_points(df, ["a"], k=4, output="group")
    assert sorted(centers) == [[0.0], [100.0], [200.0], [300.0]]
    assert labelled.groupBy("a").agg(F.count_distinct("group").alias("n")).filter("n > 1").count() == 0


def test_lloyd_keeps_a_center_without_rows(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS x FROM range(4)")
    rows = lloyd_steps(df, ["x"], [[0.0], [3.0], [1e6]], 2).orderBy("cluster").collect()
    assert [tuple(r) for r in rows] == [(0, 2, 0.5), (1, 2, 2.5), (2, 0, 1e6)]


def test_updates_stop_when_no_center_moves(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS x FROM range(4)")
    centers, sizes = update_centers(df, ["x"], [[0.0], [3.0]])
    assert (centers, sizes) == ([[0.5], [2.5]], [2, 2])


def test_one_hot_group_is_combined_before_the_shuffle(spark):
    """Two thirds of all rows are one point; only k rows per split are shuffled."""
    df = spark.sql("SELECT IF(id % 3 < 2, 1.0D, CAST(id AS DOUBLE)) AS x FROM range(3000)")
    step = assign_nearest(df, ["x"], [[1.0], [1500.0]]).groupBy("cluster").agg(F.sum("x"))
    assert "HashAggregate" in plan_of(step) and "partial_sum" in plan_of(step)
    labelled, _ = cluster_points(df, ["x"])
    assert labelled.filter("x = 1.0").select("cluster").distinct().count() == 1


def test_given_start_takes_the_place_of_the_seed(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS x FROM range(4)")
    assert fit_kmeans(df, ["x"], start=[[0.0], [3.0]]) == [[0.5], [2.5]]
    once = fit_kmeans(df, ["x"], start=[[0.0], [1.0]], max_iterations=1, tolerance=None)
    assert once == [[0.0], [2.0]]


def test_nothing_but_arguments_chooses_the_way_to_fit():
    """No constant of the module is a number of rows, cores or splits."""
    from pointloom.operators import kmeans

    numbers = {n for n, v in vars(kmeans).items() if n.isupper() and isinstance(v, (int, float))}
    assert numbers == {"MAX_ITERATIONS", "TOLERANCE"}


def test_staging_runs_no_job(spark):
    spark.sparkContext.setJobGroup("staging", "staging")
    shuffled = spark.range(100).groupBy((F.col("id") % 7).alias("x")).count()
    with staged(shuffled, ["x"], 3) as points:
        jobs = list(spark.sparkContext.statusTracker().getJobIdsForGroup("staging"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert jobs == [] and points.count() == 7


@pytest.mark.parametrize("value", [float("inf"), float("-inf"), float("nan")])
def test_no_distance_can_be_taken(spark, value):
    df = spark.createDataFrame([(1.0, 2.0), (value, 1.0), (3.0, 1.0)], "a double, b double")
    with pytest.raises(ValueError, match="infinite coordinates"):
        fit_kmeans(df, ["a", "b"])
