"""Every registered query against its SQL, over whole tables, on the smallest test data."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF_DIR, plan_of
from pointloom.plans.catalogue import QUERIES, planted_labels
from pointloom.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)

    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = result.fetchall()
    assert expected, "a check without rows checks nothing"
    assert canonical(df.collect(), df.columns) == canonical(expected, names)


@pytest.mark.parametrize(
    ("label", "labels", "apart"),
    [("planted", 1, True), ("0", 1, False), ("planted % 2", 1, False), ("key % 5", 5, False)],
)
def test_wrong_labels_of_uploads_show(spark, label, labels, apart):
    rows = spark.sql(
        f"SELECT 'j' AS job_id, planted, {label} AS cluster FROM "
        "(SELECT id AS key, id % 3 AS planted FROM range(90))"
    )
    found = planted_labels(rows).collect()
    assert {(r["n_labels"], r["apart"]) for r in found} == {(labels, apart)}


@pytest.mark.parametrize(
    "name",
    [
        "preview_top5", "drop_incomplete", "feature_set", "magnitude", "haversine_km",
        "numeric_fallback", "assign_nearest", "ledger_current", "ledger_lookup", "ledger_list",
    ],
)
def test_plans_have_no_pair_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("Cartesian", "NestedLoop", "EvalPython", "Pandas", "Window"):
        assert unwanted not in plan
    if name == "preview_top5":
        assert "TakeOrderedAndProject" in plan
    elif not name.startswith("ledger") and name != "feature_set":
        assert "Exchange" not in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["numeric_fallback"](spark, SF_DIR))
    assert "ReadSchema: struct<p_size:int,p_retailprice:double>" in plan
    plan = plan_of(QUERIES["ledger_list"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[-2:] == ["magnitude", "cluster"]
    assert df.count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
