from __future__ import annotations

from datetime import datetime, timedelta, timezone
from pathlib import Path

from conftest import plan_of
from pointloom.plans import inputs
from pointloom.streaming import (
    Change,
    append_changes,
    compact_ledger,
    current_jobs,
    find_job,
    list_jobs,
    read_ledger,
    recorded_runs,
)
from pointloom.streaming.ledger import ORDER

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_fold(spark, tmp_path):
    path = f"{tmp_path}/ledger"

    def note(batch, step, job, status, **values):
        ts = START + timedelta(minutes=10 * batch + step)
        change = Change(job, status, ts, **values)
        assert append_changes(spark, path, "s", batch, step, [change]) == step + 1

    note(0, 0, "a", "Queued")
    note(0, 1, "a", "Running")
    note(0, 2, "a", "Completed", result_path="out/a", silhouette_score=0.5)
    note(1, 0, "b", "Queued")
    note(1, 1, "b", "Running")
    note(1, 2, "b", "Failed", error="boom")
    note(2, 0, "a", "Running")  # nulls never hide what is known
    ledger = read_ledger(spark, path)
    rows = {r["job_id"]: r for r in current_jobs(ledger).collect()}
    assert (rows["a"]["status"], rows["a"]["result_path"]) == ("Running", "out/a")
    assert (rows["a"]["silhouette_score"], rows["a"]["error"]) == (0.5, None)
    assert (rows["b"]["status"], rows["b"]["error"]) == ("Failed", "boom")
    created = rows["a"]["created_at"].astimezone(timezone.utc)
    assert created == START

    assert find_job(ledger, "b").first()["status"] == "Failed"
    assert find_job(ledger, "unknown").count() == 0

    note(1, 2, "b", "Completed", result_path="out/b")  # the batch ran again
    again = read_ledger(spark, path)
    assert again.count() == 7
    assert find_job(again, "b").first()["status"] == "Completed"
    assert find_job(again, "b").first()["error"] is None


def test_equal_times_are_ordered_by_sequence(spark):
    df = spark.sql(
        "SELECT 'a' AS job_id, s AS status, null AS result_path, 0.0D AS silhouette_score, "
        "null AS error, TIMESTAMP '2024-01-01' AS ts, q AS seq "
        "FROM VALUES ('Running', 2), ('Completed', 3), ('Queued', 1) AS t(s, q)"
    )
    assert current_jobs(df, ("ts", "seq")).first()["status"] == "Completed"


def test_changes_written_together_keep_their_order(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    together = [Change("a", "Queued", START), Change("b", "Queued", START), Change("a", "Running", START)]
    assert append_changes(spark, path, "s", 3, 0, together) == 1
    assert append_changes(spark, path, "s", 3, 1, []) == 1
    rows = read_ledger(spark, path).orderBy(*ORDER).collect()
    assert [(r["job_id"], r["batch_id"], r["step"], r["position"]) for r in rows] == [
        ("a", 3, 0, 0), ("b", 3, 0, 1), ("a", 3, 0, 2)
    ]
    assert find_job(read_ledger(spark, path), "a").first()["status"] == "Running"


def test_order_has_no_limit(spark, tmp_path):
    """At one time, a late change of one batch comes before an early one of the next."""
    path = f"{tmp_path}/ledger"
    append_changes(spark, path, "s", 1, 2_000_000, [Change("a", "Running", START)])
    append_changes(spark, path, "s", 2, 0, [Change("a", "Completed", START)])
    assert find_job(read_ledger(spark, path), "a").first()["status"] == "Completed"


def test_streams_do_not_meet(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    for stream in ("one", "two"):
        append_changes(spark, path, stream, 0, 0, [Change(stream, "Queued", START)])
    assert sorted(r["job_id"] for r in read_ledger(spark, path).collect()) == ["one", "two"]


def test_compaction_keeps_all_changes(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    for stream, batches in (("s", 6), ("t", 1)):
        for batch in range(batches):
            for step, status in enumerate(("Queued", "Running", "Completed")):
                ts = START + timedelta(minutes=batch)
                append_changes(spark, path, stream, batch, step, [Change(f"{stream}{batch}", status, ts)])
    before = sorted(map(str, read_ledger(spark, path).collect()))
    assert compact_ledger(spark, path) == 5
    assert sorted(map(str, read_ledger(spark, path).collect())) == before
    left = sorted(p.name for p in Path(path).glob("changes/*/batch=*"))
    assert left == ["batch=0", "batch=5"]
    assert compact_ledger(spark, path) == 0

    append_changes(spark, path, "s", 6, 0, [Change("s6", "Queued", START)])
    append_changes(spark, path, "s", 6, 0, [Change("s6", "Queued", START)])  # ran again
    assert compact_ledger(spark, path) == 1
    assert read_ledger(spark, path).count() == len(before) + 1
    assert len(list(Path(path).glob("packed/*"))) == 1


def test_a_change_that_is_there_twice_counts_once(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    append_changes(spark, path, "s", 0, 0, [Change("a", "Completed", START, "out", 0.5)])
    ledger = read_ledger(spark, path)
    assert current_jobs(ledger.union(ledger)).collect() == current_jobs(ledger).collect()


def test_recorded_jobs_are_listed(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    for step, status in enumerate(("Queued", "Running", "Failed")):
        append_changes(spark, path, "s", 0, step, [Change("my-job-1", status, START)])
    append_changes(spark, path, "s", 0, 3, [Change("b", "Queued", START), Change("c", "Completed", START)])
    rows = list_jobs(recorded_runs(read_ledger(spark, path))).orderBy("name").collect()
    assert [tuple(r)[:4] for r in rows] == [
        ("b", "job-b", "Queued", "Creating"),
        ("c", "job-c", "Completed", "Succeeded"),
        ("my-1", "job-my-job-1", "Failed", "Failed"),
    ]


def test_missing_ledger_is_empty(spark, tmp_path):
    assert read_ledger(spark, f"{tmp_path}/none").count() == 0
    assert current_jobs(read_ledger(spark, f"{tmp_path}/none")).count() == 0


def test_fold_combines_before_the_shuffle(spark, sf_dir):
    plan = plan_of(current_jobs(inputs.changes(spark, sf_dir), inputs.CHANGE_ORDER))
    assert plan.count("partial_max_by") >= 4 and plan.count("Exchange") == 1
    assert "Window" not in plan


def test_lookup_filters_the_scan(spark, tmp_path):
    append_changes(spark, f"{tmp_path}/l", "s", 0, 0, [Change("a", "Queued", START)])
    plan = plan_of(find_job(read_ledger(spark, f"{tmp_path}/l"), "a"))
    assert "EqualTo(job_id,a)" in plan


def test_a_job_with_most_of_the_rows(spark):
    df = spark.sql(
        "SELECT IF(id % 3 < 2, 'hot', CAST(id AS STRING)) AS job_id, CAST(id AS STRING) AS status, "
        "IF(id % 5 = 0, CAST(id AS STRING), null) AS result_path, CAST(id AS DOUBLE) AS silhouette_score, "
        "CAST(null AS STRING) AS error, TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts, "
        "id AS seq FROM range(0, 9000, 1, 6)"
    )
    hot = find_job(df, "hot", ("ts", "seq")).first()
    assert (hot["status"], hot["result_path"]) == ("8998", "8995")
    assert current_jobs(df, ("ts", "seq")).count() == 3001


def test_listing(spark):
    runs = spark.sql(
        "SELECT * FROM VALUES ('job-1', 'Running'), ('web-2', 'Running'), "
        "('job-a-job-b', 'Failed'), ('my-job-3', 'Running'), ('Job-4', 'Running'), (null, 'x') "
        "AS t(name, state)"
    ).selectExpr("*", "'Succeeded' AS provisioning_state", "TIMESTAMP '2024-01-01' AS created")
    rows = list_jobs(runs).orderBy("name").collect()
    assert [(r["job_id"], r["name"], r["state"]) for r in rows] == [
        ("1", "job-1", "Running"),
        ("a-b", "job-a-job-b", "Failed"),
    ]
