from __future__ import annotations

import os
from datetime import datetime, timezone

import pytest

from conftest import SAMPLE, SAMPLE_SCORE
from pointloom.sources import read_metrics, read_points
from pointloom.streaming import current_jobs, intake, read_ledger
from pointloom.streaming.intake import announce, job_id_of, run_uploads

GEO = "lat,lon\n1,1\n2,2\n60,60\n61,61\n-50,170\n-50,171\n"


@pytest.fixture
def upload(tmp_path):
    """Drop a file into the upload folder; each one a second later than the last."""
    folder = tmp_path / "uploads"
    folder.mkdir()
    count = iter(range(100))

    def drop(name: str, text: str) -> None:
        path = folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        when = 1_700_000_000 + next(count)
        os.utime(path, (when, when))

    return drop


@pytest.fixture
def run(spark, tmp_path):
    def start(**options):
        query = intake(
            spark, f"{tmp_path}/uploads", f"{tmp_path}/outputs", f"{tmp_path}/ledger",
            f"{tmp_path}/progress", **options,
        )
        query.awaitTermination()
        return read_ledger(spark, f"{tmp_path}/ledger")

    return start


@pytest.mark.parametrize(
    ("path", "uploads", "readable"),
    [
        ("file:/u/1f-2a_points.csv", "/u", "1f-2a-points.csv"),
        ("s3a://b/u/id_my points.csv", "s3a://b/u/", "id-my-points.csv"),
        ("file:/u/1f-2a/my_points.csv", "/u/", "1f-2a-my-points.csv"),
        ("file:/u/1f/c.csv", "file:///u", "1f-c.csv"),
        ("file:/else/where/c.csv", "/u", "else-where-c.csv"),
    ],
)
def test_job_id_is_readable_and_stable(path, uploads, readable):
    job_id = job_id_of(path, uploads)
    assert job_id.rpartition("-")[0] == readable and len(job_id.rpartition("-")[2]) == 16
    assert job_id == job_id_of(path.replace("file:/", "file:///"), uploads)


def test_every_file_has_an_id_of_its_own():
    names = ["points_a.csv", "points_b.csv", "j/p1.csv", "j/p2.csv", "j-p1.csv", "j_p1.csv", "j p1.csv"]
    assert len({job_id_of(f"/u/{n}", "/u") for n in names}) == len(names)


def test_every_version_of_a_file_has_an_id_of_its_own():
    first, later = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)
    versions = [(first, 3), (first, 4), (later, 3)]
    assert len({job_id_of("/u/a.csv", "/u", *v) for v in versions}) == 3


def uploaded(tmp_path, name):
    state = (tmp_path / "uploads" / name).stat()
    when = datetime.fromtimestamp(state.st_mtime, timezone.utc)
    return job_id_of(f"{tmp_path}/uploads/{name}", f"{tmp_path}/uploads", when, state.st_size)


def test_a_file_put_again_is_a_job_of_its_own(spark, tmp_path, upload, run):
    upload("a.csv", "x,y,z\n1,1,1\n2,2,2\n50,50,50\n90,90,90\n")
    first = uploaded(tmp_path, "a.csv")
    assert run().count() == 3
    upload("a.csv", SAMPLE + "3,3,3,1\n" * 6)
    second = uploaded(tmp_path, "a.csv")
    for _ in range(2):  # without a new upload nothing is added
        ledger = run()
        assert ledger.count() == 6 and ledger.select("stream").distinct().count() == 1
    jobs = {r["job_id"]: r for r in current_jobs(ledger).collect()}
    assert {j: r["status"] for j, r in jobs.items()} == {first: "Completed", second: "Completed"}
    counts = {j: read_points(spark, f"{r['result_path']}/results.csv").count() for j, r in jobs.items()}
    assert counts == {first: 4, second: 15}


def test_a_file_put_again_before_it_is_run_is_run_once(spark, tmp_path, upload, run):
    upload("a.csv", "x,y,z\n1,1,1\n")
    upload("a.csv", SAMPLE)
    assert run().count() == 3
    job = current_jobs(read_ledger(spark, f"{tmp_path}/ledger")).first()
    assert job["status"] == "Completed" and job["job_id"] == uploaded(tmp_path, "a.csv")


def test_announcements_survive_a_start_that_is_cut_short(spark, tmp_path, upload, run):
    upload("a.csv", SAMPLE)
    announced = f"{tmp_path}/progress/announced"
    assert announce(spark, f"{tmp_path}/uploads", announced) == 1  # and no stream was started
    upload("b.csv", SAMPLE)
    ledger = run()
    assert ledger.count() == 6 and current_jobs(ledger).count() == 2
    assert announce(spark, f"{tmp_path}/uploads", announced) == 0


def test_uploads_run_in_order_and_fail_alone(spark, tmp_path, upload, run):
    names = {
        "j1": "j1_bad.csv", "j2": "j2_my points [1].csv", "j4": "j4_header.csv",
        "j5": "j5_alike.csv", "j0": "j0_geo.csv",
    }
    upload(names["j1"], "x,y,z\nabc,1,2\n")
    upload(names["j2"], SAMPLE)
    upload("j3_empty.csv", "")
    upload(names["j4"], "x,y,z\n")
    upload(names["j5"], "x,y,z\n1,1,1\n1,1,1\n")
    upload(names["j0"], GEO)
    ids = {job: uploaded(tmp_path, name) for job, name in names.items()}
    ledger = run()
    order = [(r["job_id"], r["status"]) for r in ledger.orderBy("batch_id", "step", "position").collect()]
    assert order == [
        (ids[job], status)
        for job, end in [
            ("j1", "Failed"), ("j2", "Completed"), ("j4", "Failed"),
            ("j5", "Completed"), ("j0", "Completed"),
        ]
        for status in ("Queued", "Running", end)
    ]
    by_id = {r["job_id"]: r for r in current_jobs(ledger).collect()}
    jobs = {job: by_id[ids[job]] for job in names}
    assert "must be numeric: x" in jobs["j1"]["error"] and jobs["j1"]["result_path"] is None
    assert jobs["j2"]["silhouette_score"] == pytest.approx(SAMPLE_SCORE)
    assert jobs["j2"]["result_path"] == f"{tmp_path}/outputs/{ids['j2']}"
    assert jobs["j5"]["silhouette_score"] is None and jobs["j5"]["error"] is None
    assert read_points(spark, f"{jobs['j2']['result_path']}/results.csv").count() == 9
    assert read_metrics(spark, jobs["j0"]["result_path"]).first()[0] == jobs["j0"]["silhouette_score"]


def test_names_that_begin_alike_never_overwrite(spark, tmp_path, upload, run):
    for name in ("points_a.csv", "points_b.csv", "j/p1.csv", "j/p2.csv"):
        upload(name, SAMPLE + "3,3,3,1\n4,4,4,1\n5,5,5,1\n")
    ledger = run(files_per_batch=2)
    assert ledger.count() == 12
    assert len(list((tmp_path / "outputs").iterdir())) == 4
    labelled = spark.read.option("header", True).csv(f"{tmp_path}/outputs/*/results.csv")
    assert labelled.count() == 48


def test_a_second_checkpoint_adds_to_the_ledger(spark, tmp_path, upload, run):
    for name in ("a_1.csv", "a_2.csv"):
        upload(name, SAMPLE)
    assert run().count() == 6
    upload("a_3.csv", SAMPLE)
    query = intake(
        spark, f"{tmp_path}/uploads", f"{tmp_path}/outputs", f"{tmp_path}/ledger",
        f"{tmp_path}/progress-2",
    )
    query.awaitTermination()
    ledger = read_ledger(spark, f"{tmp_path}/ledger")
    assert ledger.select("stream").distinct().count() == 2
    assert ledger.count() == 6 + 9  # the new one begins with all files
    assert current_jobs(ledger).count() == 3


def test_later_uploads_only(spark, tmp_path, upload, run):
    upload("a_points.csv", SAMPLE)
    run()
    upload("b/my_points.csv", GEO)
    ledger = run(reference=(34.0522, -118.2437))
    assert ledger.count() == 6
    done = current_jobs(ledger).filter("status = 'Completed'").orderBy("job_id")
    expected = sorted(uploaded(tmp_path, n) for n in ("a_points.csv", "b/my_points.csv"))
    assert [r["job_id"] for r in done.collect()] == expected


def test_jobs_at_once_end_like_one_after_the_other(spark, tmp_path, upload, run):
    for i in range(5):
        upload(f"p_{i}.csv", SAMPLE if i % 2 else "s\nx\n")
    ledger = run(files_per_batch=5, jobs_at_once=4)
    assert ledger.count() == 15
    states = {r["job_id"]: r["status"] for r in current_jobs(ledger).collect()}
    assert states == {
        uploaded(tmp_path, f"p_{i}.csv"): "Completed" if i % 2 else "Failed" for i in range(5)
    }
    assert ledger.select("step").distinct().count() == 3
    assert len(list((tmp_path / "outputs").glob("*/results.csv"))) == 2


def test_several_files_per_batch_are_queued_first(tmp_path, upload, run):
    upload("a_points.csv", SAMPLE)
    upload("b_bad.csv", "s\nx\n")
    ledger = run(files_per_batch=5)
    order = [(r["job_id"], r["status"]) for r in ledger.orderBy("batch_id", "step", "position").collect()]
    a, b = (uploaded(tmp_path, n) for n in ("a_points.csv", "b_bad.csv"))
    assert order == [
        (a, "Queued"), (b, "Queued"), (a, "Running"), (a, "Completed"),
        (b, "Running"), (b, "Failed"),
    ]


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path, upload):
    upload("a_points.csv", SAMPLE)
    listing = spark.read.format("binaryFile").load(f"{tmp_path}/uploads").select(
        "path", "modificationTime", "length"
    )
    for _ in range(2):
        run_uploads(
            listing, "s", 7, f"{tmp_path}/uploads", f"{tmp_path}/outputs", f"{tmp_path}/ledger", {}
        )
    ledger = read_ledger(spark, f"{tmp_path}/ledger")
    assert ledger.count() == 3
    assert current_jobs(ledger).first()["status"] == "Completed"
    assert read_points(spark, f"{current_jobs(ledger).first()['result_path']}/results.csv").count() == 9
