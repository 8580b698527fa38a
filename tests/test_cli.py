from __future__ import annotations

import pytest

from pointloom.__main__ import main
from pointloom.sources import read_metrics, read_points


def test_input_and_output(spark, sample, tmp_path, capsys):
    assert main(["--input", sample, "--output", f"{tmp_path}/out"]) == 0
    printed = capsys.readouterr().out
    assert "features: x, y, z, magnitude, intensity" in printed and "silhouette: 0.99" in printed
    assert read_points(spark, f"{tmp_path}/out/results.csv").count() == 9


def test_config_gives_what_arguments_do_not(spark, write_csv, tmp_path):
    pytest.importorskip("yaml")
    geo = write_csv("lat,lon\n34,-118\n34.1,-118\n60,60\n61,61\n-50,0\n-50,1\n", "geo.csv")
    config = write_csv(
        f"input_path: {geo}\noutput_path: {tmp_path}/unused\n"
        "reference_point:\n  lat: 34.0\n  lon: -118.0\n",
        "job.yaml",
    )
    assert main(["--config", config, "--output", f"{tmp_path}/out"]) == 0
    rows = read_points(spark, f"{tmp_path}/out/results.csv").orderBy("distance_to_center_km")
    assert rows.first()["distance_to_center_km"] == 0.0
    assert read_metrics(spark, f"{tmp_path}/out").first()[0] is not None
    assert not (tmp_path / "unused").exists()


def test_format_schema_k_and_seed(spark, tmp_path, capsys):
    spark.sql("SELECT CAST(id % 4 * 100 AS DOUBLE) AS a, id FROM range(40)").write.parquet(f"{tmp_path}/p")
    arguments = ["--input", f"{tmp_path}/p", "--output", f"{tmp_path}/out", "--format", "parquet"]
    assert main([*arguments, "--schema", "a double", "--k", "4", "--seed", "7"]) == 0
    assert "features: a\n" in capsys.readouterr().out
    found = read_points(spark, f"{tmp_path}/out/results.csv")
    assert found.columns == ["a", "cluster"] and found.select("cluster").distinct().count() == 4


def test_reference_needs_no_config(spark, write_csv, tmp_path):
    geo = write_csv("lat,lon\n34,-118\n34.1,-118\n60,60\n61,61\n-50,0\n-50,1\n", "geo.csv")
    assert main(["--input", geo, "--output", f"{tmp_path}/out", "--reference", "34.0", "-118.0"]) == 0
    rows = read_points(spark, f"{tmp_path}/out/results.csv").orderBy("distance_to_center_km")
    assert rows.first()["distance_to_center_km"] == 0.0


def test_input_is_needed(write_csv, capsys):
    assert main([]) == 1
    assert "--input" in capsys.readouterr().err


def test_missing_config(tmp_path):
    pytest.importorskip("yaml")
    with pytest.raises(FileNotFoundError):
        main(["--config", f"{tmp_path}/none.yaml", "--input", "x"])
