from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pointloom.session import get_spark  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

# Nine points in three plain groups (rows 1, 2, 7 / 3, 4, 8 / 5, 6, 9).
SAMPLE = """x,y,z,intensity
1.0,2.0,3.0,0.5
1.1,2.1,3.1,0.6
10.0,10.0,10.0,0.9
10.2,10.1,10.3,0.85
50.0,50.0,5.0,0.1
51.0,50.5,5.2,0.15
2.0,1.0,3.5,0.55
11.0,10.5,10.1,0.92
49.5,50.2,4.8,0.12
"""
SAMPLE_CENTERS = [
    [1.366667, 1.7, 3.2, 3.932511, 0.55],
    [10.4, 10.2, 10.133333, 17.747801, 0.89],
    [50.166667, 50.233333, 5.0, 71.170356, 0.123333],
]
SAMPLE_SCORE = 0.9975246759932097


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def write_csv(tmp_path):
    """Write text to a file of that name below the test's folder; returns its path."""

    def write(text: str, name: str = "points.csv") -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return write


@pytest.fixture
def sample(write_csv):
    return write_csv(SAMPLE, "sample.csv")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
