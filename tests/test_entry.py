"""The registered queries without what only the corpus operators need."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from pointloom.plans.catalogue import QUERIES
from pointloom.plans.oracles import ORACLES

ROOT = Path(__file__).resolve().parents[1]


def registered(hidden: str) -> subprocess.CompletedProcess:
    code = (
        f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; "
        "print(len(e.queries()), len(e.oracle_sql()))"
    )
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("library", ["xxhash", "pandas", "pyarrow"])
def test_a_missing_library_takes_only_the_corpus_queries(library):
    found = registered(library)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], found.stderr
    if (ROOT / "pointloom/llm").exists():
        assert f"{library} is not installed" in found.stderr


@pytest.mark.parametrize("module", ["corpus_pipeline", "pointloom.llm"])
def test_the_optional_part_may_be_absent(module):
    found = registered(module)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], found.stderr


def test_other_missing_modules_are_told():
    assert "ModuleNotFoundError" in registered("pointloom.session").stderr
