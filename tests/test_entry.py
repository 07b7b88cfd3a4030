"""The driver contract: entry() runs; every registered query matches its DuckDB oracle."""

import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["userId", "name", "action", "seq", "ts_us"]
    assert df.count() > 0


def own(names):
    """The queries of the record operators (those of the training-data folder have tests there)."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_every_query_has_an_oracle():
    assert own(entry.queries()) == own(entry.oracle_sql())


@pytest.mark.parametrize("gone", [("tidal/llm", "tests/llm", "corpus_pipeline.py"), ("tidal/llm", "tests/llm"),
                                  ("corpus_pipeline.py",)])
def test_entry_without_the_training_data_folders(gone, tmp_path):
    """The record queries stay when the folders or the pipeline are deleted."""
    repo = Path(entry.__file__).resolve().parent
    copy = tmp_path / "copy"
    shutil.copytree(repo, copy, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__")
                    or str((Path(d) / n).relative_to(repo)) in gone])
    code = "import __spark_entry__ as e; print(len(e.oracle_sql())); print(*e.queries())"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert said.returncode == 0, said.stderr
    names = set(said.stdout.splitlines()[-1].split())
    assert own(names) == own(entry.queries())
    assert ("pipeline" in names) == (len(gone) == 0)
    assert any(n.startswith("op1_") for n in names) == ("tidal/llm" not in gone)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(own(entry.queries())))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF, con)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
