"""The entry file with and without the subpackage that may be left out."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def names(folder):
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in done.stdout.splitlines()]


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_operators(tmp_path, pipeline):
    shutil.copytree(
        f"{ROOT}/ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if pipeline:
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    queries, oracle = names(tmp_path)
    assert "account_changes" in queries and oracle <= queries
    assert not any(name.startswith("op") and name[2:3].isdigit() for name in queries)
    assert "pipeline" not in queries


def test_every_oracle_has_a_query():
    queries, oracle = names(ROOT)
    assert oracle <= queries
