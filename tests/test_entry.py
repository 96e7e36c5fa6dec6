"""The entry points in copies of the repository that lack the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CHECK = """
import __spark_entry__ as entry
from workload.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql()), set(entry.queries()) ^ set(QUERIES)
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_import_without_the_operators(tmp_path, pipeline):
    left_out = {"llm", ".git", "__pycache__", ".pytest_cache"}
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: left_out & set(names))
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    done = subprocess.run(
        [sys.executable, "-c", CHECK], cwd=copy, env={"PATH": "", "PYTHONPATH": str(copy)}, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
