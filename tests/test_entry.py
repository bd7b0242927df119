"""The driver's entry, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from lakeshore import oracles, queries

ROOT = Path(__file__).resolve().parent.parent
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_the_rest_works_without_llm(tmp_path, with_pipeline):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    for name in ("lakeshore", "tests"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=skip)
    for name in ("__spark_entry__.py", *["corpus_pipeline.py"] * with_pipeline):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    got = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    registered, sql = (line.split() for line in got.stdout.splitlines()[-2:])
    assert registered == sorted(queries.QUERIES) and sql == sorted(oracles.ORACLES)
