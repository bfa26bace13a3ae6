"""Every registered query against its SQL on the smallest tables, and the driver contract."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from conftest import SF_DIR

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracles import TABLES, compare  # noqa: E402
from transitlake.workloads import all_oracles, all_queries  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, db, name):
    frame = queries()[name](spark, SF_DIR)
    rows = [tuple(row) for row in frame.collect()]
    assert not [n for n, kind in frame.dtypes if kind.startswith(("map", "struct", "timestamp"))]
    result = db.execute(oracle_sql()[name])
    assert compare(frame.columns, rows, [d[0] for d in result.description], result.fetchall()) == ""


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    frame = entry(spark)
    assert frame.columns and frame.count() > 0


def test_entry_without_the_training_folder(tmp_path):
    """With ``transitlake/llm`` and ``tests/llm`` deleted the other queries are registered, the pipeline or not."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in ("llm", ".git", "__pycache__")])
    code = "import __spark_entry__ as e; print(*e.queries(), sep=','); print(*e.oracle_sql(), sep=',')"
    for _ in range(2):
        run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PYTHONPATH": str(copy), "PATH": os.environ["PATH"]})
        assert run.returncode == 0, run.stderr
        names, oracles = (set(line.split(",")) for line in run.stdout.split())
        assert names == set(all_queries()) and oracles == set(all_oracles())
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
