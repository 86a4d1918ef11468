"""Every registered query against its SQL twin on the smallest driver tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import rows_of  # noqa: E402

from catchment.plans.adapters import _NAMES  # noqa: E402


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in _NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, base, name):
    frame = entry.queries()[name](spark, SF)
    ours = [tuple(row) for row in frame.collect()]
    twin = entry.oracle_sql().get(name)
    if twin is None:
        assert ours
        return
    cursor = base.execute(twin)
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, ours) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("missing", ["catchment.llm", "corpus_pipeline", "xxhash", "sentencepiece", "ahocorasick"])
def test_the_library_stands_without_what_the_training_operators_need(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; assert 'open_now' in e.queries() and set(e.oracle_sql()) <= set(e.queries()); print('pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
