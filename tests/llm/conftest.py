"""Helpers for the tests of the training-data operators."""

from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A small documents table out of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(row[0], row[1], *(row[2:] or ("en", "src0")), None if row[1] is None else len(row[1])) for row in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture
def against_sql():
    """Whether a frame holds the rows that the SQL gives over the named tables."""

    def check(frame, sql, folder=SF, **tables):
        base = duckdb.connect()
        for name in ("documents", "labels", "embeddings"):
            base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        for name, rows in tables.items():
            base.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM rows")
        cursor = base.execute(sql)
        names = [item[0] for item in cursor.description]
        assert sorted(names) == sorted(frame.columns)
        ours = frame.select(*names).collect()
        assert sorted(map(repr, map(tuple, ours))) == sorted(map(repr, cursor.fetchall()))

    return check
