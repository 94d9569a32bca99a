"""The queries that SQL can express, against an SQL engine."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from conftest import SMALL
from wardline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    expected = Counter(tuple(row[columns.index(c)] for c in df.columns) for row in result.fetchall())
    assert Counter(tuple(r) for r in df.collect()) == expected
