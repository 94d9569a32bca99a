"""Every query against an independent SQL engine, by the multiset of its rows."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, queries
from conftest import SMALL
from samples.oracle import oracle_queries
from samples.queries import QUERIES
from samples.relations import BASE_TABLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = queries()[name](spark, SMALL)
    actual = Counter(tuple(row[c] for c in sorted(df.columns)) for row in df.collect())
    result = duck.execute(oracle_queries()[name])
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert actual == expected
    assert actual


def test_entry_returns_the_discovery_report(spark):
    df = entry(spark)
    assert {"identifier", "discoveryTags", "principal", "privilegeInheritance"} <= set(df.columns)
    assert df.limit(1).count() == 1


def test_the_samples_reach_every_merge_outcome(spark):
    outcomes = queries()["merge_outcome"](spark, SMALL).select("outcome").distinct()
    assert {row[0] for row in outcomes.collect()} == {"update", "stale", "insert", "keep"}


def test_the_samples_reach_every_verdict(spark):
    verdicts = queries()["routine_audit"](spark, SMALL).select("isFunctionValid", "isSecretValid")
    assert verdicts.distinct().count() == 4
