"""Ranked search against plain Python; the query itself is compared with SQL."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from conftest import SMALL
from test_operators import none, odd  # noqa: F401
from wardline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def expected(docs, items, best=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    frequency = Counter(t for _, c in counts for t in c)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            norm = 100 - 90 + 90 * c.total() * n_docs // n_terms if c else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * norm))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:best]
        rows += [(item_id, k, doc_id, -score) for k, (score, _, doc_id) in enumerate(scores, 1)]
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"block": 50, "owners": 3, "most_terms": 200}, {"best": 3, "owners": 1}])
def test_as_by_brute_force(spark, options):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    # Ties, repeated and null ids, letters beyond ASCII.
    docs += [(500_000 - k, docs[5][1]) for k in range(15)] + [(None, docs[7][1]), (3, docs[7][1])]
    docs += [(600_000, "Größe É_é groesse GRÖSSE"), (600_001, None), (600_002, " ,.;")]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(12).collect()]
    items += [(900, docs[5][1]), (901, "größe É nirgends"), (902, None), (903, ""), (900, docs[5][1]), (None, docs[7][1])]
    found = lexical.ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        **options,
    )
    assert rows_of(found) == expected(docs, items, options.get("best", 10))


def test_odd_rows_and_none(spark, odd, none):  # noqa: F811
    names = "1 AS block", "2 AS local", "3 AS terms", "4 AS item", "5 AS score", "6 AS number"
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = odd.selectExpr("doc_id AS item_id", "text", *names)
    found = rows_of(lexical.ranked(odd.selectExpr("*", *names), items))
    assert found == expected(docs, docs)
    assert lexical.ranked(none, items).count() == lexical.ranked(odd, items.where("false")).count() == 0


def test_owners_come_one_after_the_other(spark):
    found = lexical.op13_ranked_search(spark, SMALL)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") >= lexical.OWNERS
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
