from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st

from conftest import final_plan, rows, unique_failure
from wardline.operators.merge import merge_outcome, merge_update, merge_upsert

SCHEMA = "k string, v string, ts int"
NEWER = lambda target, source: source("ts") >= target("ts")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def upsert(target, source):
    return merge_upsert(target, source, {"k": "k"}, {"v": "v"}, NEWER)


def expected_upsert(target, source):
    by_key = {k: (v, ts) for k, v, ts in source if k is not None}
    known = {k for k, _, _ in target}
    merged = [
        (k, by_key[k][0], ts) if k in by_key and by_key[k][1] >= ts else (k, v, ts)
        for k, v, ts in target
    ]
    return merged + [row for row in source if row[0] is None or row[0] not in known]


def test_each_outcome(spark):
    target = frame(spark, [("a", "old", 5), ("b", "old", 5), ("c", "old", 5), (None, "old", 5)])
    source = frame(spark, [("a", "new", 5), ("b", "new", 4), ("d", "new", 1), (None, "new", 9)])
    assert rows(upsert(target, source)) == sorted(
        [
            ("a", "new", 5),
            ("b", "old", 5),
            ("c", "old", 5),
            (None, "old", 5),
            ("d", "new", 1),
            (None, "new", 9),
        ],
        key=repr,
    )
    outcomes = merge_outcome(target, source, {"k": "k"}, NEWER)
    assert rows(outcomes) == sorted(
        [
            ("a", "update"),
            ("b", "stale"),
            ("c", "keep"),
            (None, "keep"),
            ("d", "insert"),
            (None, "insert"),
        ],
        key=repr,
    )


def test_the_time_stays_unless_it_is_set_too(spark):
    target, source = frame(spark, [("a", "old", 5)]), frame(spark, [("a", "new", 7)])
    assert rows(upsert(target, source)) == [("a", "new", 5)]
    both = merge_upsert(target, source, {"k": "k"}, {"v": "v", "ts": "ts"}, NEWER)
    assert rows(both) == [("a", "new", 7)]


def test_update_ignores_unknown_source_rows(spark):
    target, source = frame(spark, [("a", "old", 5)]), frame(spark, [("z", "new", 7)])
    assert rows(merge_update(target, source, {"k": "k"}, {"v": "v"})) == [("a", "old", 5)]


def test_a_null_value_replaces_a_value(spark):
    target, source = frame(spark, [("a", "old", 5)]), frame(spark, [("a", None, 7)])
    assert rows(upsert(target, source)) == [("a", None, 5)]


def test_several_target_rows_may_match_one_source_row(spark):
    target = frame(spark, [("a", "x", 1), ("a", "y", 2)])
    assert rows(upsert(target, frame(spark, [("a", "n", 2)]))) == [("a", "n", 1), ("a", "n", 2)]


def test_two_source_rows_for_one_target_row_are_an_error(spark):
    target = frame(spark, [("a", "x", 1)])
    source = frame(spark, [("a", "n", 2), ("a", "m", 2)])
    for merged in (
        upsert(target, source),
        merge_update(target, source, {"k": "k"}, {"v": "v"}),
        merge_outcome(target, source, {"k": "k"}),
        upsert(target, source).select("k"),
    ):
        assert "more than one source row" in unique_failure(merged.collect)


def test_two_source_rows_without_a_target_row_are_both_inserted(spark):
    source = frame(spark, [("b", "n", 2), ("b", "n", 2)])
    assert rows(upsert(frame(spark, [("a", "x", 1)]), source)) == [
        ("a", "x", 1),
        ("b", "n", 2),
        ("b", "n", 2),
    ]


TIMES = st.integers(0, 3)
KEYS = st.one_of(st.none(), st.sampled_from("abcdef"))
CASES = st.tuples(
    st.lists(st.tuples(KEYS, st.just("old"), TIMES), max_size=8),
    st.lists(st.tuples(KEYS, st.just("new"), TIMES), max_size=8, unique_by=lambda row: row[0]),
)


def joined_cases(cases):
    """Many small merges as one: keys carry the number of their case."""

    def numbered(side):
        return [
            (None if k is None else f"{number}{k}", v, ts)
            for number, case in enumerate(cases)
            for k, v, ts in case[side]
        ]

    return numbered(0), numbered(1)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
@examples(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(cases=st.lists(CASES, min_size=30, max_size=60))
def test_against_plain_python(spark, settings, threshold, cases):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold)
    target, source = joined_cases(cases)
    merged = upsert(frame(spark, target), frame(spark, source))
    assert rows(merged) == sorted(expected_upsert(target, source), key=repr)


def test_merging_again_or_nothing_changes_nothing(spark):
    target = [("a", "old", 2), ("b", "old", 2), ("b", "old", 1)]
    source = frame(spark, [("a", "new", 2), ("b", "new", 1), ("c", "new", 1)])
    once = upsert(frame(spark, target), source)
    assert rows(upsert(once, source)) == rows(once)
    assert rows(upsert(frame(spark, target), frame(spark, []))) == sorted(target, key=repr)


def test_a_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(10_000).selectExpr(
        "CAST(id AS STRING) AS k", "'old' AS v", "CAST(id AS INT) AS ts"
    ).write.parquet(path)
    merged = merge_upsert(
        spark.read.parquet(path),
        spark.sql("SELECT * FROM VALUES ('5', 'new', 9), ('x', 'new', 1) AS s(k, v, ts)"),
        {"k": "k"},
        {"v": "v"},
        NEWER,
    )
    text = final_plan(merged)
    assert "SortMergeJoin" not in text
    assert merged.count() == 10_001
    # What is shuffled: the source for its grouping and by its keys (with all columns and without), and
    # the matched keys.
    shuffled = re.findall(r"(?<!, )Exchange hashpartitioning\((\w+)", text)
    assert sorted(shuffled) == ["__source_k", "__source_k", "__target_k", "_groupingexpression"]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
@pytest.mark.parametrize("colocated", [False, True])
def test_the_source_is_read_once(spark, settings, tmp_path, threshold, colocated):
    settings(spark__sql__autoBroadcastJoinThreshold=threshold)
    target, source = str(tmp_path / "target"), str(tmp_path / "source")
    frame(spark, [(str(k), "old", k) for k in range(100)]).write.parquet(target)
    data = [(str(k), "new", 999) for k in range(95, 105)] + [(None, "new", 1), ("104", "new", 999)]
    frame(spark, data).write.parquet(source)
    merged = merge_upsert(
        spark.read.parquet(target), spark.read.parquet(source), {"k": "k"}, {"v": "v"}, NEWER, colocated
    )
    text = final_plan(merged)
    # The target whole, its keys, and the source.
    assert len(re.findall("FileScan parquet", text)) == 3
    assert merged.count() == 107 and merged.where("v = 'new'").count() == 12


def test_many_copies_of_a_new_row(spark):
    source = spark.range(10_000).selectExpr("'n' AS k", "'new' AS v", "1 AS ts")
    merged = upsert(frame(spark, [("a", "old", 1)]), source)
    assert merged.count() == 10_001 and merged.distinct().count() == 2
