"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, final_plan
from __spark_entry__ import queries
from samples.queries import QUERIES
from samples.payloads import scanned_tags, stored_tags, tag_payloads, user_payloads
from samples.relations import Relations
from wardline.functions.cipher import decrypt_columns, encrypt_columns
from wardline.operators.entitlements import principal_access
from wardline.operators.grants import effective_grants
from wardline.plans.audit import (
    mark_removed_in_runs,
    read_history,
    record_audit,
    removal_plan,
    routine_audit,
)
from wardline.plans.reports import discovery_report
from wardline.plans.tagging import collect_tags, merge_into_table, merge_tags
from wardline.sinks.tables import bucketing, publish_version
from wardline.sources.lookup import privilege_lookup
from wardline.sources.payloads import parse_groups, parse_tag_payloads, parse_users, tag_answers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


WORKERS = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_worker_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for operator in WORKERS:
        assert operator not in text
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def saved(df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_only_the_needed_columns_are_read(spark, tmp_path):
    r = Relations(spark, SMALL)
    metadata = {n: saved(r[n], tmp_path, n) for n in ("catalogs", "catalog_privileges")}
    text = plan(effective_grants(metadata, "Catalog"))
    assert "catalog_type" not in text


def test_the_audit_pushes_its_filter_and_evaluates_each_rule_once(spark, tmp_path):
    routines = saved(Relations(spark, SMALL)["routines"], tmp_path, "routines")
    text = plan(routine_audit(routines))
    assert "PushedFilters: [IsNotNull(routine_definition)]" in text
    assert "Exchange" not in text
    assert len(re.findall("RLIKE", text)) == 1
    assert len(re.findall("regexp_replace", text)) == 1


def test_failed_answers_are_skipped_in_the_scan(spark, tmp_path):
    payloads = saved(tag_payloads(Relations(spark, SMALL)), tmp_path, "payloads")
    text = plan(parse_tag_payloads(payloads))
    assert "EqualTo(status_code,200)" in text
    assert len(re.findall("from_json", text)) == 1


def test_one_table_per_catalog_parses_once_and_groups_once(spark, tmp_path):
    payloads = saved(tag_payloads(Relations(spark, SMALL)), tmp_path, "payloads")
    text = plan(collect_tags(payloads, one_per_catalog=True))
    assert len(re.findall("from_json", text)) == 1
    assert len(re.findall("Exchange hashpartitioning", text)) == 1


def test_each_identity_record_is_parsed_once_per_reader(spark, tmp_path):
    r = Relations(spark, SMALL)
    users = parse_users(saved(user_payloads(r), tmp_path, "users"))
    groups = parse_groups(saved(user_payloads(r), tmp_path, "groups"))
    # Users, memberships and groups.
    assert len(re.findall("from_json", plan(principal_access(users, groups)))) == 3


def test_the_secret_is_not_in_the_plan_and_is_looked_up_once(spark):
    r = Relations(spark, SMALL)
    secrets = [row.secret for row in r["cipher_keys"].collect()]
    hidden = encrypt_columns(r["people"], ["ssn", "zipcode"], r["cipher_keys"], "scope1", "key1")
    shown = decrypt_columns(hidden, ["ssn", "zipcode"], r["cipher_keys"], "scope1", "key1")
    text = final_plan(shown) + shown._jdf.queryExecution().toString()
    assert not any(secret in text for secret in secrets)
    assert "ReusedSubquery" in final_plan(shown)


def test_tags_are_exploded_after_the_joins(spark, tmp_path):
    r = Relations(spark, SMALL)
    tags = saved(stored_tags(r), tmp_path, "tags")
    text = plan(discovery_report(tags, r, privilege_lookup(spark)))
    assert text.index("Generate explode(tags") < text.index("Join")


@pytest.mark.parametrize("name", ["all_assets_report", "function_report", "discovery_report"])
def test_the_lookup_is_broadcast_from_the_start(spark, name):
    text = plan(queries()[name](spark, SMALL))
    assert re.search(r"BroadcastHashJoin \[(lower\(type#\d+\), )?privilegeType#\d+\]", text)


@pytest.fixture
def bucketed(spark, tmp_path):
    r = Relations(spark, SMALL)
    publish_version(stored_tags(r), "tags_in_buckets", str(tmp_path), ("identifier", 4))
    yield r, str(tmp_path)
    spark.sql("DROP TABLE tags_in_buckets")


def test_a_bucketed_tag_table_is_not_shuffled_by_a_merge(spark, settings, bucketed):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"
    )
    r, folder = bucketed
    for _ in range(2):
        merged = merge_tags(spark.read.table("tags_in_buckets"), scanned_tags(r), colocated=True)
        text = final_plan(merged)
        scans = [line for line in text.splitlines() if "tags_in_buckets" in line and "Scan" in line]
        assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
        # Of what is shuffled for a join by identifier, nothing stems from the stored side.
        assert "__target_identifier" not in "".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", text))
        merge_into_table(spark, "tags_in_buckets", folder, scanned_tags(r))
        assert bucketing(spark, "tags_in_buckets") == ("identifier", 4)


def test_marking_reads_only_the_runs_of_the_plan(spark, tmp_path):
    target, plan_folder = str(tmp_path / "audit"), str(tmp_path / "plan")
    routines = Relations(spark, SMALL)["routines"]
    for day in (1, 2, 3):
        record_audit(routines, target, F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp"))
    second = read_history(spark, target).where("markedAt = TIMESTAMP '2024-01-02 00:00:00'")
    removal_plan(second).write.parquet(plan_folder)
    n_named = spark.read.parquet(plan_folder).count()

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "audit").rglob("*.parquet")}

    before = files()
    named = mark_removed_in_runs(spark, target, spark.read.parquet(plan_folder))
    after = files()
    assert len(named) == 1
    same = {path for path in before if f"run={named[0]}" not in path}
    assert len(same) < len(before) and all(before[p] == after.get(p) for p in same)
    marked = read_history(spark, target).where("status = 'remove'")
    assert {r[0].day for r in marked.select("markedAt").distinct().collect()} == {2}
    assert marked.count() == n_named > 0
    assert mark_removed_in_runs(spark, target, spark.read.parquet(plan_folder)) == named
    assert read_history(spark, target).where("status = 'remove'").count() == n_named


def test_an_answer_is_parsed_once_however_it_ends(spark, tmp_path):
    answers = saved(tag_payloads(Relations(spark, SMALL), broken=True), tmp_path, "answers")
    text = plan(tag_answers(answers))
    assert len(re.findall(r"from_json\(", text)) == 1
