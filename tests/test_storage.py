from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_reports import GROUPS, METADATA, USERS
from wardline import schemas
from wardline.operators.entitlements import principal_access
from wardline.plans import audit, principals, protection, tagging
from wardline.session import scratch_folder
from wardline.sinks import tables as sinks
from wardline.sources import tables as sources
from wardline.sources.payloads import parse_groups, parse_users

NOW = datetime.datetime(2024, 1, 1)


def test_save_modes(spark, tmp_path):
    target = str(tmp_path / "t")
    one, two = spark.range(1), spark.range(1, 2)
    sinks.save(one, target, "errorifexists")
    with pytest.raises(Exception):
        sinks.save(two, target, "errorifexists")
    sinks.save(two, target, "append")
    assert rows(sources.read_saved(spark, target)) == [(0,), (1,)]
    sinks.save(two, target, "overwrite")
    assert rows(sources.read_saved(spark, target)) == [(1,)]


def test_tables_are_reset_and_filled(spark):
    for _ in range(2):
        table = sinks.reset_table(spark, "tag_table", schemas.TAGS)
        assert table.count() == 0
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in schemas.TAGS
        ]
        sinks.insert_rows(spark, "tag_table", [("a", "Catalog", ["x"], NOW)])
        assert rows(sources.read_saved(spark, "tag_table")) == [("a", "Catalog", ["x"], NOW)]
    sinks.save(spark.read.table("tag_table"), "tag_copy", "overwrite")
    assert spark.read.table("tag_copy").count() == 1


def test_metadata_from_a_folder_and_from_a_catalog_schema(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS info")
    for name, data in METADATA.items():
        df = spark.createDataFrame(data, schemas.METADATA[name])
        df.write.parquet(str(tmp_path / name))
        df.write.mode("overwrite").saveAsTable(f"info.{name}")
    by_folder = sources.read_metadata(spark, f"{tmp_path}/")
    by_name = sources.read_metadata(spark, "info")
    for name, data in METADATA.items():
        assert rows(by_folder[name]) == rows(by_name[name]) == sorted(data, key=repr)


def test_a_table_is_replaced_by_a_query_that_reads_it(spark, tmp_path):
    folder = str(tmp_path)
    first = sinks.publish_version(spark.range(3), "versioned", folder)
    second = sinks.publish_version(
        spark.read.table("versioned").select(F.col("id") + 10).toDF("id"), "versioned", folder
    )
    assert first != second
    assert rows(spark.read.table("versioned")) == [(10,), (11,), (12,)]
    assert rows(spark.read.parquet(first)) == [(0,), (1,), (2,)]


def test_the_tag_job_keeps_its_state_between_runs(spark, tmp_path):
    metadata = {n: spark.createDataFrame(d, schemas.METADATA[n]) for n, d in METADATA.items()}
    folder = str(tmp_path)

    def run(day, **tags):
        landed = [
            (name.replace("_", "."), 200, '{"tag_assignments": [{"tags": ["%s"]}]}' % tag)
            for name, tag in tags.items()
        ]
        answers = spark.createDataFrame(landed, "identifier string, status_code int, payload string")
        as_of = F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")
        tagging.refresh_tag_table(spark, "tags_master", folder, answers, metadata, as_of)
        return rows(
            spark.read.table("tags_master").select(
                "identifier", "type", "tags", F.dayofmonth("lastCheckedAt")
            )
        )

    assert run(2, c="x", c_s_t="x", d="x") == [("c", "Catalog", ["x"], 2), ("c.s.t", "Table", ["x"], 2)]
    assert run(3, c="y", c_s="y") == [
        ("c", "Catalog", ["y"], 2),
        ("c.s", "Schema", ["y"], 3),
        ("c.s.t", "Table", ["x"], 2),
    ]
    assert run(1, c="z")[0] == ("c", "Catalog", ["y"], 2)


@pytest.mark.parametrize("created_by_append", [True, False])
def test_the_audit_history_is_marked_in_place(spark, tmp_path, created_by_append):
    table = f"audit_history_{created_by_append}"
    routines = spark.createDataFrame(METADATA["routines"], schemas.METADATA["routines"])
    if not created_by_append:
        empty = spark.createDataFrame([], schemas.ROUTINE_AUDIT)
        sinks.publish_version(empty, table, str(tmp_path))
    for day in range(2):
        audit.record_audit(routines, table, F.lit(NOW + datetime.timedelta(days=day)))
    assert spark.read.table(table).count() == 4
    sinks.save(audit.removal_plan(spark.read.table(table)), str(tmp_path / "plan"), "errorifexists")
    audit.record_audit(routines, table, F.lit(NOW + datetime.timedelta(days=2)))
    plan = sources.read_saved(spark, str(tmp_path / "plan"))
    audit.mark_removed_in_table(spark, table, str(tmp_path), plan)
    assert audit.removal_plan(spark.read.table(table)).count() == 1
    assert rows(spark.read.table(table).groupBy("routine_name", "status").count()) == [
        ("f", "notAudited", 3),
        ("g", "notAudited", 1),
        ("g", "remove", 2),
    ]


def test_the_access_job(spark, tmp_path):
    users = spark.createDataFrame([(u,) for u in USERS], "payload string")
    groups = spark.createDataFrame([(g,) for g in GROUPS], "payload string")
    for keep in (True, False):
        principals.refresh_access_table(
            spark, "access", str(tmp_path / "it's here"), users, groups, keep
        )
        expected = principal_access(parse_users(users), parse_groups(groups), keep)
        stored = sources.read_saved(spark, "access")
        assert rows(stored) == rows(expected)
        assert stored.columns == schemas.PRINCIPAL_ACCESS.names


def test_published_ciphertext_is_stable(spark, tmp_path):
    people = spark.createDataFrame([("a", "1-2"), ("b", "1-2")], "name string, ssn string")
    keys = spark.createDataFrame(
        [("s", "k", "0123456789abcdef")], "scope string, key string, secret string"
    )
    target = str(tmp_path / "people")
    protection.publish_encrypted(people, ["ssn"], keys, "s", "k", target)
    hidden = sources.read_saved(spark, target)
    assert hidden.join(hidden.select("ssn"), "ssn").count() == 2
    assert hidden.filter("ssn = '1-2'").count() == 0
    shown = protection.read_decrypted(spark, target, {"ssn": "number"}, keys, "s", "k")
    assert shown.columns == ["name", "number"]
    assert rows(shown) == [("a", "1-2"), ("b", "1-2")]
    with pytest.raises(Exception):
        protection.publish_encrypted(people, ["ssn"], keys, "s", "k", target)


def test_scratch_folders_are_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two and one.startswith(f"{shared}/x-")


def test_a_version_with_other_columns_is_refused(spark, tmp_path):
    folder = f"{tmp_path}/guarded"
    sinks.publish_version(spark.createDataFrame([(1, "x")], "a int, b string"), "guarded", folder)
    for schema in ("a int, c string", "a int", "a int, b int"):
        with pytest.raises(ValueError, match="guarded has"):
            sinks.publish_version(spark.createDataFrame([], schema), "guarded", folder)
    assert rows(spark.read.table("guarded")) == [(1, "x")]
    sinks.publish_version(spark.createDataFrame([("y", 2)], "b string, a int"), "guarded", folder)
    assert rows(spark.read.table("guarded")) == [(2, "y")]
    spark.sql("DROP TABLE guarded")


def test_metadata_without_a_column_is_refused_and_times_are_cast(spark, tmp_path):
    for name, data in METADATA.items():
        df = spark.createDataFrame(data, schemas.METADATA[name])
        if name == "routines":
            df = df.withColumn("created", F.lit(NOW).cast("timestamp"))
        df.write.parquet(str(tmp_path / "whole" / name))
        if name == "table_privileges":
            df = df.drop("grantor")
        df.write.parquet(str(tmp_path / "lacking" / name))
    routines = sources.read_metadata(spark, str(tmp_path / "whole"))["routines"]
    assert {r["created"] for r in routines.collect()} == {"2024-01-01 00:00:00"}
    with pytest.raises(ValueError, match="grantor"):
        sources.read_metadata(spark, str(tmp_path / "lacking"))


def test_audit_times_have_one_type(spark, tmp_path, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    routines = spark.createDataFrame(METADATA["routines"], schemas.METADATA["routines"])
    target = str(tmp_path / "audit")
    for kind in ("timestamp", "timestamp_ntz"):
        audit.record_audit(routines, target, F.lit("2024-02-01 00:00:00").cast(kind))
    times = sources.read_saved(spark, target).select(F.col("markedAt").cast("string")).distinct()
    assert rows(times) == [("2024-02-01 00:00:00",)]


def test_superseded_folders_are_removed_but_never_the_current_one(spark, tmp_path):
    folder = str(tmp_path / "kept")
    for n in (1, 2, 3):
        current = sinks.publish_version(spark.range(n), "superseded", folder)
    sinks.save(spark.range(1), f"{folder}/other", "errorifexists")
    long_ago = datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)
    assert sinks.remove_superseded(spark, "superseded", folder, long_ago) == []
    ahead = datetime.datetime.now(datetime.timezone.utc) + datetime.timedelta(days=1)
    assert len(sinks.remove_superseded(spark, "superseded", folder, ahead)) == 2
    assert spark.read.table("superseded").count() == 3
    assert spark.read.parquet(current).count() == 3
    assert spark.read.parquet(f"{folder}/other").count() == 1
    spark.sql("DROP TABLE superseded")
