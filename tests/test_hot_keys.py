"""A third of all rows on one key, with broadcasts off: the plan must split it, and lose nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import final_plan
from wardline.operators.entitlements import inherited_entitlements, principal_access
from wardline.operators.grants import expand_inheritance
from wardline.operators.joins import left_join_many
from wardline.operators.merge import merge_upsert
from wardline.operators.securables import enumerate_securables
from wardline.plans import principals
from wardline.sinks.tables import publish_version
from wardline.sources.lookup import privilege_lookup

ROWS = 240_000


@pytest.fixture(autouse=True)
def small_limits(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
    )


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Rows ``(k, v, p)``, a third with the key ``hot`` and the others over 999 keys."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 999))
    spark.range(0, ROWS, 1, 8).select(
        key.alias("k"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("p")
    ).write.parquet(path)
    return spark.read.parquet(path)


def keys(spark, prefix, n):
    return spark.range(n).select(F.concat(F.lit(prefix), "id").alias("k"))


def assert_split(df):
    assert "skew=true" in final_plan(df)


def test_left_join_many(spark, hot):
    left = keys(spark, "k", 2000).union(spark.sql("SELECT 'hot'"))
    joined = left_join_many(left, hot, {"k": "k"})
    assert_split(joined)
    expected = left.join(hot.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "left")
    assert joined.exceptAll(expected.drop("k2")).count() == 0
    assert joined.count() == expected.count()


def test_merge_with_a_hot_target_key(spark, hot):
    source = keys(spark, "k", 1500).union(spark.sql("SELECT 'hot'")).selectExpr(
        "k", "1000000L AS v", "'new' AS p"
    )
    merged = merge_upsert(
        hot, source, {"k": "k"}, {"p": "p"}, lambda target, new: new("v") >= target("v")
    )
    assert_split(merged)
    known = hot.select("k").distinct().count()
    assert merged.count() == ROWS + 1501 - known
    assert merged.filter("p = 'new'").count() == merged.count()


def test_merge_with_a_hot_new_source_key(spark, hot):
    target = keys(spark, "z", 5000).selectExpr("k", "0L AS v", "'old' AS p")
    merged = merge_upsert(target, hot, {"k": "k"}, {"p": "p"})
    final_plan(merged)
    assert merged.count() == 5000 + ROWS
    assert merged.filter("p = 'old'").count() == 5000


def test_membership_of_a_group_most_are_in(spark, hot):
    users = hot.select(F.col("v").alias("userId"), F.array("k").alias("groups"))
    groups = keys(spark, "k", 999).union(spark.sql("SELECT 'hot'")).select(
        F.col("k").alias("displayName"), F.array(F.lit("a"), F.lit("b")).alias("entitlements")
    )
    inherited = inherited_entitlements(users, groups)
    assert_split(inherited)
    assert inherited.filter(F.size("inherited_entitlements") == 2).count() == ROWS


def test_a_catalog_with_most_tables(spark, hot):
    catalogs = keys(spark, "k", 999).union(spark.sql("SELECT 'hot'"))
    metadata = {
        "catalogs": catalogs.select(
            F.col("k").alias("catalog_name"), F.lit("o").alias("catalog_owner"), F.lit("m").alias("catalog_type")
        ),
        "schemata": catalogs.select(
            F.col("k").alias("catalog_name"), F.lit("s").alias("schema_name"), F.lit("o").alias("schema_owner")
        ),
        "tables": hot.select(
            F.col("k").alias("table_catalog"),
            F.lit("s").alias("table_schema"),
            F.col("p").alias("table_name"),
            F.lit("o").alias("table_owner"),
        ),
    }
    found = enumerate_securables(metadata)
    assert_split(found)
    assert found.count() == 2000 + ROWS


def test_a_privilege_most_grants_have(spark, hot):
    grants = hot.select(
        F.lit("Table").alias("type"),
        F.when(F.col("k") == "hot", "ALL_PRIVILEGES").otherwise(F.col("k")).alias("privilegeType"),
        "p",
    )
    expanded = expand_inheritance(grants, privilege_lookup(spark))
    assert_split(expanded)
    assert expanded.count() == ROWS + ROWS // 3


@pytest.mark.parametrize("keep_uninherited", [True, False])
def test_access_rows_of_all_users_with_few_lists_of_groups(spark, tmp_path, settings, keep_uninherited):
    """Users that fit a broadcast must not all be sent to the tasks that hold the few lists."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="10m",
        spark__sql__adaptive__autoBroadcastJoinThreshold="10m",
    )
    spark.range(0, 30_000, 1, 4).selectExpr(
        "CAST(id AS STRING) AS userId",
        "CONCAT('u', id % 20000) AS userName",
        "ARRAY('g0', CONCAT('g', id % 3)) AS groups",
        "ARRAY('own') AS entitlements",
    ).write.parquet(str(tmp_path / "users"))
    users = spark.read.parquet(str(tmp_path / "users"))
    groups = spark.sql("SELECT 'g1' AS displayName, ARRAY('a', 'b') AS entitlements")
    access = principal_access(users, groups, keep_uninherited)
    plan = final_plan(access)
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan
    # Records are dealt out over all partitions before they become several rows each.
    assert "REPARTITION_BY_NUM" in plan and plan.index("Generate") < plan.index("REPARTITION_BY_NUM")
    expected = {
        (f"u{n % 20000}", group, own)
        for n in range(30_000)
        if keep_uninherited or n % 3 == 1
        for group in ("g0", f"g{n % 3}")
        for own in (["own", "a", "b"] if n % 3 == 1 else ["own"])
    }
    found = [tuple(row) for row in access.collect()]
    assert len(found) == len(expected) and set(found) == expected


@pytest.mark.parametrize("keep_uninherited", [True, False])
def test_the_access_job_with_few_lists_of_groups(spark, tmp_path, settings, monkeypatch, keep_uninherited):
    """The users that the job has landed fit a broadcast, and must not all be sent to one task either."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="10m",
        spark__sql__adaptive__autoBroadcastJoinThreshold="10m",
    )
    published = []

    def publish(access, table, folder):
        published.append(access)
        return publish_version(access, table, folder)

    monkeypatch.setattr(principals, "publish_version", publish)
    users = spark.range(0, 30_000, 1, 4).selectExpr(
        """CONCAT('{"id": "', id, '", "userName": "u', id, '", "groups": [{"display": "g', id % 3,
           '"}], "entitlements": [{"value": "own"}]}') AS payload"""
    )
    groups = spark.createDataFrame(
        [('{"displayName": "g1", "entitlements": [{"value": "a"}]}',)], "payload string"
    )
    table = f"few_lists_{keep_uninherited}"
    principals.refresh_access_table(spark, table, str(tmp_path), users, groups, keep_uninherited)
    plan = final_plan(published[0])
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan
    assert "REPARTITION_BY_NUM" in plan and plan.index("Generate") < plan.index("REPARTITION_BY_NUM")
    expected = {
        (f"u{n}", f"g{n % 3}", own)
        for n in range(30_000)
        if keep_uninherited or n % 3 == 1
        for own in (["own", "a"] if n % 3 == 1 else ["own"])
    }
    found = [tuple(row) for row in spark.read.table(table).collect()]
    assert len(found) == len(expected) and set(found) == expected
