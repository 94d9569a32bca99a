"""The rules of the reports that are easy to get wrong."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from wardline import schemas
from wardline.operators.entitlements import final_entitlements, principal_access
from wardline.operators.grants import all_assets, effective_grants, expand_inheritance
from wardline.operators.securables import enumerate_securables
from wardline.plans import audit, reports, tagging
from wardline.sources import payloads
from wardline.sources.lookup import privilege_lookup

METADATA = {
    "catalogs": [("c", "oc", "MANAGED"), ("d", "od", "DELTASHARING_CATALOG"), ("e", "oe", None)],
    "schemata": [("c", "s", "os"), ("d", "s", "ods")],
    "tables": [("c", "s", "t", "ot"), ("d", "s", "t", "odt"), ("c", "gone", "t", "ot")],
    "catalog_privileges": [("root", "ann", "SELECT", "c"), (None, "bob", "MODIFY", "c")],
    "schema_privileges": [("root", "ann", "ALL_PRIVILEGES", "c", "s")],
    "table_privileges": [
        ("root", "ann", "ALL_PRIVILEGES", "c", "s", "t"),
        ("root", "ann", "ALL_PRIVILEGES", "c", "s", "t"),
        ("root", "eve", "SELECT", "x", "y", "z"),
    ],
    "routines": [
        ("c", "s", "f", "of", "FUNCTION", "SQL", "secret('scope1','key1')", None, "ann", "ann"),
        ("c", "s", "g", "og", "FUNCTION", "SQL", "md5(x)", None, "ann", "ann"),
        ("c", "s", "h", "oh", "FUNCTION", "SQL", None, None, "ann", "ann"),
    ],
    "routine_privileges": [
        ("root", "ann", "EXECUTE", "c", "s", "f"),
        (None, "bob", "ALL_PRIVILEGES", "c", "s", "f"),
        ("root", None, "EXECUTE", "c", "s", "g"),
    ],
}


@pytest.fixture
def metadata(spark):
    return {
        name: spark.createDataFrame(data, schemas.METADATA[name]) for name, data in METADATA.items()
    }


def test_owners_stand_in_where_no_grantor_is_recorded(metadata):
    assert rows(effective_grants(metadata, "Catalog")) == [
        ("ann", "ann", "SELECT", "c"),
        ("oc", "No Explicit Permissions", "MODIFY", "c"),
        ("od", "No Explicit Permissions", "ALL_PRIVILEGES", "d"),
        ("oe", "No Explicit Permissions", "ALL_PRIVILEGES", "e"),
    ]
    with pytest.raises(ValueError):
        effective_grants(metadata, "Volume")


def test_all_assets_are_distinct_and_include_unowned_grants(metadata):
    assets = rows(all_assets(metadata))
    assert assets.count(("c.s.t", "Table", "ann", "ALL_PRIVILEGES")) == 1
    assert ("x.y.z", "Table", "eve", "SELECT") in assets


def test_inheritance_ignores_the_case_of_types_only(spark):
    df = spark.createDataFrame(
        [("TABLE", "ALL_PRIVILEGES"), ("table", "all_privileges"), ("Function", "EXECUTE"), (None, None)],
        "type string, privilegeType string",
    )
    assert rows(expand_inheritance(df, privilege_lookup(spark))) == sorted(
        [
            ("TABLE", "ALL_PRIVILEGES", "SELECT"),
            ("TABLE", "ALL_PRIVILEGES", "MODIFY"),
            ("table", "all_privileges", None),
            ("Function", "EXECUTE", None),
            (None, None, None),
        ],
        key=repr,
    )


def test_the_lookup_has_its_23_rows(spark):
    counts = privilege_lookup(spark).groupBy("type").count()
    assert {row["type"]: row["count"] for row in counts.collect()} == {
        "Catalog": 11,
        "Schema": 9,
        "Table": 2,
        "Function": 1,
    }


def test_discovery_keeps_unknown_names_and_drops_untagged_ones(spark, metadata):
    now = datetime.datetime(2024, 1, 1)
    tags = spark.createDataFrame(
        [
            ("c", "Catalog", ["x", "y"], now),
            ("c.s", "Schema", [], now),
            ("c.s.t", "Table", None, now),
            ("x.y.z", "Table", ["pii"], now),
            ("d.s", "Schema", ["pii"], now),
        ],
        schemas.TAGS,
    )
    report = reports.discovery_report(tags, metadata, privilege_lookup(spark))
    assert report.columns == [
        "identifier",
        "type",
        "tags",
        "lastCheckedAt",
        "discoveryTags",
        "principal_owner",
        "principal",
        "privilegeType",
        "privilegeInheritance",
    ]
    short = report.select("identifier", "discoveryTags", "principal_owner", "principal", "privilegeType")
    nobody = "No Explicit Permissions"
    assert rows(short.distinct()) == [
        ("c", "x", "ann", "ann", "SELECT"),
        ("c", "x", "oc", nobody, "MODIFY"),
        ("c", "y", "ann", "ann", "SELECT"),
        ("c", "y", "oc", nobody, "MODIFY"),
        ("d.s", "pii", "ods", nobody, "ALL_PRIVILEGES"),
        ("x.y.z", "pii", None, None, None),
    ]
    assert report.filter("identifier = 'd.s'").count() == 9


def test_the_function_report_asks_for_the_grantee(spark, metadata):
    report = reports.function_report(metadata, privilege_lookup(spark)).select(
        "identifier", "principalOwner", "privilegeType", "permissionTo", "permissionFrom", "privilegeInheritance"
    )
    assert rows(report) == sorted(
        [
            ("c.s.f", "of", "EXECUTE", "ann", "root", None),
            ("c.s.f", "of", "ALL_PRIVILEGES", "bob", None, "EXECUTE"),
            ("c.s.g", "og", "ALL_PRIVILEGES", None, "root", "EXECUTE"),
            ("c.s.h", "oh", "ALL_PRIVILEGES", None, None, "EXECUTE"),
        ],
        key=repr,
    )


def test_shared_catalogs_and_unlisted_schemas_are_not_scanned(metadata):
    assert rows(enumerate_securables(metadata)) == [
        ("c", "Catalog"),
        ("c.s", "Schema"),
        ("c.s.t", "Table"),
        ("e", "Catalog"),
    ]


def test_audit_and_removal(spark, metadata):
    first = audit.routine_audit(metadata["routines"], F.lit("2024-01-01").cast("timestamp"))
    assert rows(first.select("routine_name", "isValid", "status")) == [
        ("f", True, "notAudited"),
        ("g", False, "notAudited"),
    ]
    plan = audit.removal_plan(first)
    assert rows(plan.select("toRemove", "action", "statement")) == [
        ("c.s.g", "remove", "DROP FUNCTION IF EXISTS `c`.`s`.`g`")
    ]
    second = audit.routine_audit(metadata["routines"], F.lit("2024-02-01").cast("timestamp"))
    marked = audit.mark_removed(first.unionByName(second), plan)
    assert rows(marked.select("routine_name", F.month("markedAt"), "status")) == [
        ("f", 1, "notAudited"),
        ("f", 2, "notAudited"),
        ("g", 1, "remove"),
        ("g", 2, "notAudited"),
    ]
    assert audit.removal_plan(marked).count() == 1
    assert audit.removal_plan(marked, include_history=True).count() == 2
    assert reports.function_validity_report(marked).columns[-1] == "lastCheckedAt"
    stamped = audit.routine_audit(metadata["routines"]).select("markedAt").distinct().collect()
    assert len(stamped) == 1 and stamped[0].markedAt is not None


def test_tag_payloads(spark):
    data = [
        ("a", 200, '{"tag_assignments": [{"tags": ["x", "y"]}, {"tags": ["z"]}]}'),
        ("b", 200, '{"tag_assignments": [{"other": 1}, {"tags": ["z"]}]}'),
        ("c", 200, '{"tag_assignments": []}'),
        ("d", 200, "{}"),
        ("e", 200, '{"tag_assignments": [{"tags": []}]}'),
        ("f", 500, "no JSON at all"),
        ("g", 200, None),
    ]
    df = spark.createDataFrame(data, "identifier string, status_code int, payload string")
    assert rows(payloads.parse_tag_payloads(df)) == [("a", ["x", "y"]), ("e", [])]
    broken = df.union(spark.createDataFrame([("h", 200, "{broken")], df.schema))
    with pytest.raises(Exception):
        payloads.parse_tag_payloads(broken).collect()
    assert payloads.parse_tag_payloads(broken, mode="PERMISSIVE").count() == 2


def test_collecting_one_table_per_catalog(spark):
    answer = '{"tag_assignments": [{"tags": ["x"]}]}'
    df = spark.createDataFrame(
        [(name, 200, answer) for name in ("a", "a.s", "a.s.t1", "a.s.t2", "b.s.t1")],
        "identifier string, status_code int, payload string",
    )
    collected = tagging.collect_tags(df, one_per_catalog=True)
    assert rows(collected.select("identifier", "type")) == [
        ("a", "Catalog"),
        ("a.s", "Schema"),
        ("a.s.t2", "Table"),
        ("b.s.t1", "Table"),
    ]
    assert collected.columns == schemas.TAGS.names


USERS = [
    '{"id": "1", "userName": "ann", "displayName": "Ann", "groups": [{"display": "g1"}, {"display": "g2"}],'
    ' "entitlements": [{"value": "own"}, {"value": "shared"}]}',
    '{"id": "2", "userName": "bob", "groups": [{"display": "g3"}], "entitlements": [{"value": "own"}]}',
    '{"id": "3", "userName": "cat", "groups": [{"display": "none"}]}',
    '{"id": "4", "userName": "dan"}',
    '{"id": "5", "userName": "eve", "groups": [{"display": "g4"}, {"display": "g4"}]}',
]
GROUPS = [
    '{"id": "a", "displayName": "g1", "members": [{"display": "Ann"}], "entitlements": [{"value": "shared"}]}',
    '{"id": "b", "displayName": "g2", "entitlements": [{"value": "shared"}, {"value": "more"}]}',
    '{"id": "c", "displayName": "g3"}',
    '{"id": "d", "displayName": "g4", "entitlements": [{"value": null}]}',
]


@pytest.fixture
def identities(spark):
    pages = ['{"Resources": [%s]}' % ", ".join(part) for part in (USERS[:3], USERS[3:])]
    landed = payloads.listed_resources(spark.createDataFrame([(p,) for p in pages], "payload string"))
    groups = spark.createDataFrame([(g,) for g in GROUPS], "payload string")
    return payloads.parse_users(landed), payloads.parse_groups(groups)


def test_identity_payloads(identities):
    users, groups = identities
    assert rows(users.filter("userId IN (1, 4)")) == [
        ("Ann", "ann", ["g1", "g2"], ["own", "shared"], "1"),
        (None, "dan", [], [], "4"),
    ]
    assert ("g1", ["Ann"], ["shared"], "a") in rows(groups)
    assert ("g3", [], [], "c") in rows(groups)


def test_entitlements(identities):
    found = {
        row.userName: (set(row.inherited_entitlements), sorted(row.final_entitlements, key=repr))
        for row in final_entitlements(*identities).collect()
    }
    assert found == {
        "ann": ({"shared", "more"}, ["more", "own", "shared"]),
        "bob": (set(), ["own"]),
        "cat": (set(), []),
        "dan": (set(), []),
        "eve": ({None}, [None]),
    }


def test_access_needs_a_group_an_entitlement_and_by_default_an_inherited_one(identities):
    pairs = [("ann", g, e) for g in ("g1", "g2") for e in ("own", "shared", "more")]
    eve = [("eve", "g4", None)]
    assert rows(principal_access(*identities)) == sorted(pairs + eve, key=repr)
    relaxed = principal_access(*identities, keep_uninherited=True)
    assert rows(relaxed) == sorted(pairs + eve + [("bob", "g3", "own")], key=repr)
    assert reports.principal_report(relaxed).columns == ["Principal", "Groups", "workspaceAccess"]


def test_entitlements_follow_the_record_not_the_id(spark):
    users = spark.createDataFrame(
        [("n", "u1", ["g"], [], "a"), ("n", "u2", ["h"], [], "a"), ("n", "u3", ["g"], [], None)],
        "displayName string, userName string, groups array<string>, entitlements array<string>, userId string",
    )
    groups = spark.createDataFrame(
        [("g", ["eg"]), ("h", ["eh"])], "displayName string, entitlements array<string>"
    )
    found = {tuple(r) for r in principal_access(users, groups).collect()}
    assert found == {("u1", "g", "eg"), ("u2", "h", "eh"), ("u3", "g", "eg")}
