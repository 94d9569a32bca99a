"""Schemas of every relation the library reads or writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


CATALOG_KEY = ("catalog_name",)
SCHEMA_KEY = ("catalog_name", "schema_name")
TABLE_KEY = ("table_catalog", "table_schema", "table_name")
ROUTINE_KEY = ("routine_catalog", "routine_schema", "routine_name")

GRANT = ("grantor", "grantee", "privilege_type")

METADATA = {
    "catalogs": strings(*CATALOG_KEY, "catalog_owner", "catalog_type"),
    "schemata": strings(*SCHEMA_KEY, "schema_owner"),
    "tables": strings(*TABLE_KEY, "table_owner"),
    "catalog_privileges": strings(*GRANT, *CATALOG_KEY),
    "schema_privileges": strings(*GRANT, *SCHEMA_KEY),
    "table_privileges": strings(*GRANT, *TABLE_KEY),
    "routines": strings(
        *ROUTINE_KEY,
        "routine_owner",
        "routine_type",
        "routine_body",
        "routine_definition",
        "created",
        "created_by",
        "last_altered_by",
    ),
    "routine_privileges": strings(*GRANT, *ROUTINE_KEY),
}

TAGS = StructType(
    [
        StructField("identifier", StringType()),
        StructField("type", StringType()),
        StructField("tags", ArrayType(StringType())),
        StructField("lastCheckedAt", TimestampType()),
    ]
)

LANDED_ANSWER = StructType(
    [
        StructField("identifier", StringType()),
        StructField("status_code", IntegerType()),
        StructField("payload", StringType()),
        StructField("landed_at", TimestampType()),
    ]
)

PRIVILEGE_LOOKUP = strings("type", "privilegeType", "privilegeInheritance")

AUDITED_ROUTINE = (
    *ROUTINE_KEY,
    "routine_owner",
    "routine_definition",
    "created_by",
    "last_altered_by",
)

ROUTINE_AUDIT = StructType(
    [
        *strings(*AUDITED_ROUTINE, "isFunctionValid", "isSecretValid").fields,
        StructField("isValid", BooleanType()),
        StructField("markedAt", TimestampType()),
        StructField("status", StringType()),
    ]
)

# The partition of a stored audit: a run's time in microseconds, so that no time zone is in its name.
RUN = "run"

PRINCIPAL_ACCESS = strings("userName", "Groups", "entitlements")

KEYS = strings("scope", "key", "secret")

# JSON payloads: only the fields that are read, so that parsing skips the rest.
TAG_PAYLOAD = "tag_assignments ARRAY<STRUCT<tags: ARRAY<STRING>>>"
USER_PAYLOAD = (
    "id STRING, userName STRING, displayName STRING,"
    " groups ARRAY<STRUCT<display: STRING>>, entitlements ARRAY<STRUCT<value: STRING>>"
)
GROUP_PAYLOAD = (
    "id STRING, displayName STRING,"
    " members ARRAY<STRUCT<display: STRING>>, entitlements ARRAY<STRUCT<value: STRING>>"
)
