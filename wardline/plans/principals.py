"""The job behind the principal report: from landed identity records to the access table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wardline.operators.entitlements import principal_access
from wardline.sinks.tables import publish_version, save
from wardline.sources.payloads import parse_groups, parse_users
from wardline.sources.tables import read_saved


def refresh_access_table(
    spark: SparkSession,
    table: str,
    folder: str,
    user_payloads: DataFrame,
    group_payloads: DataFrame,
    keep_uninherited: bool = False,
    nested: bool = False,
) -> str:
    """Replace the contents of the access table.

    The parsed users are written under ``folder`` first. Memberships and users are then both
    read from there, each with its own columns, and the records are parsed once. ``nested`` also
    follows groups that are members of groups.
    """
    parsed = parse_users(user_payloads)
    landed = f"{folder.rstrip('/')}/users-{uuid.uuid4().hex}"
    save(parsed, landed, "errorifexists")
    users = read_saved(spark, landed, parsed.schema)
    access = principal_access(users, parse_groups(group_payloads), keep_uninherited, nested)
    return publish_version(access, table, folder)
