"""The five governance reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline import schemas
from wardline.constants import ALL_PRIVILEGES, FUNCTION
from wardline.functions.names import identifier
from wardline.operators.grants import (
    effective_principal,
    expand_inheritance,
    granted_securables,
    owned_securables,
)
from wardline.operators.grants import all_assets as _all_assets
from wardline.operators.joins import left_join_many


def tagged_grants(tags: DataFrame, metadata: Mapping[str, DataFrame]) -> DataFrame:
    """Every tagged securable, its list of tags, and each principal and privilege on it.

    A tagged name that is no known securable keeps one row with NULL principals. Tagged names with
    dots of their own must be written as :func:`identifier` writes them.
    """
    tagged = tags.filter(F.size("tags") > 0)
    owned = owned_securables(metadata).withColumn("owned", F.lit(True))
    known = tagged.join(owned, ["identifier", "type"], "left").withColumn(
        # Grants on something that is no known securable must find no partner.
        "grant_key",
        F.when(F.col("owned"), F.col("identifier")),
    )
    possible_keys = tagged.select(
        F.explode(F.array("identifier", F.lit(None))).alias("grant_key"), "type"
    )
    joined = left_join_many(
        known,
        granted_securables(metadata),
        {"grant_key": "identifier", "type": "type"},
        left_keys=possible_keys,
    )
    effective = effective_principal("owner")
    return joined.select(
        *tags.columns,
        F.when(F.col("owned"), effective["principal_owner"]).alias("principal_owner"),
        F.when(F.col("owned"), effective["principal"]).alias("principal"),
        F.when(F.col("owned"), effective["privileges_type"]).alias("privilegeType"),
    )


def discovery_report(
    tags: DataFrame, metadata: Mapping[str, DataFrame], lookup: DataFrame
) -> DataFrame:
    """Tag, securable, principal, privilege and the privileges it contains.

    Tags are exploded last: until then a securable travels once rather than once per tag.
    """
    return expand_inheritance(tagged_grants(tags, metadata), lookup).select(
        *tags.columns,
        F.explode("tags").alias("discoveryTags"),
        "principal_owner",
        "principal",
        "privilegeType",
        "privilegeInheritance",
    )


def all_assets_report(metadata: Mapping[str, DataFrame], lookup: DataFrame) -> DataFrame:
    """Every securable with its owner and grantees, and the privileges each privilege contains."""
    return expand_inheritance(_all_assets(metadata), lookup)


def function_report(metadata: Mapping[str, DataFrame], lookup: DataFrame) -> DataFrame:
    """Every routine with its definition and each grant on it, or its owner's privileges."""
    routines = metadata["routines"].select(
        *schemas.ROUTINE_KEY, "routine_owner", "routine_type", "routine_body", "routine_definition"
    )
    grants = metadata["routine_privileges"].select(*schemas.ROUTINE_KEY, *schemas.GRANT)
    joined = left_join_many(routines, grants, {name: name for name in schemas.ROUTINE_KEY})
    granted = F.col("grantee").isNotNull()
    report = joined.select(
        identifier(*schemas.ROUTINE_KEY).alias("identifier"),
        F.col("routine_owner").alias("principalOwner"),
        F.when(granted, F.col("privilege_type"))
        .otherwise(F.lit(ALL_PRIVILEGES))
        .alias("privilegeType"),
        "routine_type",
        "routine_body",
        "routine_definition",
        F.col("grantee").alias("permissionTo"),
        F.col("grantor").alias("permissionFrom"),
        F.lit(FUNCTION).alias("type"),
    )
    return expand_inheritance(report, lookup)


def function_validity_report(audit: DataFrame) -> DataFrame:
    """The routine audit, with the time of marking also under the name reports use."""
    return audit.withColumn("lastCheckedAt", F.col("markedAt"))


def principal_report(access: DataFrame) -> DataFrame:
    """Principals, their groups and their workspace access."""
    return access.select(
        F.col("userName").alias("Principal"),
        F.col("Groups"),
        F.col("entitlements").alias("workspaceAccess"),
    )
