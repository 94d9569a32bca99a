"""Who holds which privilege on which securable: by ownership, by grant, by inheritance."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import schemas
from wardline.constants import (
    ALL_PRIVILEGES,
    CATALOG,
    NO_EXPLICIT_PERMISSIONS,
    SCHEMA,
    TABLE,
)
from wardline.functions.names import identifier
from wardline.operators.joins import left_join_many

# Per level: type, relation, owner column, grant relation, key columns of both.
LEVELS = (
    (
        CATALOG,
        "catalogs",
        "catalog_owner",
        "catalog_privileges",
        schemas.CATALOG_KEY,
    ),
    (
        SCHEMA,
        "schemata",
        "schema_owner",
        "schema_privileges",
        schemas.SCHEMA_KEY,
    ),
    (
        TABLE,
        "tables",
        "table_owner",
        "table_privileges",
        schemas.TABLE_KEY,
    ),
)


def effective_principal(owner: str) -> dict[str, Column]:
    """Report columns of an owned securable joined to its grants.

    The owner stands in wherever no grantor is recorded, also for a grant without one; the
    privilege is the grant's own if there is a grant, and all privileges otherwise.
    """
    granted = F.col("grantor").isNotNull()
    return {
        "principal_owner": F.when(granted, F.col("grantee")).otherwise(F.col(owner)),
        "principal": F.when(granted, F.col("grantee")).otherwise(F.lit(NO_EXPLICIT_PERMISSIONS)),
        "privileges_type": F.coalesce("privilege_type", F.lit(ALL_PRIVILEGES)),
    }


def effective_grants(metadata: Mapping[str, DataFrame], level: str) -> DataFrame:
    """Every securable of a level with each of its grants, or with its owner if it has none."""
    for kind, relation, owner, privileges, key in LEVELS:
        if kind == level:
            owned = metadata[relation].select(*key, owner)
            granted = metadata[privileges].select(*schemas.GRANT, *key)
            joined = left_join_many(owned, granted, {name: name for name in key})
            effective = effective_principal(owner)
            return joined.select(*[c.alias(name) for name, c in effective.items()], *key)
    raise ValueError(f"no level {level!r}")


def owned_securables(metadata: Mapping[str, DataFrame]) -> DataFrame:
    """``(identifier, type, owner)`` of every catalog, schema and table."""
    levels = [
        metadata[relation].select(
            identifier(*key).alias("identifier"),
            F.lit(kind).alias("type"),
            F.col(owner).alias("owner"),
        )
        for kind, relation, owner, _, key in LEVELS
    ]
    return reduce(DataFrame.unionByName, levels)


def granted_securables(metadata: Mapping[str, DataFrame]) -> DataFrame:
    """``(identifier, type, grantor, grantee, privilege_type)`` of every grant on one of them."""
    levels = [
        metadata[privileges].select(
            identifier(*key).alias("identifier"), F.lit(kind).alias("type"), *schemas.GRANT
        )
        for kind, _, _, privileges, key in LEVELS
    ]
    return reduce(DataFrame.unionByName, levels)


def all_assets(metadata: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct ``(identifier, type, principal, privilegeType)`` over owners and grantees."""
    owners = owned_securables(metadata).select(
        "identifier",
        "type",
        F.col("owner").alias("principal"),
        F.lit(ALL_PRIVILEGES).alias("privilegeType"),
    )
    grantees = granted_securables(metadata).select(
        "identifier",
        "type",
        F.col("grantee").alias("principal"),
        F.col("privilege_type").alias("privilegeType"),
    )
    return owners.unionByName(grantees).distinct()


def expand_inheritance(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add ``privilegeInheritance``: one row per privilege that ``privilegeType`` contains.

    Privileges the lookup does not list keep one row with NULL. The lookup carries no broadcast
    hint: Spark broadcasts it while it is small, and shuffles if someone passes a large one.
    """
    contained = lookup.select(
        F.lower("type").alias("__type"),
        F.col("privilegeType").alias("__privilege"),
        "privilegeInheritance",
    )
    return df.join(
        contained,
        (F.lower(df["type"]) == F.col("__type")) & (df["privilegeType"] == F.col("__privilege")),
        "left",
    ).drop("__type", "__privilege")
