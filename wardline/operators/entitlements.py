"""Entitlements of users: direct ones, and those their groups pass on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.membership import containing_groups


def _passed_on(users: DataFrame, groups: DataFrame, nested: bool = False) -> DataFrame:
    """``(__groups, inherited)`` of every list of groups that passes on anything.

    What is inherited depends on the list alone, so each distinct list is worked out once.
    Membership is a join, so a group in very many lists is split like any hot key. The sets
    are built on the map side first and hold distinct entitlements only.
    """
    lists = users.select(F.col("groups").alias("__groups")).distinct()
    memberships = lists.select("__groups", F.explode(F.array_distinct("__groups")).alias("__group"))
    passed_on = groups.select("displayName", F.explode("entitlements").alias("value")).distinct()
    if nested:
        above = containing_groups(groups)
        through = above.join(passed_on, F.col("above") == F.col("displayName")).select(
            F.col("group").alias("displayName"), "value"
        )
        passed_on = passed_on.unionByName(through).distinct()
    inherited = memberships.join(
        passed_on, memberships["__group"].eqNullSafe(passed_on["displayName"]), "inner"
    )
    # A set of structs keeps an entitlement without a name, which a set of strings would lose.
    return (
        inherited.groupBy("__groups")
        .agg(F.collect_set(F.struct("value")).alias("__set"))
        .select("__groups", F.transform("__set", lambda item: item["value"]).alias("inherited"))
    )


def inherited_entitlements(
    users: DataFrame, groups: DataFrame, nested: bool = False
) -> DataFrame:
    """``(userId, inherited_entitlements)`` of every user record that inherits any.

    Records are taken one by one: an id that is absent or repeated changes nothing. With ``nested``,
    a group also passes on what the groups have that it is a member of, through any number of groups.
    """
    known = _passed_on(users, groups, nested)
    return users.join(known, users["groups"].eqNullSafe(known["__groups"]), "inner").select(
        "userId", F.col("inherited").alias("inherited_entitlements")
    )


def final_entitlements(users: DataFrame, groups: DataFrame, nested: bool = False) -> DataFrame:
    """Users with ``inherited_entitlements`` and the union with their own, both never NULL."""
    nothing = F.array().cast("array<string>")
    known = _passed_on(users, groups, nested)
    joined = users.join(known, users["groups"].eqNullSafe(known["__groups"]), "left")
    inherited = F.coalesce("inherited", nothing)
    return joined.select(
        *users.columns,
        inherited.alias("inherited_entitlements"),
        F.array_union("entitlements", inherited).alias("final_entitlements"),
    )


def principal_access(
    users: DataFrame, groups: DataFrame, keep_uninherited: bool = False, nested: bool = False
) -> DataFrame:
    """Distinct ``(userName, Groups, entitlements)`` rows.

    A user without groups or without entitlements has no row. Neither has one who inherits
    nothing, unless ``keep_uninherited`` is set.

    A record becomes as many rows as it has groups times entitlements. It is therefore dealt out while
    it is still one row, to a number of tasks that is not lowered for a small input.
    """
    known = final_entitlements(users, groups, nested)
    granted = F.col("final_entitlements")
    if not keep_uninherited:
        # Emptied here and not filtered by what is joined on: Spark would take the join for an inner
        # one, and could send all users to the tasks that hold the few lists.
        granted = F.filter(granted, lambda _: F.size("inherited_entitlements") > 0)
    parts = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    record = ["userId", "userName", "groups"]
    return (
        known.select(*record, granted.alias("granted"))
        .repartition(parts, *record)
        .select("userName", F.explode("groups").alias("Groups"), "granted")
        .select("userName", "Groups", F.explode("granted").alias("entitlements"))
        .distinct()
    )
