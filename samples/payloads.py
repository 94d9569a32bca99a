"""Array and JSON forms of the derived relations: stored tags and landed service answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samples.relations import Relations
from wardline.functions.names import securable_type


def tags_table(observations: DataFrame) -> DataFrame:
    """The tag table of some observations: the set of tags and the latest time per securable.

    Each tag is reduced to its latest time first, so that a securable with very many
    observations reaches the second grouping as one row per distinct tag.
    """
    return (
        observations.groupBy("identifier", "tag")
        .agg(F.max("ts").alias("ts"))
        .groupBy("identifier")
        .agg(F.collect_set("tag").alias("tags"), F.max("ts").alias("lastCheckedAt"))
        .select("identifier", securable_type("identifier").alias("type"), "tags", "lastCheckedAt")
    )


def stored_tags(relations: Relations) -> DataFrame:
    return tags_table(relations["stored_observations"])


def scanned_tags(relations: Relations) -> DataFrame:
    return tags_table(relations["scanned_observations"])


def tag_payloads(
    relations: Relations, observations: str = "scanned_observations", broken: bool = False
) -> DataFrame:
    """The tag service's answer for every securable.

    Names ending in 7 fail; untagged ones get an assignment without tags, or no assignment if
    their name ends in 3; a second assignment is there to be ignored. With ``broken``, answers for
    names ending in 5 are cut off and those for names ending in 9 are empty.
    """
    last = F.right("identifier", F.lit(1))
    scanned = tags_table(relations[observations]).select("identifier", "tags")
    other = F.array(F.lit("other"))
    assignments = (
        F.when(
            F.col("tags").isNotNull(),
            F.array(F.struct("tags"), F.struct(other.alias("tags"))),
        )
        .when(last == "3", F.array().cast("array<struct<tags: array<string>>>"))
        .otherwise(F.array(F.struct("tags")))
    )
    answer = F.to_json(F.struct(assignments.alias("tag_assignments")))
    if broken:
        answer = F.when(last == "5", F.left(answer, F.length(answer) - 2)).when(last != "9", answer)
    failed = last == "7"
    return relations["securables"].join(scanned, "identifier", "left").select(
        "identifier",
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
        F.when(failed, F.lit("service unavailable")).otherwise(answer).alias("payload"),
    )


def list_pages(relations: Relations) -> list[DataFrame]:
    """List answers of catalogs, schemas and tables, one resource a page."""

    def pages(relation: str, key: str, **fields: str) -> DataFrame:
        record = F.struct(*[F.col(column).alias(field) for field, column in fields.items()])
        page = F.to_json(F.struct(F.array(record).alias(key)))
        return relations[relation].select(page.alias("payload"))

    return [
        pages(
            "catalogs",
            "catalogs",
            name="catalog_name",
            owner="catalog_owner",
            catalog_type="catalog_type",
        ),
        pages(
            "schemata",
            "schemas",
            name="schema_name",
            catalog_name="catalog_name",
            owner="schema_owner",
        ),
        pages(
            "tables",
            "tables",
            name="table_name",
            catalog_name="table_catalog",
            schema_name="table_schema",
            owner="table_owner",
        ),
    ]


def _named_list(df: DataFrame, key: str, field: str, name: str) -> DataFrame:
    """One row per key with its (distinct, few) values as a list of one-field objects."""
    return df.groupBy(key).agg(F.collect_set(F.struct(field)).alias(name))


def user_payloads(relations: Relations, memberships: str = "user_groups") -> DataFrame:
    """One identity record per user; an empty list is left out of the record."""
    groups = _named_list(relations[memberships], "id", "display", "groups")
    direct = _named_list(relations["user_entitlements"], "id", "value", "entitlements")
    record = F.struct(
        "id",
        F.col("username").alias("userName"),
        F.col("displayname").alias("displayName"),
        "groups",
        "entitlements",
    )
    joined = relations["users"].join(groups, "id", "left").join(direct, "id", "left")
    return joined.select(F.to_json(record).alias("payload"))


def group_payloads(
    relations: Relations,
    named: str = "user_groups_named",
    members: str = "group_members",
    entitlements: str = "group_entitlements",
) -> DataFrame:
    """One identity record per group."""
    members = _named_list(relations[members], "displayname", "display", "members")
    passed_on = _named_list(relations[entitlements], "displayname", "value", "entitlements")
    record = F.struct(
        F.concat(F.lit("g-"), "displayname").alias("id"),
        F.col("displayname").alias("displayName"),
        "members",
        "entitlements",
    )
    joined = (
        relations[named]
        .join(members, "displayname", "left")
        .join(passed_on, "displayname", "left")
    )
    return joined.select(F.to_json(record).alias("payload"))


def team_payloads(relations: Relations) -> tuple[DataFrame, DataFrame]:
    """Identity records of users and of groups within groups."""
    return (
        user_payloads(relations, "team_users"),
        group_payloads(relations, "teams", "team_members", "team_entitlements"),
    )
