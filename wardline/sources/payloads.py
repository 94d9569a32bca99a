"""Landed JSON answers of the tag and identity services, parsed on the executors.

A payload that is not valid JSON fails the job by default; pass ``mode="PERMISSIVE"`` to
read such a payload as an empty record instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline import schemas


def _parsed(schema: str, mode: str) -> Column:
    return F.from_json("payload", schema, {"mode": mode})


def _field_list(array: str, field: str) -> Column:
    """One field of every element; an absent array counts as empty."""
    return F.coalesce(
        F.transform(array, lambda item: item[field]), F.array().cast("array<string>")
    )


def parse_tag_payloads(payloads: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``(identifier, status_code, payload)`` to ``(identifier, tags)`` of tagged securables.

    Only successful answers are read, and of those only the first tag assignment. It is taken
    out by exploding a list of at most one, since a filter on the parsed value itself would
    make Spark parse every payload twice.
    """
    first = F.slice(_parsed(schemas.TAG_PAYLOAD, mode)["tag_assignments"], 1, 1)
    return (
        payloads.filter(F.col("status_code") == 200)
        .select("identifier", F.explode(first).alias("assignment"))
        .select("identifier", F.col("assignment.tags").alias("tags"))
        .filter(F.col("tags").isNotNull())
    )


def tag_answers(answers: DataFrame) -> DataFrame:
    """Every answer with its ``tags``, or with the ``reason`` why it could not be read.

    All columns are kept but ``payload`` of an answer that was read. ``reason`` is NULL for those; else
    ``status`` with the code, ``no answer`` or ``malformed``. A securable without tags has been read and
    has none: both are NULL. Each payload is parsed once.
    """
    read = F.col("status_code").eqNullSafe(200)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}
    # NULL in, NULL out: an answer that failed is not parsed.
    parsed = F.from_json(
        F.when(read, F.col("payload")), f"{schemas.TAG_PAYLOAD}, __corrupt STRING", options
    )
    reason = (
        F.when(~read, F.concat(F.lit("status "), F.coalesce(F.col("status_code").cast("string"), F.lit("unknown"))))
        .when(F.coalesce(F.trim("payload"), F.lit("")) == "", F.lit("no answer"))
        .when(F.col("__corrupt").isNotNull(), F.lit("malformed"))
    )
    whole = F.coalesce(parsed, F.from_json(F.lit("{}"), f"{schemas.TAG_PAYLOAD}, __corrupt STRING"))
    first = F.try_element_at("tag_assignments", F.lit(1))["tags"]
    found = answers.select("*", F.inline(F.array(whole))).withColumn("reason", reason)
    kept = [name for name in answers.columns if name != "payload"]
    return found.select(
        *kept,
        F.when(F.col("reason").isNull(), first).alias("tags"),
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("payload")).alias("payload"),
    )


def listed_resources(
    pages: DataFrame, mode: str = "FAILFAST", key: str = "Resources"
) -> DataFrame:
    """List answers ``{key: [...]}`` to one ``payload`` row per resource."""
    resources = _parsed(f"`{key}` ARRAY<STRING>", mode)[key]
    return pages.select(F.explode(resources).alias("payload"))


def _records(payloads: DataFrame, schema: str, mode: str) -> DataFrame:
    """One row per payload with the payload's fields as columns.

    The record is taken out by a generator: conditions on its fields, such as those Spark
    derives from a join, then stay above the parser instead of parsing once more below it.
    """
    return payloads.select(F.inline(F.array(_parsed(schema, mode))))


def listed_metadata(
    catalogs: DataFrame, schemata: DataFrame, tables: DataFrame, mode: str = "FAILFAST"
) -> dict[str, DataFrame]:
    """The metadata relations of landed list answers of the three levels."""

    def listed(pages: DataFrame, key: str, schema: StructType, **names: str) -> DataFrame:
        fields = ", ".join(f"{field} STRING" for field in names.values())
        records = _records(listed_resources(pages, mode, key), fields, mode)
        return records.select(*[F.col(names[name]).alias(name) for name in schema.names])

    return {
        "catalogs": listed(
            catalogs,
            "catalogs",
            schemas.METADATA["catalogs"],
            catalog_name="name",
            catalog_owner="owner",
            catalog_type="catalog_type",
        ),
        "schemata": listed(
            schemata,
            "schemas",
            schemas.METADATA["schemata"],
            catalog_name="catalog_name",
            schema_name="name",
            schema_owner="owner",
        ),
        "tables": listed(
            tables,
            "tables",
            schemas.METADATA["tables"],
            table_catalog="catalog_name",
            table_schema="schema_name",
            table_name="name",
            table_owner="owner",
        ),
    }


def parse_users(payloads: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """One user per payload: names, group names and direct entitlements."""
    return _records(payloads, schemas.USER_PAYLOAD, mode).select(
        "displayName",
        "userName",
        _field_list("groups", "display").alias("groups"),
        _field_list("entitlements", "value").alias("entitlements"),
        F.col("id").alias("userId"),
    )


def parse_groups(payloads: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """One group per payload: name, member names and the entitlements it passes on."""
    return _records(payloads, schemas.GROUP_PAYLOAD, mode).select(
        "displayName",
        _field_list("members", "display").alias("members"),
        _field_list("entitlements", "value").alias("entitlements"),
        F.col("id").alias("groupId"),
    )
