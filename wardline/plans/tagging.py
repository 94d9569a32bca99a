"""Collecting tags from landed payloads and merging them into the tag table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import schemas
from wardline.operators.merge import merge_outcome, merge_upsert
from wardline.operators.securables import (
    classify_securables,
    enumerate_securables,
    one_table_per_catalog,
)
from wardline.sinks.tables import bucketing, publish_version, save
from wardline.sources.payloads import parse_tag_payloads
from wardline.sources.tables import read_saved, typed

MERGE_KEYS = {"identifier": "identifier"}


def union_tags(catalogs: DataFrame, schemata: DataFrame, tables: DataFrame) -> DataFrame:
    """Tag rows of the three levels as one."""
    return catalogs.unionByName(schemata).unionByName(tables)


def collect_tags(
    payloads: DataFrame,
    securables: DataFrame | None = None,
    as_of: Column | None = None,
    one_per_catalog: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Rows of the tag table for the tagged securables, of ``securables`` only if given.

    ``one_per_catalog`` keeps a single table per catalog, as a scan that remembers only the
    last table it saw would.
    """
    tagged = parse_tag_payloads(payloads, mode)
    if securables is not None:
        # After parsing: most securables carry no tags, and tags are smaller than payloads.
        tagged = tagged.join(securables.select("identifier"), "identifier", "left_semi")
    if one_per_catalog:
        tagged = one_table_per_catalog(tagged)
    return classify_securables(tagged).select(
        "identifier",
        "type",
        "tags",
        (F.current_timestamp() if as_of is None else as_of).alias("lastCheckedAt"),
    )


def _not_older(target, source) -> Column:
    return source("lastCheckedAt") >= target("lastCheckedAt")


def merge_tags(
    stored: DataFrame, collected: DataFrame, refresh_time: bool = False, colocated: bool = False
) -> DataFrame:
    """New contents of the tag table.

    A known securable gets the collected tags unless they are older than the stored ones; its
    stored time stays as it was first written unless ``refresh_time`` is set. A new securable
    is added as collected. ``colocated`` leaves the stored side where it is, if it is bucketed by
    ``identifier``.
    """
    set_columns = {"tags": "tags"}
    if refresh_time:
        set_columns["lastCheckedAt"] = "lastCheckedAt"
    return merge_upsert(
        stored, collected.select(*schemas.TAGS.names), MERGE_KEYS, set_columns, _not_older, colocated
    )


def merge_tags_outcome(stored: DataFrame, collected: DataFrame) -> DataFrame:
    """What :func:`merge_tags` does with each securable."""
    return merge_outcome(stored, collected, MERGE_KEYS, _not_older)


def refresh_tag_table(
    spark: SparkSession,
    table: str,
    folder: str,
    payloads: DataFrame,
    metadata: Mapping[str, DataFrame],
    as_of: Column | None = None,
    refresh_time: bool = False,
    buckets: int = 0,
) -> str:
    """One run of the tag job: collect, merge, and publish the tag table's next version.

    The collected tags are written under ``folder`` first: all parts of the merge must see the same run
    time. The first run creates the table, in ``buckets`` buckets by ``identifier`` if there is a number;
    the stored side of every later merge is then not shuffled, and each version keeps the buckets.
    """
    landed = f"{folder.rstrip('/')}/collected-{uuid.uuid4().hex}"
    found = collect_tags(payloads, enumerate_securables(metadata), as_of)
    save(typed(found, schemas.TAGS), landed, "errorifexists")
    collected = read_saved(spark, landed, schemas.TAGS)
    return merge_into_table(spark, table, folder, collected, refresh_time, buckets)


def merge_into_table(
    spark: SparkSession,
    table: str,
    folder: str,
    collected: DataFrame,
    refresh_time: bool = False,
    buckets: int = 0,
    label: str = "",
) -> str:
    """Publish the tag table's next version, with the collected tags merged into it."""
    key = MERGE_KEYS["identifier"]
    colocated = False
    if spark.catalog.tableExists(table):
        stored = read_saved(spark, table)
        known = bucketing(spark, table)
        colocated = known is not None and known[0] == key
    else:
        stored = spark.createDataFrame([], schemas.TAGS)
    merged = merge_tags(stored, collected, refresh_time, colocated)
    return publish_version(merged, table, folder, (key, buckets) if buckets else None, label)
