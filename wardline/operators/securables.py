"""Securables in scope of a tag scan, and their types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline import schemas
from wardline.constants import CATALOG, SCHEMA, SHARED_CATALOG_TYPE, TABLE
from wardline.functions.names import identifier, name_part, securable_type


def enumerate_securables(
    metadata: Mapping[str, DataFrame], shared_type: str = SHARED_CATALOG_TYPE
) -> DataFrame:
    """``(identifier, type)`` of every catalog that is not shared in, its schemas and tables.

    A catalog without a type counts as not shared.
    """
    catalogs = metadata["catalogs"].filter(~F.col("catalog_type").eqNullSafe(shared_type))
    schemata = metadata["schemata"].join(
        catalogs.select("catalog_name"), "catalog_name", "left_semi"
    )
    listed = schemata.select(
        F.col("catalog_name").alias("table_catalog"), F.col("schema_name").alias("table_schema")
    )
    tables = metadata["tables"].join(listed, ["table_catalog", "table_schema"], "left_semi")

    def named(df: DataFrame, kind: str, key: tuple[str, ...]) -> DataFrame:
        return df.select(identifier(*key).alias("identifier"), F.lit(kind).alias("type"))

    return (
        named(catalogs, CATALOG, schemas.CATALOG_KEY)
        .unionByName(named(schemata, SCHEMA, schemas.SCHEMA_KEY))
        .unionByName(named(tables, TABLE, schemas.TABLE_KEY))
    )


def classify_securables(df: DataFrame, name: str = "identifier") -> DataFrame:
    """Add the ``type`` that each dotted name implies."""
    return df.withColumn("type", securable_type(name))


def one_table_per_catalog(tagged: DataFrame) -> DataFrame:
    """Tagged catalogs and schemas as they are, and of the tables the last of each catalog.

    One grouping over one reading: tables by catalog, any other row by itself, with a count so
    that repeated rows stay.
    """
    is_table = securable_type("identifier") == TABLE
    row = F.struct("identifier", "tags")
    kept = (
        tagged.filter(F.col("identifier").isNotNull())
        .groupBy(
            F.when(is_table, name_part("identifier", 1)).alias("catalog"),
            F.when(~is_table, row).alias("other"),
        )
        .agg(F.max(row).alias("row"), F.count(F.lit(1)).cast("int").alias("n"))
    )
    copies = F.when(F.col("other").isNull(), 1).otherwise(F.col("n"))
    return kept.select(F.explode(F.array_repeat("row", copies)).alias("row")).select("row.*")


def last_tagged_table(tagged: DataFrame) -> DataFrame:
    """One tagged table per catalog, the one whose name sorts last, with its tags."""
    return (
        tagged.filter(securable_type("identifier") == TABLE)
        .groupBy(name_part("identifier", 1).alias("catalog"))
        .agg(
            F.max("identifier").alias("identifier"),
            F.max_by("tags", "identifier").alias("tags"),
        )
        .select("identifier", "tags")
    )
