"""Metadata relations and saved tables, by folder or by catalog name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline import schemas


def read_saved(spark: SparkSession, source: str, schema: StructType | None = None) -> DataFrame:
    """Read a saved table; a ``source`` with a slash is a parquet path, any other a table name."""
    if "/" not in source:
        return spark.read.table(source)
    stored = spark.read.parquet(source)
    return stored if schema is None else typed(stored, schema)


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; fails if ``df`` lacks one.

    Times without a zone are times of the session's zone.
    """
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns {', '.join(missing)} are missing")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def read_metadata(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """The metadata relations under a folder of parquet tables or a catalog schema.

    Every column of ``schemas.METADATA`` must be there; types such as that of a time are cast.
    """
    if "/" in source:
        root = source.rstrip("/")
        return {
            name: read_saved(spark, f"{root}/{name}", schema)
            for name, schema in schemas.METADATA.items()
        }
    return {
        name: typed(read_saved(spark, f"{source}.{name}"), schema)
        for name, schema in schemas.METADATA.items()
    }


def routines_with_definition(routines: DataFrame) -> DataFrame:
    """The routines whose definition is visible, with the columns an audit keeps."""
    return routines.select(*schemas.AUDITED_ROUTINE).filter(
        F.col("routine_definition").isNotNull()
    )


def routines_like(routines: DataFrame, pattern: str) -> DataFrame:
    """Inventory of the routines whose name matches a ``LIKE`` pattern (case-sensitive)."""
    return routines.filter(F.col("routine_name").like(pattern)).select(
        *schemas.ROUTINE_KEY,
        "routine_owner",
        "routine_definition",
        "created",
        "created_by",
        "last_altered_by",
    )
