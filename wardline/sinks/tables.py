"""Saving, appending to, resetting and switching tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardline import schemas
from wardline.sources.tables import typed


def save(df: DataFrame, target: str, mode: str) -> None:
    """Write parquet; a ``target`` with a slash is a path, any other a table name."""
    writer = df.write.mode(mode).format("parquet")
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def append_audit(audit: DataFrame, target: str) -> None:
    """Add a run to the audit history, in the types of the history."""
    save(typed(audit, schemas.ROUTINE_AUDIT), target, "append")


def exists(spark: SparkSession, target: str) -> bool:
    """Whether there is a saved table of that name, or a folder at that path."""
    if "/" not in target:
        return spark.catalog.tableExists(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_partitions(df: DataFrame, target: str, by: str) -> None:
    """Replace the partitions that ``df`` has rows of; files of all others stay as they are.

    Rows are written aside first, so ``df`` may read the partitions that it replaces, and a job that
    fails while it writes changes nothing. Writing the same partitions again gives the same table.
    """
    spark = df.sparkSession
    writer = df.write.format("parquet").option("partitionOverwriteMode", "dynamic")
    if "/" in target:
        writer.mode("overwrite").partitionBy(by).save(target)
    elif spark.catalog.tableExists(target):
        # The table has kept the option it was created with.
        df.select(*spark.read.table(target).columns).write.mode("overwrite").insertInto(target)
    else:
        writer.partitionBy(by).saveAsTable(target)


def reset_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """Drop the table if it exists, create it empty, and return it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, source="parquet", schema=schema)
    return spark.read.table(name)


def insert_rows(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """Append literal rows, in the column order of the table."""
    schema = spark.read.table(name).schema
    spark.createDataFrame(rows, schema).write.insertInto(name)


def bucketing(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """The column and the number of buckets of a table that is bucketed by one column."""
    told = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name IN ('Bucket Columns', 'Num Buckets')")
    found = {row["col_name"]: row["data_type"] for row in told.collect()}
    if "Bucket Columns" not in found:
        return None
    return found["Bucket Columns"].strip("[]").strip("`"), int(found["Num Buckets"])


def _bucketed(df: DataFrame, version: str, buckets: tuple[str, int], name: str) -> None:
    """Write ``df`` in buckets to a folder, as the external table ``name``."""
    column, n = buckets
    writer = df.write.mode("errorifexists").format("parquet").bucketBy(n, column).sortBy(column)
    writer.option("path", version).saveAsTable(name)


def publish_version(
    df: DataFrame,
    table: str,
    folder: str,
    buckets: tuple[str, int] | None = None,
    label: str = "",
) -> str:
    """Make ``df`` the contents of ``table`` and return the folder it was written to.

    A table cannot be overwritten by a query that reads it. Each version therefore goes to a
    new folder under ``folder``, and the table is pointed at it once it is complete: a job
    that dies on the way leaves the table as it was. Older versions stay for readers that
    are still using them. Only one job at a time may write to the table.

    An existing table keeps its columns: ``df`` must have the same names and types, in any order,
    or nothing is written. ``buckets``, a column and a number, say how a new table is bucketed; all its
    versions then are. ``label`` becomes part of the version's name.
    """
    spark = df.sparkSession
    known_table = spark.catalog.tableExists(table)
    if known_table:
        buckets = bucketing(spark, table)
        known = spark.read.table(table).schema
        here, there = ({f.name: f.dataType for f in s.fields} for s in (df.schema, known))
        if here != there or len(df.columns) != len(known.names):
            raise ValueError(f"{table} has {known.simpleString()}, not {df.schema.simpleString()}")
        df = df.select(*known.names)
    version = f"{folder.rstrip('/')}/version-{label}{uuid.uuid4().hex}"
    if buckets and not known_table:
        _bucketed(df, version, buckets, table)
        return version
    if buckets:
        # Buckets can only be written by way of a table; dropping it leaves its files.
        written = f"{table}_{uuid.uuid4().hex}"
        _bucketed(df, version, buckets, written)
        spark.sql(f"DROP TABLE {written}")
    else:
        df.write.mode("errorifexists").parquet(version)
    if known_table:
        location = version.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=version, source="parquet", schema=df.schema)
    return version


def current_version(spark: SparkSession, table: str) -> str:
    """The name of the folder a table is pointed at."""
    location = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    return location.first()["data_type"].rstrip("/").rsplit("/", 1)[-1]


def remove_superseded(spark: SparkSession, table: str, folder: str, before: datetime) -> list[str]:
    """Delete what older jobs left under the table's ``folder``; returns what was deleted.

    That is every ``version-``, ``collected-`` and ``users-`` folder last written before the time
    ``before`` (with a zone), but never the current version. Choose a time before which no reader
    and no job that still runs has started.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    current = current_version(spark, table)
    removed = []
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        old = entry.getModificationTime() < before.timestamp() * 1000
        if old and name != current and name.startswith(("version-", "collected-", "users-")):
            files.delete(entry.getPath(), True)
            removed.append(name)
    return sorted(removed)
