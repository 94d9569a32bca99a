"""Tag answers that land in a folder, read once each and merged into the tag table.

The folder is read as a stream that takes what is there and ends, so a run reads only files that no
earlier run has seen. What was read is kept under the table's folder in ``answers``, a partition a
batch: those that could not be read stay there with the reason. The tags are merged from that
partition, and the version of the table that a batch publishes has the batch's number in its name. A run
that dies on the way is therefore simply started again: the batch's partition is replaced, and a
batch that the table's current version has already is not merged twice.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import schemas
from wardline.operators.securables import classify_securables, enumerate_securables
from wardline.plans.tagging import merge_into_table
from wardline.sinks.tables import current_version, write_partitions
from wardline.sources.payloads import tag_answers
from wardline.sources.tables import read_saved, typed

BATCH = "batch"


def latest_tags(answers: DataFrame) -> DataFrame:
    """Rows of the tag table from answers that were read: of each securable the tags that landed last.

    Of answers that landed at the same time the one whose tags sort last counts.
    """
    tagged = answers.where(F.col("reason").isNull() & F.col("tags").isNotNull())
    last = F.max(F.struct("landed_at", "tags")).alias("last")
    latest = tagged.groupBy("identifier").agg(last)
    return classify_securables(latest).select(
        "identifier",
        "type",
        F.col("last.tags").alias("tags"),
        F.col("last.landed_at").alias("lastCheckedAt"),
    )


def rejected_answers(spark: SparkSession, folder: str) -> DataFrame:
    """What could not be read, with the reason, of all batches that landed."""
    return read_saved(spark, f"{folder.rstrip('/')}/answers").where(F.col("reason").isNotNull())


def _merged_already(spark: SparkSession, table: str, batch: int) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    last = re.match(r"version-batch(\d+)-", current_version(spark, table))
    return last is not None and int(last[1]) >= batch


def merge_batch(
    spark: SparkSession,
    table: str,
    folder: str,
    answers: DataFrame,
    batch: int,
    metadata: Mapping[str, DataFrame],
    buckets: int = 0,
) -> bool:
    """Keep a batch of answers and merge its tags, unless the table has them; says whether it had not."""
    kept = f"{folder.rstrip('/')}/answers"
    if _merged_already(spark, table, batch):
        return False
    write_partitions(tag_answers(answers).withColumn(BATCH, F.lit(batch)), kept, BATCH)
    own = read_saved(spark, kept).where(F.col(BATCH) == batch)
    in_scope = enumerate_securables(metadata).select("identifier")
    found = latest_tags(own).join(in_scope, "identifier", "left_semi")
    merge_into_table(
        spark, table, folder, typed(found, schemas.TAGS), False, buckets, f"batch{batch}-"
    )
    return True


def refresh_from_landing(
    spark: SparkSession,
    table: str,
    folder: str,
    landing: str,
    metadata: Mapping[str, DataFrame],
    buckets: int = 0,
    files_per_batch: int | None = None,
) -> None:
    """Merge what has landed since the last run, in batches of at most ``files_per_batch`` files.

    ``landing`` is a folder of parquet files ``(identifier, status_code, payload, landed_at)``; a file must
    not change once it is there. Progress is kept under ``folder``. Only one run at a time.
    """
    reader = spark.readStream.schema(schemas.LANDED_ANSWER)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(answers: DataFrame, batch: int) -> None:
        merge_batch(spark, table, folder, answers, batch, metadata, buckets)

    writer = reader.parquet(landing).writeStream.foreachBatch(merge).trigger(availableNow=True)
    progress = f"{folder.rstrip('/')}/progress"
    writer.option("checkpointLocation", progress).start().awaitTermination()
