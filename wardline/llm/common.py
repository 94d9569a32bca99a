"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import scratch_folder

WORD = r"[^\x20\x09-\x0D]+"
# Bits of a sieve: 4 MB, whatever passes through it.
BITS = 1 << 25


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Rows of whole texts that a task hands to its Python worker at a time.
ROWS_A_BATCH = 1_000


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of few rows from now on.

    A batch of Spark's 10,000 rows holds tens of megabytes of text, several times over in the executor
    and in its workers, which keep the memory. A session that asks for less keeps what it asks for.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    known = int(spark.conf.get(name))
    if known <= 0 or known > ROWS_A_BATCH:
        spark.conf.set(name, ROWS_A_BATCH)


def read(spark, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def set_aside(docs: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` without any name an operator could use itself, and what gives the columns back.

    Columns in ``keep`` stay as they are; any other is called ``own_<number>`` until then.
    """
    names = {c: c if c in keep else f"own_{k}" for k, c in enumerate(docs.columns)}

    def quoted(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    renamed = docs.select(*[quoted(c).alias(name) for c, name in names.items()])
    return renamed, [F.col(name).alias(c) for c, name in names.items()]


def n_words(text: str) -> Column:
    """How many runs of characters other than ASCII white space a text column has."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: str = "doc_id", parts: int = 5) -> Column:
    """The part, 0 to ``parts - 1``, that a row's id puts it in; a null id is in part 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0))


def sieve(ids: DataFrame, bits: int = BITS) -> Callable[[Column], Column]:
    """A condition that holds for every value of the one column of ``ids``, and for few others.

    It is a Bloom filter of a fixed size, so it can be sent to all tasks. The more distinct values
    there are the more others pass, up to all of them; a join must follow that decides.
    """
    own = F.col(ids.columns[0])

    def places(column: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]

    words = (
        ids.select(F.explode(F.array(*places(own))).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("set"))
        .toArrow()
    )
    table = np.zeros(bits // 64, np.int64)
    table[np.array(words.column("word"))] = np.array(words.column("set"))
    shared = ids.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def passes(first: pa.Array, second: pa.Array) -> pa.Array:
        found = np.ones(len(first), np.int64)
        for at in (first.to_numpy(), second.to_numpy()):
            found &= shared.value[at >> 6] >> (at & 63)
        return pa.array(found == 1)

    return lambda column: passes(*places(column))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in the one column of ``dropped``; NULL equals NULL.

    Most rows that stay do not pass a sieve of what is dropped and are not shuffled; the join decides
    about the others. The columns may have any names.
    """
    dropped = dropped.select(F.col(dropped.columns[0]).alias("dropped"))
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    suspected = sieve(dropped)(F.col("row.doc_id"))
    rows = rows.select("row", suspected.alias("suspected"))
    decided = rows.where("suspected").join(
        dropped, F.col("row.doc_id").eqNullSafe(F.col("dropped")), "left_anti"
    )
    return rows.where("NOT suspected").unionByName(decided).select("row.*")
