"""Shards by fixed virtual slots and a versioned map from slots to shards.

A record is hashed to one of ``SLOTS`` slots, for ever. Which shard a slot is in says a table of
``SLOTS`` rows, written anew under a higher version whenever it is edited; records never move but
with their slot. The first version deals the slots out in turn, before anything is known of the
records. Whenever records are placed, the bytes in each slot are summed and ``rebalance`` edits the
map until shards have nearly equal bytes: slots move from full shards to empty ones, or to new
shards, and all others stay. The edited map is the next version.

Rows with one id and one text share a slot; rows that share only one of them need not.

What reaches the driver is the sums of the slots, at most ``SLOTS`` rows for any input.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import scratch_folder

SLOTS = 4096
SHARDS = 40
RECORD_BYTES = 16
MAP = "slot int, shard int"


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of every row of ``docs``.

    A null text has no bytes and the checksum 0. The slot comes from the id and the checksum, so
    rows without an id, or with the same one, still spread.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    records = docs.select(
        "doc_id",
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")
    return records.withColumn("virtual_slot", slot)


def slot_sizes(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of every slot that has any: at most as many entries as there are slots."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1)))
    return {slot: (size, rows) for slot, size, rows in sums.collect()}


def first_map(sizes: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """The emptiest shard takes the largest slot that is left; empty slots are dealt in turn."""
    heap = [(0, 0, shard) for shard in range(shards)]
    chosen = {}
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        size, n, shard = heapq.heappop(heap)
        chosen[slot] = shard
        heapq.heappush(heap, (size + sizes.get(slot, (0, 0))[0], n + 1, shard))
    return chosen


def rebalance(
    chosen: dict[int, int], sizes: dict[int, tuple[int, int]], shards: int
) -> dict[int, int]:
    """An edited map for ``shards`` shards, at least as many as before.

    The fullest shard that can gives its largest slot that fits to the emptiest shard, as long as
    that lowers the fuller of the two. Slots that need not move do not.
    """
    chosen, load = dict(chosen), dict.fromkeys(range(shards), 0)
    held: dict[int, set[int]] = {shard: set() for shard in load}
    for slot, shard in chosen.items():
        load[shard] += sizes.get(slot, (0, 0))[0]
        held[shard].add(slot)
    while True:
        low = min(load, key=lambda s: (load[s], s))
        for high in sorted(load, key=lambda s: (-load[s], s)):
            gap = load[high] - load[low]
            fits = [s for s in held[high] if 0 < sizes.get(s, (0, 0))[0] < gap]
            if fits:
                break
        else:
            return chosen
        half = [s for s in fits if 2 * sizes[s][0] <= gap] or fits
        slot = (max if 2 * sizes[half[0]][0] <= gap else min)(half, key=lambda s: (sizes[s][0], s))
        held[high].remove(slot)
        held[low].add(slot)
        load[high] -= sizes[slot][0]
        load[low] += sizes[slot][0]
        chosen[slot] = low


def write_map(spark: SparkSession, folder: str, version: int, chosen: dict[int, int]) -> None:
    """Store a map under its version; a version that exists is never written again."""
    rows = spark.createDataFrame(sorted(chosen.items()), MAP)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{folder}/version={version}")


def place(records: DataFrame, chosen: DataFrame, sizes: dict[int, tuple[int, int]]) -> DataFrame:
    """Add ``shard`` and ``slot``, the gapless place of a record in its shard from 0.

    Slots follow each other in a shard by number, and records in a slot by id and checksum, so a
    record's place is the rows of the slots before its own plus its rank in one slot. The map is
    broadcast: it has as many rows as there are slots, whatever the input.
    """
    before, at = {}, {}
    for slot, shard in sorted((r["slot"], r["shard"]) for r in chosen.collect()):
        before[slot] = at.get(shard, 0)
        at[shard] = before[slot] + sizes.get(slot, (0, 0))[1]
    spark = records.sparkSession
    start = spark.createDataFrame(
        sorted(before.items()), "start_slot int, start long"
    )
    table = chosen.join(F.broadcast(start), F.col("slot") == F.col("start_slot"))
    table = table.select(F.col("slot").alias("virtual_slot"), "shard", "start")
    own = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("rank", F.row_number().over(own) - 1)
        .join(F.broadcast(table), "virtual_slot")
        .withColumn("slot", F.col("start") + F.col("rank"))
        .drop("start", "rank")
    )


def shard_documents(
    docs: DataFrame, folder: str, shards: int = SHARDS, version: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, virtual_slot, shard, slot``.

    Edits the map of ``version`` below ``folder`` for these records and for ``shards`` shards, at least
    as many as it has, and writes it as the next version; without a version, a map dealt out in turn
    is written as version 1 first. A null text counts as empty, a null id is an id like any other,
    repeated rows share a slot and follow each other, other columns are not read. Without rows the
    result is empty and the map stays as it was.
    """
    spark, records = docs.sparkSession, with_slots(docs)
    sizes = slot_sizes(records)
    if version is None:
        version = 1
        write_map(spark, folder, version, first_map({}, shards))
    known = {r["slot"]: r["shard"] for r in read_map(spark, folder, version).collect()}
    write_map(spark, folder, version + 1, rebalance(known, sizes, shards))
    return place(records, read_map(spark, folder, version + 1), sizes)


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return shard_documents(docs, scratch_folder(spark, "slot-map")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
