"""Groups within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import scratch_folder


def containing_groups(groups: DataFrame) -> DataFrame:
    """``(group, above)``: every group with each other group it is in, directly or through others.

    ``groups`` has ``displayName`` and ``members``; members that are no group are left out. In each round
    the pairs found last are continued by all pairs known so far, so a chain takes as many rounds as its
    length has binary digits; pairs that are known are dropped, so a cycle ends. Rounds are
    written to the shared folder, and a plan never holds more than one of them.
    """
    spark, folder = groups.sparkSession, scratch_folder(groups.sparkSession, "groups")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    known = groups.select(F.col("displayName").alias("group")).distinct()
    pairs = (
        groups.select(F.explode("members").alias("group"), F.col("displayName").alias("above"))
        .where(F.col("group") != F.col("above"))
        .join(known, "group", "left_semi")
        .distinct()
    )
    reached = found = stored(pairs, "round-0")
    rounds = 0
    while not found.isEmpty():
        rounds += 1
        step = reached.select(F.col("group").alias("middle"), F.col("above").alias("further"))
        longer = (
            found.join(step, F.col("above") == F.col("middle"))
            .select("group", F.col("further").alias("above"))
            .where(F.col("group") != F.col("above"))
            .distinct()
        )
        found = stored(longer.join(reached, ["group", "above"], "left_anti"), f"round-{rounds}")
        reached = reached.unionByName(found)
    return reached
