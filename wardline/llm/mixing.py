"""Mixing sources to target weights by capped water-filling.

The words of all sources are shared out by weight. A source whose share is above ``MAX_EPOCHS``
times its size is clamped there, and what is left is shared among the others by weight, until no
share is too large. Each round is one aggregation over the table of sources that returns two
sums; the table itself never leaves the executors.

A target of 2.4 times a source means every document twice and four tenths of the source once
more. For that, documents are put in a seeded order and taken until the words are used up; the
document at the edge is taken in part. The order comes from a digest of the id whose first digits
name one of 65,536 buckets. Sums of buckets tell in which bucket the edge of a source lies, so
only that one bucket is ever sorted, and the texts themselves are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import WORD, n_words, set_aside, stored

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``place``, the number of the source by code point from 0, null last."""
    by_name = F.col("source").asc_nulls_last()
    parts = stored(
        sources.orderBy(by_name).withColumn("part", F.spark_partition_id()), "sources"
    )
    # As many rows as the sort had partitions.
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(by_name)) - 1
    return (
        parts.withColumn("rank", rank)
        .join(starts, "part")
        .select("source", "source_size", (F.col("start") + F.col("rank")).alias("place"))
    )


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Add ``target``, in words, to the distinct ``source, source_size``."""
    turns = F.array(*[F.lit(w) for w in weights])
    table = stored(
        _ranked(sources).select(
            "source",
            "source_size",
            F.element_at(turns, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * max_epochs).alias("most"),
        ),
        "weights",
    )
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = total or 0, weight or 0

    def above(words: int, parts: int):
        big = "decimal(19,0)"
        return F.col("most").cast(big) * F.lit(parts).cast(big) < F.col("weight").cast(
            big
        ) * F.lit(words).cast(big)

    words, parts, clamped = total, weight, -1
    while True:
        full = above(words, parts)
        n, used, heavy = table.where(full).agg(
            F.count(F.lit(1)), F.sum("most"), F.sum("weight")
        ).first()
        if n == clamped:
            break
        clamped, words, parts = n, total - (used or 0), weight - (heavy or 0)
    share = F.col("weight").cast("double") * F.lit(float(words)) / F.lit(float(max(parts, 1)))
    target = F.when(full, F.col("most").cast("double")).otherwise(share)
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Every row of ``docs`` with ``size, source_size, target, taken`` behind its columns.

    ``taken`` is how many words of the document the mix has, repeats counted. Sizes are words of
    the text; a null text has none. A null source is a source like any other, the last. Equal ids
    are next to each other in the seeded order, so of repeated rows one may be taken and the
    other not. A null id is an id. Columns of ``docs`` that have the name of a new one are
    replaced. No rows give no rows.
    """
    new = ("size", "source_size", "target", "taken")
    docs, own = set_aside(
        docs.select(*[c for c in docs.columns if c.lower() not in new]), ("doc_id", "source", "text")
    )
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select("*", n_words("text").alias("size"), order.alias("_order"))
    sized = sized.withColumn("_bucket", F.substring("_order", 1, 4))
    buckets = stored(
        sized.groupBy("source", "_bucket").agg(F.sum("size").alias("words")), "buckets"
    )
    sources = targets(
        buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs
    )
    quota = F.floor("target").cast("long")
    sources = sources.withColumn(
        "_whole",
        F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0),
    ).withColumn("_extra", quota - F.col("_whole") * F.col("source_size"))

    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    lines = buckets.withColumn("_before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    edges = lines.select(F.col("source").alias("_s"), "_bucket", "_before", "words").join(
        sources, F.col("_s").eqNullSafe(F.col("source"))
    )
    inside = (F.col("_before") <= F.col("_extra")) & (
        F.col("_extra") < F.col("_before") + F.col("words")
    )
    edges = edges.where(inside).select("_s", F.col("_bucket").alias("_edge"), "_before")
    table = stored(
        sources.join(edges, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            "_whole",
            "_extra",
            # Nothing but the end of a source, which no bucket contains, leaves no edge.
            F.when(F.col("source_size") == 0, "").otherwise(F.col("_edge")).alias("_edge"),
            F.coalesce("_before", F.lit(0)).alias("_before"),
        ),
        "mix",
    )
    joined = sized.join(table, F.col("source").eqNullSafe(F.col("_source")))
    at_edge = F.col("_bucket") == F.col("_edge")
    clear = joined.where(~at_edge).withColumn(
        "_more", F.when(F.col("_bucket") < F.col("_edge"), F.col("size")).otherwise(0)
    )
    within = (
        Window.partitionBy("source")
        .orderBy("_order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = (
        F.col("_extra") - F.col("_before") - F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    edge = joined.where(at_edge).withColumn(
        "_more", F.greatest(F.lit(0), F.least(F.col("size"), left))
    )
    taken = (F.col("_whole") * F.col("size") + F.col("_more")).cast("long")
    return clear.unionByName(edge).select(
        *own, "size", "source_size", "target", taken.alias("taken")
    )


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each document as often as it is taken, the last time perhaps in part.

    A part is the first words of the document joined by one space; its ``n_chars`` is its own length.
    Documents without words, or not taken, are left out. Of ``columns``, those called as the counts of
    :func:`mix_sources` are these counts.
    """
    frame, known = set_aside(mixed, ("text", "n_chars", "taken", "size"))
    known = dict(zip(mixed.columns, known, strict=True))
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") - (F.col("_turn") - 1) * F.col("size")).cast("int")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), rest), " ")
    turns = frame.where("taken > 0").select(
        "*", F.explode(F.sequence(F.lit(1), times)).alias("_turn")
    )
    whole = rest >= F.col("size")
    new = {"text": F.when(whole, F.col("text")).otherwise(part)}
    if "n_chars" in columns:
        length = F.when(whole, F.col("n_chars")).otherwise(F.char_length(part))
        new["n_chars"] = length.cast(mixed.schema["n_chars"].dataType)
    return turns.select(*[new[c].alias(c) if c in new else known[c] for c in columns])


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed with weights 1, 2, 3 and three epochs at most."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text")
    mixed = mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3 * source_size AS most,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER prior, 0) AS HUGEINT) AS words,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER prior, 0) AS HUGEINT) AS parts
  FROM sources
  WINDOW prior AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT words, parts FROM ordered WHERE most * parts >= weight * words
  ORDER BY 3.0 * source_size / weight, source NULLS LAST LIMIT 1),
aimed AS (
  SELECT source, source_size,
    CASE WHEN o.most * l.parts < o.weight * l.words THEN CAST(most AS DOUBLE)
      ELSE CAST(weight AS DOUBLE) * CAST(l.words AS DOUBLE) / CAST(l.parts AS DOUBLE) END AS target
  FROM ordered o, level l),
placed AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size,
  CAST(floor(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken
FROM placed
"""
