"""Document fingerprints by consistent weighted sampling, with Spark's own functions only.

A text is the multiset of its words; the weight of a word is how often it stands there. For each
of ``SAMPLES`` samples a word has two gamma variables ``r`` and ``c`` and a uniform ``b``, all from
hashes of the word. With ``t = floor(ln(weight) / r + b)`` its arrival is
``ln(c) - r * (t - b + 1)``; the sample is the word of the earliest arrival together with ``t``.
Two texts agree in a sample with a probability equal to their generalised Jaccard similarity, so
the share of equal samples estimates it.

The word and ``t`` of the earliest arrival are known by the arrival itself, so a sample is a minimum
of numbers, aggregated in the rows' own partition: the documents are shuffled once, by ranges of
the id, and words never are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import WORD, stored

SAMPLES = 24
ROWS_PER_RANGE = 500
MOST_RANGES = 8_192
EMPTY = ""


def arrival(bits: Column, size: Column) -> Column:
    """When a term arrives in one sample, from 64 random bits and the logarithm of its weight."""

    def uniform(at: int, width: int) -> Column:
        part = F.shiftrightunsigned(bits, at).bitwiseAND(F.lit((1 << width) - 1))
        return part.cast("double") + 0.5

    r = -F.log(uniform(0, 12) * uniform(12, 12) * 2.0**-24)
    c = -F.log(uniform(24, 14) * uniform(38, 14) * 2.0**-28)
    b = uniform(52, 12) * 2.0**-12
    # For the weight 1, t is 0.
    many = F.log(c) - r * (F.floor(size / r + b) - b + 1.0)
    return F.when(size == 0.0, F.log(c) - r * (1.0 - b)).otherwise(many)


def below(cuts: list[float], value: Column) -> Column:
    """How many of the sorted ``cuts`` are not above a number, by binary search; 0 for a null.

    One expression, however many cuts there are. A column for each step of the search would stand
    three times in the next, and Spark's planner writes them out.
    """
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(cuts).bit_length()))])

    def further(found: Column, step: Column) -> Column:
        return F.when(F.try_element_at(table, found + step) <= value, found + step).otherwise(found)

    return F.coalesce(F.aggregate(steps, F.lit(0), further), F.lit(0))


def in_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text, part, rank``: rows in about equal ranges of the id, numbered from 1.

    The second frame has ``head, text``, the first text of each range, found by aggregation.

    Nulls are in the last range; equal ids are ordered by text. The limits of the ranges, a few
    thousand numbers at most, come from an approximate quantile sketch.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = rows.select(F.count(F.lit(1))).first()[0]
    k = min(MOST_RANGES, max(1, math.ceil(n / ROWS_PER_RANGE)))
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / k for i in range(1, k)], 0.2 / k))) if k > 1 else []
    last = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(below(cuts, F.col("doc_id")))
    rows = rows.withColumn("part", last)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text"))
    heads = rows.groupBy(F.col("part").alias("head")).agg(first.alias("first"))
    heads = heads.select("head", "first.text")
    rows = rows.repartition(k, "part")
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    return rows.withColumn("rank", F.row_number().over(order)), heads


def with_next(rows: DataFrame, columns: list[str], heads: DataFrame) -> DataFrame:
    """Add ``next_<column>`` of the next row by part and rank; after the last comes the first.

    ``heads`` has the columns of the first row of each part, called ``head``. Only these rows
    cross to another part: a stored table of as many rows as there are parts.
    """
    order = Window.partitionBy("part").orderBy("rank")
    following = Window.orderBy("head")
    heads = stored(heads, "heads")
    ends = heads.select(
        "head",
        F.coalesce(F.lead("head").over(following), F.first("head").over(following)).alias("after"),
    )
    heads = heads.select(F.col("head").alias("after"), *[F.col(c).alias(f"head_{c}") for c in columns])
    ends = stored(ends.join(heads, "after").drop("after"), "ends")
    rows = rows.withColumn("_last", F.lead("rank").over(order).isNull())
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    joined = rows.join(ends, (F.col("part") == F.col("head")) & F.col("_last"), "left")
    for c in columns:
        joined = joined.withColumn(
            f"next_{c}", F.when(F.col("_last"), F.col(f"head_{c}")).otherwise(F.col(f"next_{c}"))
        )
    return joined.drop("head", "_last", *[f"head_{c}" for c in columns])


def fingerprint(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """``keys, ids``: the samples of each text that has a word.

    ``rows`` are grouped by ``keys``; if they are already partitioned by some of them, nothing is
    shuffled.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    terms = (
        rows.select(*keys, F.explode(words).alias("word"))
        .select(*keys, F.xxhash64("word").alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, "term", F.log(F.col("n").cast("double")).alias("size"))
    )
    drawn = terms.select(
        *keys, "size", *[F.xxhash64("term", F.lit(i)).alias(f"b{i}") for i in range(samples)]
    )
    least = drawn.groupBy(*keys).agg(
        *[F.min(arrival(F.col(f"b{i}"), F.col("size"))).alias(f"s{i}") for i in range(samples)]
    )
    # Arrivals are equal where term and t are; a hash of them is as good a name.
    low = F.lit((1 << 32) - 1)
    ids = F.array(*[F.xxhash64(f"s{i}").bitwiseAND(low) for i in range(samples)])
    return least.select(*keys, ids.alias("ids"))


def shown(ids: Column) -> Column:
    """Eight hexadecimal digits for each sample; nothing for a text without words."""
    return F.coalesce(
        F.array_join(F.transform(ids, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""), F.lit(EMPTY)
    )


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples; two texts without words are alike, one is like no other."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return (
        F.when(a.isNull() & b.isNull(), 1.0)
        .when(a.isNull() | b.isNull(), 0.0)
        .otherwise(same.cast("double") / F.size(a))
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """The fingerprint of every text, of its edited form, and how alike neighbours are.

    One row per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. The edited form has its last half replaced by the beginning of the
    next document by id; after the last comes the first, and a single document follows itself. A
    null text is empty, and an empty text has the empty fingerprint. A null id comes last, equal
    ids are ordered by text. Other columns are not read. No rows give no rows.
    """
    rows, heads = in_ranges(docs)
    rows = with_next(rows, ["text"], heads)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)
    )
    rows = rows.select("part", "rank", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    texts = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("form")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("form")),
    )
    forms = rows.select("part", "rank", F.explode(texts).alias("f")).select("part", "rank", "f.kind", "f.form")
    found = fingerprint(forms, ["part", "rank", "kind"], "form", samples)
    found = found.groupBy(F.col("part").alias("_part"), F.col("rank").alias("_rank")).agg(
        *[F.max(F.when(F.col("kind") == k, F.col("ids"))).alias(c) for k, c in enumerate(("own", "other"))]
    )
    table = stored(
        rows.select("part", "rank", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
        .join(found, (F.col("part") == F.col("_part")) & (F.col("rank") == F.col("_rank")), "left")
        .drop("_part", "_rank"),
        "fingerprints",
    )
    table = with_next(table, ["own"], table.where("rank = 1").select(F.col("part").alias("head"), "own"))
    own, other, after = F.col("own"), F.col("other"), F.col("next_own")
    return table.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(own).alias("fingerprint"),
        shown(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, after).alias("near_next"),
    )


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited forms."""
    return fingerprints(spark.read.parquet(f"{folder}/documents.parquet"))
