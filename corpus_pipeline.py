"""From raw documents to tokens: five operators one after the other.

Every stage takes any rows. Null and empty texts have no words: the classifier judges them like any
other text, nothing is near them or repeats in them, and the mix takes none of them. Null ids are one
id, behind all others; rows that share an id are one document to the stage that removes passages, and
go together where one of a group goes. Repeated rows count as often as they occur. A table without
rows stays one. Columns that are no column of ``documents`` are given back as they are, whatever
their names, by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import byte_bpe, minhash_dedup, mixing, quality, substring_dedup
from wardline.llm.common import read, set_aside, small_batches, stored, without

KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose posterior probability of being good is at least one half."""
    small_batches(spark)
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    docs, own = set_aside(docs, KNOWN)
    return quality.classify(docs, model).where("quality_score >= 0.5").select(*own)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that shares 80 % of its runs of five words."""
    small_batches(spark)
    found = minhash_dedup.near_duplicates(docs, length=5, percent=80).where("NOT kept")
    return without(docs, stored(found.select("doc_id").distinct(), "dropped"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; one that loses nothing is unchanged."""
    small_batches(spark)
    return substring_dedup.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    small_batches(spark)
    docs, own = set_aside(docs, KNOWN)
    return mixing.repeated(mixing.mix_sources(docs), docs.columns).select(*own)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document and what they decode to, as digests."""
    small_batches(spark)
    return byte_bpe.digests(docs)


STAGES = [
    ("quality", good_documents),
    ("near duplicates", one_of_each_group),
    ("repeated passages", without_repeats),
    ("mix", mixed),
    ("tokens", tokens),
]
# Classifier, sketches and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
