"""Ranked search by words, with an index whose terms are dealt out to owners.

Documents are numbered in blocks. One pass over the texts keeps, for every document, its length and
how often it has each of the items' terms; a second one, with the corpus-wide counts, turns them into
posting lists ``(block, owner, term)`` of integer impacts. Terms belong to owners in the order of their
weights, the heaviest first, so that each owner has an equal share of the postings.

The items travel as bundles, one per block of documents, through the owners one after the other. A
stage cogroups the bundles with that owner's lists of the block: it adds the owner's integer
contributions to the bundle's sparse accumulators (document and score) and passes them on. After the
last owner the best documents of a block are known, and one window selects the best of all blocks.

An accumulator is left behind only where that cannot change the result: if even the largest
contributions of all terms to come would not lift it to a score that enough documents of the block
already have. A block bounds the memory of a stage; the number of blocks grows with the documents.

Items are taken in slices of about ``MOST_TERMS`` terms, so what is sent to the tasks is bounded
whatever their number. Terms are compared by hashes of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import read, stored
from wardline.llm.units import gathered
from wardline.llm.words import LOWER, SYMBOLS, pieces, signed

BEST = 10
OWNERS = 4
BLOCK = 16_384
MOST_TERMS = 1 << 17
# Of a document of average length, 90 of 100 parts follow its length; an impact is below
# one million for every number of occurrences.
BASE, SHARE = 100, 90
SCALE, FREQUENCY, NORM = 1_000_000_000, 1_000, 8
CEILING = SCALE // FREQUENCY


def _ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of every item."""
    for batch in batches:
        for piece in pieces(batch.column("text"), SYMBOLS, LOWER):
            rows, hashes = piece.rows, piece.hashes
            order = np.lexsort((hashes, rows))
            rows, hashes = rows[order], hashes[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
            counts = np.bincount(rows[new], minlength=len(piece.counts))
            own = batch.slice(piece.first, len(piece.counts))
            yield pa.RecordBatch.from_arrays(
                [own.column("item"), own.column("item_id"), _ragged(signed(hashes[new]), counts, pa.int64())],
                names=["item", "item_id", "terms"],
            )


def _numbered(terms: np.ndarray, size: int):
    """Documents in blocks of ``size``, in the order of their ids, with their occurrences of ``terms``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def emitted() -> pa.RecordBatch:
            doc_ids = pa.concat_arrays(ids)
            lengths, counts, own, times = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.asarray(pc.sort_indices(doc_ids, null_placement="at_end"))
            at = gathered((np.cumsum(counts) - counts)[order], counts[order])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block)),
                    pa.array(np.arange(n), pa.int32()),
                    doc_ids.take(pa.array(order)),
                    pa.array(lengths[order]),
                    _ragged(own[at], counts[order], pa.int32()),
                    _ragged(times[at], counts[order], pa.int64()),
                ],
                names=["block", "local", "doc_id", "n", "terms", "times"],
            )

        for batch in batches:
            for piece in pieces(batch.column("text"), SYMBOLS, LOWER):
                place = np.minimum(np.searchsorted(terms, piece.hashes), max(len(terms) - 1, 0))
                known = terms[place] == piece.hashes if len(terms) else np.zeros(len(place), bool)
                keys = piece.rows[known] * len(terms) + place[known]
                keys, times = np.unique(keys, return_counts=True)
                rows, own = np.divmod(keys, max(len(terms), 1))
                counts = np.bincount(rows, minlength=len(piece.counts))
                ids.append(batch.column("doc_id").slice(piece.first, len(piece.counts)))
                held.append((piece.counts, counts, own, times))
                n += len(piece.counts)
                if n >= size:
                    yield emitted()
                    ids, held, n = [], [], 0
                    block += 1
        if n:
            yield emitted()

    return emit


def _lists(owners: np.ndarray, n_docs: int, n_terms: int):
    """Posting lists of the documents of each batch, with impacts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column("terms")
            counts = np.diff(terms.offsets.to_numpy())
            rows = np.repeat(np.arange(batch.num_rows), counts)
            own = terms.flatten().to_numpy().astype(np.int64)
            times = batch.column("times").flatten().to_numpy()
            norm = BASE - SHARE + SHARE * batch.column("n").to_numpy() * n_docs // n_terms
            impact = SCALE * times // (FREQUENCY * times + NORM * norm[rows])
            block = batch.column("block").to_numpy()[rows]
            local = batch.column("local").to_numpy()[rows]
            order = np.lexsort((local, own, block))
            own, block = own[order], block[order]
            new = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
            sizes = np.diff(np.append(new, len(own)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[new], pa.int64()),
                    pa.array(owners[own[new]], pa.int32()),
                    pa.array(own[new], pa.int32()),
                    _ragged(local[order], sizes, pa.int32()),
                    _ragged(impact[order], sizes, pa.int32()),
                ],
                names=["block", "owner", "term", "docs", "impacts"],
            )

    return emit


BUNDLE = "block long, item int, docs array<int>, scores array<long>"


def _flat(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and how many each list has."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    return column.flatten().to_numpy().astype(kind), np.diff(column.offsets.to_numpy())


def _stage(shares: list[tuple[int, np.ndarray, np.ndarray]], rest: np.ndarray, best: int, last: bool):
    """One owner's work on the bundles of a block.

    ``shares`` has, for every item with terms of this owner, its number, the terms and their weights;
    ``rest`` the sum of each item's weights that later owners have.
    """

    def add(key, bundles: pa.Table, lists: pa.Table) -> pa.Table:
        docs, counts = _flat(bundles.column("docs"), np.int64)
        scores, _ = _flat(bundles.column("scores"), np.int64)
        ends = np.cumsum(counts)
        items = bundles.column("item").to_pylist()
        found = {
            item: (docs[end - n : end], scores[end - n : end])
            for item, n, end in zip(items, counts, ends, strict=True)
        }
        own_docs, sizes = _flat(lists.column("docs"), np.int64)
        impacts, _ = _flat(lists.column("impacts"), np.int64)
        starts = np.cumsum(sizes) - sizes
        places: dict[int, list[slice]] = {}
        for term, at, n in zip(lists.column("term").to_pylist(), starts, sizes, strict=True):
            places.setdefault(term, []).append(slice(at, at + n))
        room = 1 + int(max(docs.max(initial=-1), own_docs.max(initial=-1)))
        sums = np.zeros(room, np.int64)
        for item, terms, weights in shares:
            parts = [(w, p) for t, w in zip(terms.tolist(), weights.tolist(), strict=True) for p in places.get(t, ())]
            if not parts:
                continue
            touched = [own_docs[p] for _, p in parts]
            if item in found:
                touched.append(found[item][0])
                sums[found[item][0]] = found[item][1]
            for weight, place in parts:
                sums[own_docs[place]] += weight * impacts[place]
            touched = np.unique(np.concatenate(touched))
            found[item] = touched, sums[touched]
            sums[touched] = 0
        kept = []
        for item, (own, score) in found.items():
            own, score = own[score > 0], score[score > 0]
            if last:
                order = np.lexsort((own, -score))[:best]
                own, score = own[order], score[order]
            elif len(own) > best:
                least = np.partition(score, len(score) - best)[len(score) - best]
                able = score + rest[item] * CEILING >= least
                own, score = own[able], score[able]
            if len(own):
                kept.append((item, own, score))
        sizes = np.array([len(own) for _, own, _ in kept], np.int64)
        none = np.zeros(0, np.int64)
        return pa.Table.from_arrays(
            [
                pa.array([key[0].as_py()] * len(kept), pa.int64()),
                pa.array([item for item, _, _ in kept], pa.int32()),
                _ragged(np.concatenate([none, *(own for _, own, _ in kept)]), sizes, pa.int32()),
                _ragged(np.concatenate([none, *(score for *_, score in kept)]), sizes, pa.int64()),
            ],
            names=["block", "item", "docs", "scores"],
        )

    return add


def _ranked_slice(
    docs: DataFrame, items: list[tuple[int, list[int]]], best: int, owners: int, size: int
) -> DataFrame | None:
    """``number, doc_id, score``: the best documents of each block for some items, by their number."""
    spark = docs.sparkSession
    terms = np.unique(np.array([t for _, own in items for t in own], np.int64).view(np.uint64))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select("doc_id", "text").mapInArrow(
        _numbered(terms, size),
        f"block long, local int, doc_id {id_type}, n long, terms array<int>, times array<long>",
    )
    numbered = stored(numbered, "numbered")
    n_docs, n_terms = numbered.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs or not len(terms):
        return None
    counted = numbered.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    frequency = np.zeros(len(terms), np.int64)
    frequency[[row["term"] for row in counted]] = [row["count"] for row in counted]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in frequency.tolist()])
    order = np.argsort(-weights, kind="stable")
    before = np.cumsum(frequency[order]) - frequency[order]
    owner = np.empty(len(terms), np.int64)
    owner[order] = before * owners // max(int(frequency.sum()), 1)
    lists = numbered.mapInArrow(
        _lists(owner, n_docs, n_terms),
        "block long, owner int, term int, docs array<int>, impacts array<int>",
    )
    lists = stored(lists, "posting-lists")
    own_terms = [np.searchsorted(terms, np.array(own, np.int64).view(np.uint64)) for _, own in items]
    bundles = spark.createDataFrame([], BUNDLE)
    for stage in range(owners):
        shares = [(k, t[owner[t] == stage]) for k, t in enumerate(own_terms)]
        shares = [(k, t, weights[t]) for k, t in shares if len(t)]
        rest = np.array([weights[t[owner[t] > stage]].sum() for t in own_terms], np.int64)
        work = _stage(shares, rest, best, stage == owners - 1)
        own = lists.where(F.col("owner") == stage)
        bundles = bundles.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(work, BUNDLE)
    found = bundles.select(F.col("block").alias("in_block"), "item", F.inline(F.arrays_zip("docs", "scores")))
    ids = numbered.select("block", "local", "doc_id")
    found = found.join(ids, (F.col("in_block") == F.col("block")) & (F.col("docs") == F.col("local")))
    numbers = F.lit([int(number) for number, _ in items])
    return found.select(numbers[F.col("item")].alias("number"), "doc_id", F.col("scores").alias("score"))


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    owners: int = OWNERS,
    block: int = BLOCK,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents with a score for each row of ``items``.

    ``items`` has ``item_id`` and ``text``, ``docs`` has ``doc_id`` and ``text``; other columns are not
    read. A null or empty text has no terms: such a document is never found and does not count, such an
    item finds nothing. Equal scores rank by ascending id, a null id last. Repeated rows are documents
    and items of their own. Without documents or items nothing is found.
    """
    item_type = items.schema["item_id"].dataType.simpleString()
    named = items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    named = stored(
        named.mapInArrow(_item_terms, f"item long, item_id {item_type}, terms array<long>"), "items"
    )
    total = named.agg(F.sum(F.size("terms"))).first()[0] or 0
    slices = max(1, math.ceil(total / most_terms))
    found = None
    for k in range(slices):
        own = named.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == k)
        own = own.where(F.size("terms") > 0).select("item", "terms").collect()
        part = _ranked_slice(docs, [(r["item"], r["terms"]) for r in own], best, owners, block)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        id_type = docs.schema["doc_id"].dataType.simpleString()
        nothing = f"item_id {item_type}, rank int, doc_id {id_type}, score long"
        return docs.sparkSession.createDataFrame([], nothing)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    joined = found.join(named.select("item", "item_id"), F.col("number") == F.col("item"))
    return joined.select("item_id", "rank", "doc_id", "score")


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(text, {_LETTERS}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
norms AS (SELECT doc_id, 100 - 90 + (90 * n * n_docs) // n_terms AS m FROM lengths, corpus),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus GROUP BY term),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every item of ``benchmark``."""
    return ranked(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
