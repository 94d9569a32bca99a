"""Near-duplicate documents by SetSketch registers, a joint likelihood and exact verification.

*Registers.* A document is the set of its runs of ``length`` words. For each of ``REGISTERS`` hash
functions the smallest value over the set, as an exponential variable with rate ``RATE``, is kept
on the scale of powers of ``BASE`` and truncated to 16 bits. Registers of two sets are merged by
the larger value, and they agree the more often the more alike the sets are.

*Candidates.* Four registers make a band; documents that share a band meet. With the sizes of both
sets known, the similarity of most likelihood given how many registers are larger, smaller and
equal is computed; a pair is likely unless that is five deviations below the threshold. First every
document is compared with one of those it meets, the same for all, which mostly joins a whole
group, however large. Where documents that meet are still in different components, all of
them are compared in blocks inside the tasks. Likely pairs make candidate groups.

*Verify.* The full sets of all documents of a candidate group are compared, in blocks of ``TEXTS``.
Only links that join two components leave a task, so nothing emits the pairs of a group. Texts
with the same words are one text throughout, so copies never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import sieve, stored
from wardline.llm.components import components
from wardline.llm.embedding_dedup import _by_group, _starts, crosses, in_blocks, sorted_cells
from wardline.llm.words import LOWER, MULTIPLIERS, WHITE, Piece, Ranges, U, mix, pieces, windows

SHINGLE = 5
PERCENT = 80
REGISTERS = 80
BAND = 4
BASE, RATE = 1.001, 20.0
DEVIATIONS = 5.0
# Texts that are compared in one task at a time.
TEXTS = 512

_KEYS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=U) * U(0x9E3779B97F4A7C15)).reshape(2, -1)
_GRID = np.linspace(0.0, 1.0, 101)


def shingles(piece: Piece, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle of a piece, by row."""
    bounds = piece.bounds
    starts = windows(piece, length)
    short = np.flatnonzero((piece.counts > 0) & (piece.counts < length))
    begin = np.concatenate([starts, bounds[short]])
    end = np.concatenate([starts + length, bounds[short + 1]])
    hashes = Ranges(piece.hashes, MULTIPLIERS[1]).hashes(begin, end)
    rows = piece.rows[begin]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def registers(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The registers of ``n`` sets; those of an empty set are 0."""
    out = np.zeros((n, REGISTERS), np.uint16)
    if not len(rows):
        return out
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    for k in range(REGISTERS):
        drawn = (hashes ^ _KEYS[0, k]) * (_KEYS[1, k] | U(1))
        least = np.minimum.reduceat(drawn ^ (drawn >> U(32)), starts)
        x = -np.log1p(-(least.astype(float) + 0.5) * 2.0**-64) / RATE
        level = np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(BASE))
        out[rows[starts], k] = np.clip(level, 0, 65535)
    return out


def names(piece: Piece) -> list[bytes]:
    """Sixteen bytes for the word sequence of each row."""
    bounds = piece.bounds
    parts = [Ranges(piece.hashes, m).hashes(bounds[:-1], bounds[1:]) for m in MULTIPLIERS[1:]]
    both = np.stack([p ^ mix(piece.counts.astype(U)) for p in parts], axis=1)
    return [row.tobytes() for row in np.ascontiguousarray(both)]


def similarity(larger: np.ndarray, smaller: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of most likelihood.

    ``larger`` and ``smaller`` count the registers in which the first set's value is above or below
    the second's; ``a`` and ``b`` are the sizes of the sets.
    """
    u = (a / (a + b))[:, None]
    v = 1 - u
    j = _GRID[None, :] * np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = chance(u - v * j), chance(v - u * j)
    with np.errstate(divide="ignore", invalid="ignore"):
        likely = (
            larger[:, None] * np.log(np.maximum(above, 1e-12))
            + smaller[:, None] * np.log(np.maximum(below, 1e-12))
            + (REGISTERS - larger - smaller)[:, None] * np.log(np.maximum(1 - above - below, 1e-12))
        )
    best = likely.argmax(axis=1)
    return j[np.arange(len(best)), best]


def least_estimate(percent: int) -> float:
    p = percent / 100
    return p - DEVIATIONS * np.sqrt(p * (1 - p) / REGISTERS)


def _sketches(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text"), WHITE, LOWER):
                n = len(piece.counts)
                rows, hashes = shingles(piece, length)
                found = registers(rows, hashes, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(piece.first, n),
                        pa.array(names(piece), pa.binary()),
                        pa.array(np.bincount(rows, minlength=n).astype(np.int64)),
                        pa.array([row.tobytes() for row in found], pa.binary()),
                    ],
                    names=["doc_id", "key", "n_shingles", "registers"],
                )

    return emit


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16)
        bands = raw.view(np.uint64).reshape(batch.num_rows, REGISTERS // BAND)
        for k in range(bands.shape[1]):
            place = mix(bands[:, k] ^ mix(np.full(1, k + 1, U)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.view(np.int64)), batch.column("key")], names=["place", "key"]
            )


def _vectors(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint16)
    return raw.reshape(len(column), REGISTERS)


def _likely(percent: int):
    """Pairs ``a, b`` whose estimate is not too low."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_estimate(percent)
        for batch in batches:
            x, y = _vectors(batch.column("own")), _vectors(batch.column("other"))
            sizes = [np.array(batch.column(c)).astype(float) for c in ("n_own", "n_other")]
            good = similarity((x > y).sum(axis=1), (x < y).sum(axis=1), *sizes) >= least
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"]
            )

    return emit


def _across(percent: int):
    """Links that join the components of likely pairs among those that meet in a cell."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        least = least_estimate(percent)
        starts = np.append(_starts(table, ["place", "cell"]), len(table))
        keys = table.column("key").combine_chunks()
        part = np.unique(np.array(table.column("part").to_pylist(), dtype=object), return_inverse=True)[1]
        block, cell = np.array(table.column("block")), np.array(table.column("cell"))
        size = np.array(table.column("n_shingles")).astype(float)
        held = _vectors(table.column("registers"))
        for low, high in zip(starts[:-1], starts[1:], strict=True):
            cross = crosses(cell[low])
            label = part[low:high].copy()
            for i in range(high - low - 1):
                j = np.arange(i + 1, high - low)
                j = j[label[j] != label[i]]
                if cross:
                    j = j[block[low + j] != block[low + i]]
                if not len(j):
                    continue
                own, other = held[low + i], held[low + j]
                larger, smaller = (own > other).sum(axis=1), (own < other).sum(axis=1)
                sizes = np.full(len(j), size[low + i]), size[low + j]
                found = j[similarity(larger, smaller, *sizes) >= least]
                # One link to each component that is new is enough.
                found = found[np.unique(label[found], return_index=True)[1]]
                if len(found):
                    label[np.isin(label, label[found])] = label[i]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(np.full(len(found), low + i))), keys.take(pa.array(low + found))],
                        names=["a", "b"],
                    )

    return work


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts that have the wanted words."""
    for batch in batches:
        texts, wanted = batch.column("text"), batch.column("key")
        for piece in pieces(texts, WHITE, LOWER):
            n = len(piece.counts)
            own = wanted.slice(piece.first, n)
            same = pa.array([a == b for a, b in zip(names(piece), own.to_pylist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [own.filter(same), texts.slice(piece.first, n).filter(same)], names=["key", "text"]
            )


def _sets(texts: pa.Array, length: int) -> list[np.ndarray]:
    found = []
    for piece in pieces(texts, WHITE, LOWER):
        rows, hashes = shingles(piece, length)
        ends = np.cumsum(np.bincount(rows, minlength=len(piece.counts)))
        found += np.split(hashes, ends[:-1])
    return found


def _verified(length: int, percent: int):
    """Links that join the components of truly linked texts of a cell."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        starts = np.append(_starts(table, ["place", "cell"]), len(table))
        keys, texts = table.column("key").combine_chunks(), table.column("text").combine_chunks()
        block, cell = np.array(table.column("block")), np.array(table.column("cell"))
        for low, high in zip(starts[:-1], starts[1:], strict=True):
            sets = _sets(texts.slice(low, high - low), length)
            sizes = np.array([len(x) for x in sets])
            ends = np.cumsum(sizes)
            codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
            cross = crosses(cell[low])
            seen = np.zeros(int(codes.max()) + 1, np.uint8)
            label = np.arange(high - low)
            found: list[tuple[int, int]] = []
            for i in range(high - low - 1):
                if (label[i + 1 :] == label[i]).all():
                    continue
                own = codes[ends[i] - sizes[i] : ends[i]]
                seen[own] = 1
                both = np.add.reduceat(seen[codes[ends[i] :]], ends[i:-1] - ends[i], dtype=np.int64)
                seen[own] = 0
                good = 100 * both >= percent * (sizes[i] + sizes[i + 1 :] - both)
                if cross:
                    good &= block[low + i + 1 : high] != block[low + i]
                for j in i + 1 + np.flatnonzero(good):
                    if label[j] != label[i]:
                        label[label == label[j]] = label[i]
                        found.append((low + i, low + int(j)))
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(a)), keys.take(pa.array(b))], names=["a", "b"]
                )

    return work


def _ends(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """``pairs`` with what ``table`` has for both ends."""

    def side(end: str, name: str) -> DataFrame:
        more = [c for c in table.columns if c not in ("key", value)]
        columns = [F.col(c).alias(f"n_{name}") for c in more]
        return table.select(F.col("key").alias(end), F.col(value).alias(name), *columns)

    return pairs.join(side("a", "own"), "a").join(side("b", "other"), "b")


def near_duplicates(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if ``100 * shared >= percent * all`` of their distinct shingles, runs
    of ``length`` words, ASCII letters in lower case; a component is named by its smallest id, and that document is kept. A
    text of fewer words than a shingle is one shingle. A null text and one without words have
    none and are their own component. Rows with one ``doc_id`` are kept or not together. A null id
    is no smallest id unless its component has no other; such a component is null and kept. Other
    columns are not read. No rows give no rows.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    sketches = stored(
        docs.mapInArrow(
            _sketches(length), f"doc_id {id_type}, key binary, n_shingles long, registers binary"
        ),
        "sketches",
    )
    texts = stored(
        sketches.where("n_shingles > 0").groupBy("key").agg(
            F.min("doc_id").alias("first"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("registers").alias("registers"),
        ),
        "distinct-texts",
    )
    bands = texts.select("key", "registers").mapInArrow(_bands, "place long, key binary")
    pivots = bands.groupBy("place").agg(F.min("key").alias("pivot"), F.max("key").alias("last"))
    pivots = pivots.where(F.col("pivot") != F.col("last")).select("place", "pivot")
    meetings = stored(bands.join(pivots, "place"), "meetings")

    sides = texts.select("key", "registers", "n_shingles")
    stars = meetings.where(F.col("key") != F.col("pivot"))
    stars = stars.select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
    likely = stored(
        _ends(stars, sides, "registers").mapInArrow(_likely(percent), "a binary, b binary"), "likely"
    )
    parts = components(likely)

    def labelled(table: DataFrame) -> DataFrame:
        return table.join(parts, F.col("key") == F.col("id"), "left").withColumn(
            "part", F.coalesce("component", "key")
        ).drop("id", "component")

    split = labelled(meetings.select("place", "key"))
    open_places = split.groupBy("place").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    open_places = open_places.where(F.col("p") != F.col("q")).select("place")
    rest = split.join(open_places, "place").join(sides, "key")
    columns = ["place", "cell", "block", "key", "part", "n_shingles", "registers"]
    more = stored(
        sorted_cells(in_blocks(rest)).select(*columns)
        .mapInArrow(_by_group(_across(percent), columns), "a binary, b binary"),
        "rest",
    )
    if not more.isEmpty():
        parts = components(likely.unionByName(more))

    wanted = stored(
        parts.join(texts.select("key", "first"), F.col("id") == F.col("key")).select(
            "key", "first", F.col("component").alias("place")
        ),
        "wanted",
    )
    # Texts that are in no candidate group are not shuffled.
    bodies = stored(
        docs.where(sieve(wanted.select("first"))(F.col("doc_id")))
        .join(wanted, docs["doc_id"].eqNullSafe(F.col("first")))
        .select("key", "text")
        .mapInArrow(_texts, "key binary, text string")
        .dropDuplicates(["key"])
        .join(wanted.select("key", "place"), "key"),
        "bodies",
    )
    columns = ["place", "cell", "block", "key", "text"]
    links = stored(
        sorted_cells(in_blocks(bodies, TEXTS)).select(*columns).mapInArrow(
            _by_group(_verified(length, percent), columns), "a binary, b binary"
        ),
        "verified",
    )
    parts = components(links)
    named = labelled(texts.select("key", "first"))
    smallest = named.groupBy(F.col("part").alias("of")).agg(F.min("first").alias("least"))
    found = named.join(smallest, F.col("part") == F.col("of")).select(
        F.col("key").alias("own"), "least"
    )
    joined = sketches.select("doc_id", "key", "n_shingles").join(
        found, F.col("key") == F.col("own"), "left"
    )
    component = F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near duplicates among all documents: three words a shingle, 85 percent shared."""
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), length=3, percent=85)


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2)
  UNION ALL
  SELECT doc_id, array_to_string(words, ' ') FROM d WHERE len(words) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * met >= 85 * (x.n + y.n - met)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id,
  d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""
