"""Removal of passages that stand earlier in the corpus, by level-wise doubling.

A passage of ``window`` words can only repeat if the half as long run of words inside it repeats.
So the first level counts runs of ``window / 2`` words across the corpus. One run stands for each
window: the one with the smallest hash in it, so equal windows choose equal runs and only about
one run in six is sent. Runs found once end there. For the rest, the windows that chose the run
are extended to their whole length.

Neighbouring windows mostly choose the same run. Their words together are its *context*, and
documents that share a context share all its windows. The second level therefore works in two
steps: the first document of each context is found by aggregation, and every other document
loses the context; then single windows are hashed, only in first documents, and only where one
run has several contexts (the edges of copied passages). Again the first document of each
window keeps it. A third level of twice the length could change nothing: its passages consist of
windows already removed. Repeats inside a document are found in the document itself.

Texts are shuffled by id, and by a hash of their own where several rows share an id or have none;
only rows of numbers move otherwise. All grouping is by hashes with
partial aggregation, so a passage that stands in a third of all documents is one row for each map
task; joins on such passages have one row per key on one side and can be split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import set_aside, sieve, stored
from wardline.llm.words import MULTIPLIERS, Piece, Ranges, pieces, signed, windows

WINDOW = 20


class Level:
    """The runs that stand for the windows of a piece, and the contexts of these runs."""

    def __init__(self, piece: Piece, window: int):
        half = (window + 1) // 2
        self.starts = windows(piece, window)
        self.first = Ranges(piece.hashes, MULTIPLIERS[1])
        self.second = Ranges(piece.hashes, MULTIPLIERS[2])
        self.window = window
        if not len(self.starts):
            self.low = self.high = self.run = self.context = np.zeros(0, np.int64)
            return
        at = np.arange(len(piece.hashes) - half + 1)
        runs = self.first.hashes(at, at + half)
        inner = np.lib.stride_tricks.sliding_window_view(runs, window - half + 1)
        chosen = self.starts + inner[self.starts].argmin(axis=1)
        row = piece.rows[self.starts]
        new = np.flatnonzero(
            np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])])
        )
        self.low = self.starts[new]
        self.high = self.starts[np.concatenate([new[1:] - 1, [len(row) - 1]])]
        place = (chosen[new] - self.low).astype(np.uint64) * np.uint64(65536)
        self.run = signed(runs[chosen[new]])
        self.context = signed(
            self.second.hashes(self.low, self.high + window)
            ^ (place + (self.high - self.low).astype(np.uint64))
        )

    def of(self, which: np.ndarray) -> np.ndarray:
        """Starts of the windows of some contexts."""
        low, n = self.low[which], self.high[which] - self.low[which] + 1
        return np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())

    def keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = starts + self.window
        return signed(self.first.hashes(starts, ends)), signed(self.second.hashes(starts, ends))


def _flat(lists: pa.Array, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of a column of lists of longs."""
    part = lists.slice(first, n)
    return np.asarray(pc.list_parent_indices(part)), np.asarray(pc.list_flatten(part))


def _listed(rows: np.ndarray, values: np.ndarray, lists: pa.Array, first: int, n: int) -> np.ndarray:
    """Which of ``values`` are in the list of their row."""
    owner, listed = _flat(lists, first, n)
    if not len(listed) or not len(values):
        return np.zeros(len(values), bool)
    keys, codes = np.unique(np.concatenate([listed, values]), return_inverse=True)
    width = np.int64(len(keys))
    return np.isin(rows * width + codes[len(listed) :], owner * width + codes[: len(listed)])


def _runs(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, salts = batch.column("doc_id"), batch.column("salt")
            for piece in pieces(batch.column("text")):
                level = Level(piece, window)
                if len(level.low):
                    owner = pa.array(piece.first + piece.rows[level.low])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(level.run), pa.array(level.context), ids.take(owner), salts.take(owner)],
                        names=["run", "context", "doc_id", "salt"],
                    )

    return emit


def _edges(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, salts = batch.column("doc_id"), batch.column("salt")
            for piece in pieces(batch.column("text")):
                level, n = Level(piece, window), len(piece.counts)
                rows = piece.rows
                mine = _listed(rows[level.low], level.context, batch.column("open"), piece.first, n)
                starts = level.of(mine)
                if len(starts):
                    a, b = level.keys(starts)
                    owner = pa.array(piece.first + rows[starts])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a), pa.array(b), ids.take(owner), salts.take(owner)],
                        names=["key_a", "key_b", "doc_id", "salt"],
                    )

    return emit


def _repeats_inside(level: Level, rows: np.ndarray) -> np.ndarray:
    """Starts of windows that stand earlier in the same row."""
    if len(level.low) < 2:
        return np.zeros(0, np.int64)
    owner = rows[level.low]
    order = np.lexsort((level.run, owner))
    same = (level.run[order][1:] == level.run[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.zeros(len(order), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    starts = level.of(again)
    a, b = level.keys(starts)
    owner = rows[starts]
    order = np.lexsort((starts, b, a, owner))
    a, b, owner = a[order], b[order], owner[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (owner[1:] == owner[:-1])
    return starts[order[1:][same]]


def _kept(window: int, others: list[str], as_is: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for piece in pieces(texts):
                level, n = Level(piece, window), len(piece.counts)
                rows, bounds = piece.rows, piece.bounds
                change = np.zeros(len(piece.hashes) + 1, np.int64)
                owner = rows[level.low]
                found = _listed(owner, level.context, batch.column("repeated"), piece.first, n)
                first = _listed(owner, level.context, batch.column("first"), piece.first, n)
                late, single = found & ~first, level.of(first)
                key, _ = level.keys(single)
                single = single[_listed(rows[single], key, batch.column("late"), piece.first, n)]
                single = np.concatenate([single, _repeats_inside(level, rows)])
                np.add.at(change, level.low[late], 1)
                np.add.at(change, level.high[late] + window, -1)
                np.add.at(change, single, 1)
                np.add.at(change, single + window, -1)
                keep = np.cumsum(change[:-1]) == 0
                kept = []
                for k in range(n):
                    text, own = texts[piece.first + k].as_py(), keep[bounds[k] : bounds[k + 1]]
                    if as_is and own.all():
                        kept.append(text)
                        continue
                    words = (text or "").encode().split()
                    kept.append(b" ".join(compress(words, own)).decode())
                before = np.concatenate([[0], np.cumsum(keep)])
                left = before[bounds[1:]] - before[bounds[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(piece.first, n),
                        pa.array(piece.counts.astype(np.int64)),
                        pa.array((piece.counts - left).astype(np.int64)),
                        pa.array(kept, pa.string()),
                        *[batch.column(f"own_{k}").slice(piece.first, n) for k in range(len(others))],
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text", *others],
                )

    return emit


def _sharing(docs: DataFrame) -> Callable[[Column], Column]:
    """A condition on an id that holds if several rows have it, or none, and for few others."""
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    shared = stored(shared, "shared-ids")
    return (lambda _: F.lit(False)) if shared.isEmpty() else sieve(shared)


def _salt(shares: Column) -> Column:
    """``salt``: a hash of the text, not 0, where rows share an id, else 0.

    What is found for a row is gathered by id and salt, so rows that share an id, or have none, are
    gathered apart.
    """
    own = F.xxhash64("text")
    own = F.when(own == 0, F.lit(1).cast("long")).otherwise(own)
    return F.when(shares, own).otherwise(F.lit(0).cast("long")).alias("salt")


def _same(rows: DataFrame, doc_id: str, salt: str) -> Column:
    return rows["doc_id"].eqNullSafe(F.col(doc_id)) & (rows["salt"] == F.col(salt))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, others: Sequence[str] = (), as_is: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_text`` and ``others``.

    A word goes if it lies in a run of ``window`` words that also starts earlier: in a smaller
    ``doc_id``, or further left in the same document. Runs are judged on the input. Kept words are
    joined by one space; with ``as_is`` a text that loses nothing stays as it is.

    A null or empty text has no words. Rows with one ``doc_id`` count as one document, none of
    them before the other, but each keeps its own text and row; a null ``doc_id`` is one more
    document, behind all others. Texts shorter than a window are kept. Columns other than
    ``doc_id``, ``text`` and ``others`` are not read; names of ``others`` must not be those of the
    result. No rows give no rows.
    """
    others = list(others)
    shares = _sharing(docs)
    salt = _salt(shares(F.col("doc_id")))
    whole = docs.select(
        "doc_id", "text", salt, *[F.col(c).alias(f"own_{k}") for k, c in enumerate(others)]
    )
    docs = docs.select("doc_id", "text", salt)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    runs = docs.mapInArrow(_runs(window), f"run long, context long, doc_id {id_type}, salt long")
    again = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("run")
    found = runs.join(again, "run")

    contexts = found.groupBy("run", "context").agg(F.min("doc_id").alias("doc_id"))
    many = contexts.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    many = many.select(F.col("run").alias("many"))
    mark = F.when(F.col("many").isNull(), 1).otherwise(2).alias("mark")
    firsts = contexts.join(many, F.col("run") == F.col("many"), "left")
    firsts = firsts.select("run", "context", "doc_id", mark)
    marks = found.select("doc_id", "salt", "context", F.lit(0).alias("mark")).unionByName(
        firsts.where(~shares(F.col("doc_id"))).select(
            "doc_id", F.lit(0).cast("long").alias("salt"), "context", "mark"
        )
    )
    # Where rows share the id that has a context first, each of them that has it.
    sharing = docs.where("salt <> 0").mapInArrow(
        _runs(window), f"run long, context long, doc_id {id_type}, salt long"
    )
    sharing = sharing.alias("s").join(
        firsts.where(shares(F.col("doc_id"))).alias("f"),
        F.expr("s.run = f.run AND s.context = f.context AND s.doc_id <=> f.doc_id"),
    )
    marks = marks.unionByName(sharing.select("s.doc_id", "s.salt", "s.context", "f.mark"))
    # Sets, since rows with one id and one text are told apart by nothing.
    marks = stored(
        marks.groupBy(F.col("doc_id").alias("id"), F.col("salt").alias("id_salt")).agg(
            F.collect_set(F.when(F.col("mark") == 0, F.col("context"))).alias("repeated"),
            F.collect_set(F.when(F.col("mark") > 0, F.col("context"))).alias("first"),
            F.collect_set(F.when(F.col("mark") == 2, F.col("context"))).alias("open"),
        ),
        "marks",
    )

    edges = (
        docs.join(marks, _same(docs, "id", "id_salt"))
        .where(F.size("open") > 0)
        .select("doc_id", "text", "salt", "open")
        .mapInArrow(_edges(window), f"key_a long, key_b long, doc_id {id_type}, salt long")
    )
    owners = edges.groupBy("key_a", "key_b").agg(
        F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n")
    )
    late = (
        edges.join(owners.where("n > 1"), ["key_a", "key_b"])
        .where(F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("late_id"), F.col("salt").alias("late_salt"))
        .agg(F.collect_set("key_a").alias("late"))
    )
    more = [T.StructField(c, whole.schema[f"own_{k}"].dataType) for k, c in enumerate(others)]
    result = f"doc_id {id_type}, n_words long, n_removed long, kept_text string"
    return (
        whole.join(marks, _same(whole, "id", "id_salt"), "left")
        .join(late, _same(whole, "late_id", "late_salt"), "left")
        .select(*whole.columns, "repeated", "first", "late")
        .mapInArrow(
            _kept(window, others, as_is), T.StructType([*T.StructType.fromDDL(result), *more])
        )
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the same columns and without their repeats.

    A text that loses nothing stays as it is, a null one null. A column ``n_chars`` is the length
    of the new text.
    """
    docs, back = set_aside(docs, ("doc_id", "text", "n_chars"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # A struct, so that no name of another column can be that of a result.
    row = F.struct(F.lit(0).alias("_none"), *[F.col(c) for c in others]).alias("_row")
    kept = remove_repeats(docs.select("doc_id", "text", row), window, ["_row"], as_is=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    if "n_chars" in others:
        length = F.when(F.col("n_removed") > 0, F.char_length("kept_text"))
        length = length.otherwise(F.col("_row.n_chars"))
        new["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    kept = kept.select(*[new.get(c, F.col(f"_row.{c}")).alias(c) for c in docs.columns])
    return kept.select(*back)


def op1_substring_dedup(spark, folder: str) -> DataFrame:
    """What ``remove_repeats`` leaves of every document, as counts and a digest."""
    kept = remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM runs),
gone AS (
  SELECT DISTINCT doc_id, i + j AS i FROM ranked, (SELECT unnest(range(20)) AS j) WHERE n > 1),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d) w
  ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
