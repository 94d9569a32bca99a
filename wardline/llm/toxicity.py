"""Toxicity by a convolutional text classifier written in numpy.

A word (letters and digits, lower case) is the sum of three rows of a table of embeddings, chosen
by hashes of the whole word and of its first four and five bytes, so that words which share one
row still differ and the forms of one stem are alike. Filters of several widths go over the
whole text, each keeps its largest value, and a logistic unit weighs them. The network is trained
on the driver with a bounded number of labelled documents, by gradients through the largest
values only. Words never seen in training keep the embedding zero. Training starts from one
coordinate that says how much a row leans to either label in the sample, counted by documents.

Scores are then calibrated by language: for each language a threshold is fitted on labelled rows
that were kept back from training, and logits are shifted so that the threshold is at 0.5. The
language is the one the language identifier reads from the text; no other column plays a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm import language_id
from wardline.llm.common import remainder
from wardline.llm.words import LOWER, SYMBOLS, Piece, U, mix, pieces

TABLE_BITS = 17
WIDTH = 12
FILTER_WIDTHS = (1, 2, 3)
FILTERS = 12
PREFIXES = (4, 5)
ROWS_PER_CLASS = 1_500
# Of the texts that a label learns from, all together; one text has a sixteenth of that at most.
BYTES_PER_CLASS = 1 << 24
EPOCHS = 2
CHANCE = 4.0
BLOCK = 1 << 15


def hashes_of(piece: Piece) -> np.ndarray:
    """The three hashes of each word, a line each."""
    return np.concatenate([piece.hashes[None], piece.prefixes])


def rows_of(hashes: np.ndarray) -> np.ndarray:
    """The three table rows of each word; a prefix differs from the same bytes as a word."""
    kinds = np.array([[0], [0x5851F42D4C957F2D], [0x14057B7EF767814F]], U)
    return (mix(hashes ^ kinds) >> U(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Network:
    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    default: float = 0.0

    def embedded(self, hashes: np.ndarray) -> np.ndarray:
        return self.table[rows_of(hashes)].sum(axis=0)

    def pooled(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The largest value of each filter in each run of rows of ``words``; 0 at least.

        ``words`` are embedded; a filter of width k sees k words of one document, with zeros
        behind its end.
        """
        n, most = len(bounds) - 1, []
        lengths = np.diff(bounds)
        left = np.repeat(bounds[1:], lengths) - np.arange(len(words))
        for k, filters in zip(FILTER_WIDTHS, self.filters, strict=True):
            value = np.zeros((len(words), filters.shape[2]), np.float32)
            for j in range(k):
                seen = words[j:] if j == 0 else np.where((left[:-j] > j)[:, None], words[j:], 0)
                value[: len(words) - j] += seen @ filters[j]
            out = np.zeros((n, filters.shape[2]), np.float32)
            some = np.flatnonzero(lengths)
            if len(some):
                out[some] = np.maximum.reduceat(value, bounds[some], axis=0)
            most.append(out)
        return np.maximum(np.concatenate(most, axis=1) + self.bias, 0)

    def logits(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One logit for each document; long documents go block by block with an overlap."""
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        best = np.zeros((len(counts), len(self.bias)), np.float32)
        first = 0
        while first < len(counts):
            last = int(np.searchsorted(bounds, bounds[first] + BLOCK, "right")) - 1
            last = min(max(last, first + 1), len(counts))
            low, high = bounds[first], bounds[last]
            if high - low <= BLOCK:
                part = self.embedded(hashes[:, low:high])
                best[first:last] = self.pooled(part, bounds[first : last + 1] - low)
            else:
                for at in range(low, high, BLOCK):
                    part = self.embedded(hashes[:, at : min(high, at + BLOCK + FILTER_WIDTHS[-1] - 1)])
                    found = self.pooled(part, np.array([0, len(part)]))
                    best[first] = np.maximum(best[first], found[0])
            first = last
        return best @ self.out + self.offset


def _new(rng: np.random.Generator) -> Network:
    each = [
        rng.normal(0, 1 / np.sqrt(k * WIDTH), (k, WIDTH, FILTERS)).astype(np.float32)
        for k in FILTER_WIDTHS
    ]
    # All filters begin by looking for rows that lean to the label, and count towards it.
    for filters in each:
        filters[:, 0] = np.abs(filters[:, 0])
    n = FILTERS * len(FILTER_WIDTHS)
    return Network(
        np.zeros((1 << TABLE_BITS, WIDTH), np.float32),
        each,
        np.zeros(n, np.float32),
        np.abs(rng.normal(0, 0.3, n)).astype(np.float32),
        -1.0,
    )


def train(docs: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, rate: float = 0.02) -> Network:
    """Adagrad over documents of ``(word hashes, label)``, one after the other in seeded order.

    Only the words under a filter's largest value receive a gradient.
    """
    rng = np.random.default_rng(11)
    net = _new(rng)
    seen = np.zeros((2, 1 << TABLE_BITS))
    for hashes, label in docs:
        seen[label, np.unique(rows_of(hashes))] += 1
    n = np.maximum(1, [[sum(1 - y for _, y in docs)], [sum(y for _, y in docs)]])
    share, both = seen / n, seen.sum(axis=0) / len(docs)
    used = np.flatnonzero(both)
    net.table[used] = rng.normal(0, 0.05, (len(used), WIDTH)).astype(np.float32)
    # The difference of two shares in deviations, without what chance alone would give.
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n).sum())
    lean = (share[1] - share[0]) / spread
    net.table[:, 0] += (np.sign(lean) * np.maximum(np.abs(lean) - CHANCE, 0) / 4).astype(np.float32)
    squares = {"table": np.full((1 << TABLE_BITS, 1), 1e-4, np.float32)}
    filter_squares = [np.full(f.shape, 1e-4, np.float32) for f in net.filters]
    bias_squares, out_squares = np.full(len(net.bias), 1e-4), np.full(len(net.out), 1e-4)
    positive = max(1, sum(label for _, label in docs))
    weight = {1: 0.5 * len(docs) / positive, 0: 0.5 * len(docs) / max(1, len(docs) - positive)}
    offset_square = 1e-4
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            hashes, label = docs[d]
            if not hashes.shape[1]:
                continue
            rows = rows_of(hashes)
            words = net.table[rows].sum(axis=0)
            best, spots = [], []
            for k, filters in zip(FILTER_WIDTHS, net.filters, strict=True):
                value = np.zeros((len(words), FILTERS), np.float32)
                for j in range(min(k, len(words))):
                    value[: len(words) - j] += words[j:] @ filters[j]
                spot = value.argmax(axis=0)
                spots.append(spot)
                best.append(value[spot, np.arange(FILTERS)])
            pooled = np.concatenate(best) + net.bias
            active = np.maximum(pooled, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ net.out + net.offset, -30, 30)))
            error = float((p - label) * weight[label])
            to_pool = np.where(pooled > 0, error * net.out, 0).astype(np.float32)
            g = error * active
            out_squares += g * g
            net.out -= (rate * g / np.sqrt(out_squares)).astype(np.float32)
            bias_squares += to_pool * to_pool
            net.bias -= (rate * to_pool / np.sqrt(bias_squares)).astype(np.float32)
            offset_square += error * error
            net.offset -= rate * error / np.sqrt(offset_square)
            at = 0
            for i, (k, spot) in enumerate(zip(FILTER_WIDTHS, spots, strict=True)):
                g, at = to_pool[at : at + FILTERS], at + FILTERS
                if not g.any():
                    continue
                for j in range(k):
                    word = spot + j
                    inside = word < len(words)
                    word = np.minimum(word, len(words) - 1)
                    step = np.where(inside, g, 0)
                    own = words[word] * step[:, None]
                    back = net.filters[i][j].T * step[:, None]
                    filter_squares[i][j] += own.T**2
                    net.filters[i][j] -= rate * own.T / np.sqrt(filter_squares[i][j])
                    for table_rows in rows[:, word]:
                        np.add.at(squares["table"], table_rows, (back**2).mean(axis=1, keepdims=True))
                        change = -rate * back / np.sqrt(squares["table"][table_rows])
                        np.add.at(net.table, table_rows, change)
    return net


def threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit between the classes with the fewest errors, in the widest gap among equals."""
    if not len(logits):
        return 0.0
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], labels[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + (len(y) - y.sum()) - np.concatenate([[0], np.cumsum(1 - y)])
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    gap = np.concatenate([[1.0], x[1:] - x[:-1], [1.0]])
    gap[1:-1][x[1:] == x[:-1]] = -1
    ok = np.flatnonzero((wrong == wrong[gap >= 0].min()) & (gap >= 0))
    return float(edges[ok[np.argmax(gap[ok])]])


def _word_lists(languages: language_id.Model):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text"), SYMBOLS, LOWER, PREFIXES):
                n = len(piece.counts)
                parts = np.split(hashes_of(piece), np.cumsum(piece.counts)[:-1], axis=1)
                texts = batch.column("text").slice(piece.first, n)
                langs = [languages.predict(text.as_py())[0] for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("order").slice(piece.first, n),
                        batch.column("toxic").slice(piece.first, n),
                        pa.array(langs, pa.string()),
                        pa.array([part.tobytes() for part in parts], pa.binary()),
                    ],
                    names=["order", "toxic", "lang", "words"],
                )

    return emit


def bounded_bytes(docs: DataFrame, chosen: DataFrame, most: int = BYTES_PER_CLASS) -> DataFrame:
    """Those rows of ``chosen``, ``doc_id, toxic, order``, whose texts have ``most`` bytes a label together.

    They are the first by ``order``. An id whose texts have more than a sixteenth of the bytes is left
    out, so that none takes the place of all others. Only sizes are compared, one row an id.
    """
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    sizes = sizes.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "order")
    sizes = sizes.agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= most // 16)
    so_far = F.sum("bytes").over(Window.partitionBy("toxic").orderBy("order", "doc_id"))
    return sizes.withColumn("so_far", so_far).where(F.col("so_far") <= most).select(*chosen.columns)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    languages: language_id.Model,
    per_class: int = ROWS_PER_CLASS,
    most_bytes: int = BYTES_PER_CLASS,
) -> Network:
    """Learn from about ``per_class`` documents of each label of ``doc_id, toxic``.

    Their texts have ``most_bytes`` bytes a label at most, which bounds what reaches the driver.
    Labels that are null are not used, nor those of documents that are missing. Without labels of
    both kinds every score is 0.
    """
    known = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = language_id.bounded_sample(known, "toxic", per_class, "doc_id", "toxic")
    chosen = bounded_bytes(docs, chosen, most_bytes)
    # The sample is bounded, so the texts need no shuffle.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.mapInArrow(
        _word_lists(languages), "order long, toxic int, lang string, words binary"
    ).collect()
    found.sort(key=lambda r: (r.order, bytes(r.words)))
    docs_of = [(np.frombuffer(r.words, U).reshape(3, -1), r.toxic) for r in found]
    if len({label for _, label in docs_of}) < 2:
        net = _new(np.random.default_rng(11))
        net.out[:], net.offset = 0, -30.0
        return net
    learn = [d for r, d in zip(found, docs_of, strict=True) if r.order % 4]
    check = [(r.lang, *d) for r, d in zip(found, docs_of, strict=True) if not r.order % 4]
    if len({label for _, label in learn}) < 2:
        learn = docs_of
    net = train(learn)
    if check:
        lengths = np.array([h.shape[1] for _, h, _ in check])
        logits = net.logits(np.concatenate([h for _, h, _ in check], axis=1), lengths)
        marks, langs = np.array([y for *_, y in check]), np.array([lang for lang, *_ in check])
        if len(set(marks)) == 2:
            net.default = threshold(logits, marks)
            for lang in sorted(set(langs)):
                own = langs == lang
                # A language with few of a kind has no threshold of its own.
                if min(marks[own].sum(), (1 - marks[own]).sum()) >= 10:
                    net.thresholds[str(lang)] = threshold(logits[own], marks[own])
    return net


def scores(docs: DataFrame, net: Network, languages: language_id.Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``.

    Only the text counts. A null or empty text has the score of a text without any word of the
    training rows, below 0.5 unless labels say otherwise. Ids pass through, null or repeated.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((net, languages))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, languages = shared.value
        for batch in batches:
            texts = batch.column("text")
            for piece in pieces(texts, SYMBOLS, LOWER, PREFIXES):
                n = len(piece.counts)
                logits = net.logits(hashes_of(piece), piece.counts).astype(float)
                own = [languages.predict(t.as_py())[0] for t in texts.slice(piece.first, n)]
                logits -= [net.thresholds.get(lang, net.default) for lang in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(piece.first, n),
                        pa.array(1 / (1 + np.exp(-np.clip(logits, -40, 40)))),
                    ],
                    names=["doc_id", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(emit, f"doc_id {id_type}, score double")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learnt from labels of four parts of five."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(remainder() != 0)
    languages = language_id.fit(docs.where(remainder() != 0))
    net = fit(docs, labels, languages)
    return scores(docs, net, languages).select(
        "doc_id",
        (remainder() == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
