"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are runs of one to three characters of the lower-cased text (other ASCII than letters
counts as a space), hashed to ``DIMENSIONS`` columns, as TF-IDF of unit length. Document
frequencies are counted over all training rows. The weights are learnt by follow the regularised
leader with elastic-net penalties, which leaves most of them at zero, from at most
``ROWS_PER_LANGUAGE`` rows of each language. A fifth of those rows is kept back to fit the
temperature that makes the probabilities honest.

What reaches the driver is bounded: the counts per language, the document frequencies
(``DIMENSIONS`` rows) and the hashed counts of the sample. A text is read in blocks, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import remainder

DIMENSIONS = 1 << 14
ROWS_PER_LANGUAGE = 500
BLOCK = 1 << 19
EPOCHS = 3
UNDETERMINED = "und"

_SPACE = np.arange(128, dtype=np.uint32)
_SPACE[[c for c in range(128) if not chr(c).isalpha()]] = 32
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram stands in a text."""
    found = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint32(32 - (DIMENSIONS - 1).bit_length())
    for at in range(0, len(text), BLOCK):
        part = f" {text[at : at + BLOCK]} ".lower()
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(code < 128, _SPACE[np.minimum(code, 127)], code)
        blank = code == 32
        code = code[~(blank & np.concatenate([[False], blank[:-1]]))]
        key = np.zeros(len(code), np.uint32)
        for n in range(3):
            if len(code) <= n:
                break
            key = (key[: len(code) - n] * _ODD[1]) ^ (code[n:] * _ODD[0])
            spread = key * _ODD[2]
            found += np.bincount((spread ^ (spread >> np.uint32(15))) * _ODD[0] >> shift, minlength=DIMENSIONS)
    return found


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the languages for one text's counts."""
        index = np.flatnonzero(found)
        x = _unit(found[index] * self.idf[index])
        return softmax(x @ self.weights[index] / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        p = self.probabilities(counts(text))
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt(x @ x)
    return x / length if length else x


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.05,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights (columns by classes) from ``(columns, values, class)`` rows."""
    z, n = np.zeros((DIMENSIONS, classes)), np.zeros((DIMENSIONS, classes))

    def weights(zs, ns):
        shrunk = np.sign(zs) * l1 - zs
        return np.where(np.abs(zs) <= l1, 0.0, shrunk / ((beta + np.sqrt(ns)) / alpha + l2))

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            index, x, label = rows[k]
            zs, ns = z[index], n[index]
            w = weights(zs, ns)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            more = ns + g * g
            z[index] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / alpha * w
            n[index] = more
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on rows that were kept back."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    at = np.arange(len(labels))
    loss = [-np.log(softmax(logits / t)[at, labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DIMENSIONS, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            total += counts(text.as_py() or "") > 0
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "docs"]
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, order, text in zip(*(batch.column(c) for c in ("lang", "order", "text")), strict=True):
            found = counts(text.as_py() or "")
            index = np.flatnonzero(found).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang.as_py()], pa.string()),
                    pa.array([order.as_py()], pa.int64()),
                    pa.array([index.tobytes()]),
                    pa.array([found[index].astype(np.int32).tobytes()]),
                ],
                names=["lang", "order", "grams", "counts"],
            )


def bounded_sample(rows: DataFrame, key: str, per_key: int, *columns: str) -> DataFrame:
    """About ``per_key`` rows of each value of ``key``, chosen by a hash of the id.

    One pass counts the values, which must be few (classes, not records); a second keeps rows
    whose hash is below the wanted share. Nothing is sorted. A value with fewer rows keeps all.
    """
    order = F.xxhash64("doc_id", F.lit("sample"))
    share = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(0.0)
    for value, n in rows.groupBy(key).count().collect():
        rate = F.when(F.col(key) == F.lit(value), min(1.0, per_key / n)).otherwise(rate)
    return rows.where(share < rate).select(*columns, order.alias("order"))


def fit(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from rows of ``doc_id, text, lang`` that have a language and a text."""
    rows = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    frequency = (
        rows.select("text").mapInArrow(_frequencies, "gram int, docs long")
        .groupBy("gram").agg(F.sum("docs")).collect()
    )
    df = np.zeros(DIMENSIONS)
    for gram, n in frequency:
        df[gram] = n
    idf = np.log((1 + df.max(initial=0)) / (1 + df)) + 1
    sample = bounded_sample(rows, "lang", per_language, "lang", "text")
    found = sample.mapInArrow(
        _features, "lang string, order long, grams binary, counts binary"
    ).collect()
    languages = sorted({r.lang for r in found})
    if not languages:
        return Model([], idf, np.zeros((DIMENSIONS, 0)), 1.0)
    learn, check = [], []
    for r in sorted(found, key=lambda r: (r.order, r.lang, bytes(r.grams))):
        index = np.frombuffer(r.grams, np.int32)
        x = _unit(np.frombuffer(r.counts, np.int32) * idf[index])
        (check if r.order % 5 == 0 else learn).append((index, x, languages.index(r.lang)))
    weights = follow_the_leader(learn, len(languages))
    logits = np.array([x @ weights[index] for index, x, _ in check])
    return Model(languages, idf, weights, temperature(logits, np.array([c for *_, c in check], int)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``.

    Only the text counts. A text that is null, empty or without a letter, or any text if there
    was nothing to learn from, is ``und`` with score 0. Ids pass through as they are, and
    repeated rows give repeated results.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [model.predict(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lang for lang, _ in said], pa.string()),
                    pa.array([score for _, score in said], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    schema = f"doc_id {id_type}, lang_pred string, score double"
    return docs.select("doc_id", "text").mapInArrow(emit, schema)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from four parts of five."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs.where(remainder() != 0))
    return predict(docs, model).select(
        "doc_id", (remainder() == 0).alias("held_out"), "lang_pred", "score"
    )
