"""Document quality by hierarchical empirical Bayes.

Evidence of a document is a logistic regression on what its characters and words look like,
trained on a bounded sample of labelled documents. Documents of one host, and of one path on that
host, tend to be alike. For every host and path the expected number of good documents is summed
over *all* its documents; the host's rate is shrunk towards the global rate and the path's rate
towards its host's, each as if ``strength`` documents more had been seen at the rate above.
The strengths are estimated from the data (method of moments over the sites). A document's
posterior odds are its evidence times the odds of its path relative to the global odds, so a
path with three documents says hardly anything and one with a million says what they say.

The host is the part of ``source`` before the first slash, without a scheme such as ``http://``, the
path all that follows that slash, empty if there is none. Grouping is by partial aggregation over narrow rows. The table of sites is joined by its
measured size; there may be any number of sites.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import remainder, set_aside, stored
from wardline.llm.language_id import bounded_sample
from wardline.llm.words import SAME, WHITE, pieces, slices, text_buffer

ROWS_PER_CLASS = 2_000
LEAST = 1e-6
SYMBOLS = b"!#$%&*|<>{}[]=+_~^@/\\"
NAMES = (
    "letters", "upper", "digits", "blank", "line_ends", "stops", "commas",
    *[f"symbol_{chr(c)}" for c in SYMBOLS],
    "word_length", "distinct", "log_words", "all_upper", "doubled_lines",
)


def features(text: pa.Array) -> np.ndarray:
    """One line of ``NAMES`` for each text, from whole texts."""
    data, offsets = text_buffer(text)
    out = np.zeros((len(text), len(NAMES)))
    words = np.zeros(len(text), np.int64)
    distinct = np.zeros(len(text), np.int64)
    lines = np.zeros(len(text))
    line_end = np.zeros(256, bool)
    line_end[10] = True
    for piece in pieces(text, WHITE, SAME):
        words[piece.first : piece.first + len(piece.counts)] = piece.counts
        rows = piece.rows
        order = np.lexsort((piece.hashes, rows))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(piece.hashes[order].view(np.int64)) != 0) | (np.diff(rows[order]) != 0)
        distinct[piece.first : piece.first + len(piece.counts)] = np.bincount(
            rows[order][new], minlength=len(piece.counts)
        )
    for piece in pieces(text, line_end, SAME):
        rows = piece.rows
        order = np.lexsort((piece.hashes, rows))
        same = (np.diff(piece.hashes[order].view(np.int64)) == 0) & (np.diff(rows[order]) == 0)
        n = np.bincount(rows[order][1:][same], minlength=len(piece.counts))
        lines[piece.first : piece.first + len(piece.counts)] = n / np.maximum(1, piece.counts)
    for k in range(len(text)):
        seen = np.zeros(256, np.int64)
        for at in range(offsets[k], offsets[k + 1], 1 << 20):
            seen += np.bincount(data[at : min(at + (1 << 20), offsets[k + 1])], minlength=256)
        total = max(1, seen.sum())
        upper, lower, wide = seen[65:91].sum(), seen[97:123].sum(), seen[128:].sum()
        letters = upper + lower + wide
        n = max(1, words[k])
        out[k] = [
            letters / total,
            upper / max(1, letters),
            seen[48:58].sum() / total,
            (seen[32] + seen[9]) / total,
            seen[10] / n,
            seen[46] / n,
            seen[44] / n,
            *(np.minimum(seen[c] / n, 3) for c in SYMBOLS),
            np.log1p(total / n),
            distinct[k] / n,
            np.log1p(words[k]),
            float(upper > 0.5 * letters),
            lines[k],
        ]
    return out


@dataclass
class Evidence:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.weights + self.offset, -15, 15)


def train(x: np.ndarray, y: np.ndarray, base: float, ridge: float = 1.0, steps: int = 40) -> Evidence:
    """Penalised logistic regression by Newton's method, both labels weighing the same.

    ``base`` is the share of good documents among all labels; the offset is set for it.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    good = max(1, y.sum())
    weight = np.where(y == 1, 0.5 * len(y) / good, 0.5 * len(y) / max(1, len(y) - good))
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + penalty * w
        bend = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(mean, scale, w[:-1], float(w[-1] + np.log(base / (1 - base))), base)


def _lines(columns: list[str]):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(text_buffer(batch.column("text"))[1]):
                x = features(batch.column("text").slice(first, last - first))
                own = [batch.column(c).slice(first, last - first) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(list(x), pa.list_(pa.float64()))], names=[*columns, "x"]
                )

    return emit


def fit(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> Evidence:
    """Learn from about ``per_class`` documents of each label of ``doc_id, quality``.

    Null labels are not used. Without both labels all evidence is the share of good labels, or
    one half without any.
    """
    known = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    n, good = known.agg(F.count(F.lit(1)), F.sum("quality")).first()
    base = ((good or 0) + 1) / (n + 2)
    chosen = bounded_sample(known, "quality", per_class, "doc_id", "quality")
    # The sample is bounded, so the texts need no shuffle.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.mapInArrow(
        _lines(["order", "quality"]), "order long, quality int, x array<double>"
    ).collect()
    found.sort(key=lambda r: (r.order, r.quality, r.x))
    x = np.array([r.x for r in found]).reshape(-1, len(NAMES))
    y = np.array([r.quality for r in found], float)
    if len(set(y)) < 2:
        none = np.zeros(len(NAMES))
        return Evidence(none, none + 1, none, float(np.log(base / (1 - base))), base)
    return train(x, y, base)


def _strength(groups: DataFrame, good: str, n: str, rate) -> float:
    """How many documents the level above counts for, by the method of moments.

    Deviations of the groups' rates from the rate above hold sampling noise and true differences;
    the strength is the ratio of what one document varies to what groups truly vary.
    """
    own = F.col(good) / F.col(n)
    noise, wide, rows, k = groups.agg(
        F.sum(rate * (1 - rate)), F.sum(F.col(n) * (own - rate) ** 2), F.sum(n), F.count(F.lit(1))
    ).first()
    if not k or k < 2 or noise is None:
        return 1e6
    between = (wide - noise) / max(1.0, rows - rows / k)
    return float(min(1e6, max(1.0, (noise / k) / max(between, 1e-9))))


def with_sites(docs: DataFrame) -> DataFrame:
    """Add ``_host`` and ``_path``; a null source is a host of its own, its path is empty."""
    site = F.regexp_replace(F.coalesce(F.col("source"), F.lit("\0")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    parts = F.split(site, "/", 2)
    return docs.withColumn("_host", parts[0]).withColumn(
        "_path", F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    )


def site_priors(evidence: DataFrame, base: float) -> DataFrame:
    """``_host, _path, prior`` from ``_host, _path, log_odds`` of all documents."""
    p = 1 / (1 + F.exp(-F.col("log_odds")))
    paths = stored(
        evidence.groupBy("_host", "_path").agg(F.sum(p).alias("good"), F.count(F.lit(1)).alias("n")),
        "paths",
    )
    hosts = stored(
        paths.groupBy(F.col("_host").alias("host")).agg(
            F.sum("good").alias("host_good"), F.sum("n").alias("host_n")
        ),
        "hosts",
    )
    good, n = hosts.agg(F.sum("host_good"), F.sum("host_n")).first()
    top = good / n if n else base
    above = _strength(hosts, "host_good", "host_n", F.lit(top))
    rate = (F.col("host_good") + above * F.lit(top)) / (F.col("host_n") + above)
    both = stored(
        paths.join(hosts.withColumn("host_rate", rate), F.col("_host") == F.col("host")), "rates"
    )
    own = _strength(both, "good", "n", F.col("host_rate"))
    prior = (F.col("good") + own * F.col("host_rate")) / (F.col("n") + own)
    return both.select("_host", "_path", prior.alias("prior"), F.lit(top).alias("top"))


def classify(docs: DataFrame, model: Evidence) -> DataFrame:
    """Every row of ``docs`` with ``quality_score``, the posterior probability that it is good.

    A null or empty text has the evidence of a text without characters. Ids pass through, null or
    repeated; repeated rows count as often as they occur. A column ``quality_score`` of ``docs``
    is replaced; all others are given back, whatever their names. No rows give no rows.
    """
    docs, own = set_aside(
        docs.select(*[c for c in docs.columns if c.lower() != "quality_score"]), ("text", "source")
    )
    sited = with_sites(docs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(text_buffer(batch.column("text"))[1]):
                part = batch.slice(first, last - first)
                odds = model.log_odds(features(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(odds, pa.float64())],
                    names=[*part.schema.names, "log_odds"],
                )

    def weighed(df: DataFrame) -> DataFrame:
        return df.mapInArrow(emit, T.StructType([*df.schema, T.StructField("log_odds", T.DoubleType())]))

    narrow = weighed(sited.select("_host", "_path", "text")).drop("text")
    priors = stored(site_priors(narrow, model.base), "priors")
    priors = priors.select(
        F.col("_host").alias("_prior_host"), F.col("_path").alias("_prior_path"), "prior", "top"
    )
    rows = weighed(sited).join(
        priors, (F.col("_host") == F.col("_prior_host")) & (F.col("_path") == F.col("_prior_path"))
    )

    def odds(column):
        inside = F.least(F.greatest(F.col(column), F.lit(LEAST)), F.lit(1 - LEAST))
        return F.log(inside / (1 - inside))

    posterior = F.col("log_odds") + odds("prior") - odds("top")
    return rows.select(*own, (1 / (1 + F.exp(-posterior))).alias("quality_score"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document, learnt from labels of four parts of five."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(remainder() != 0)
    found = classify(docs.select("doc_id", "source", "text"), fit(docs, labels))
    return found.select(
        "doc_id",
        (remainder() == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).alias("kept"),
    )
