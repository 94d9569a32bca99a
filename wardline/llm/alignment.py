"""Alignment of two tokenizers by composing fragments of byte ranges.

Both tokenizers cut the same bytes into tokens. Where tokens of both end, a group closes. A text is
taken in byte ranges; the tokens that start in a range are a fragment: an open head (up to the first
end that both have), closed groups, and an open tail (behind the last such end). Fragments form a
monoid: composing two neighbours looks for common ends among the left one's tail and the right one's
head, closes the groups found there and leaves the rest open. Closed groups are kept as text and as
links, so a fragment's open parts are all that later composition looks at.

Texts up to ``SPAN`` bytes are aligned range by range where they are read. Longer ones are dealt out
in spans: each task makes the fragment of a span out of those of its ranges, and rounds of grouping
compose the spans of a text, ``FAN`` at a time, on as many tasks as there are groups.

A link is a pair of tokens whose bytes overlap. Both tokenizers tile the text, so links are the
stretches between neighbouring token ends. How often a pair of ids is linked in the corpus is one
grouping of links that were counted by text before.

Texts are tokenised in units that end before a space between two characters that are neither white
space nor U+2581; a space is put before the text, so each unit begins with one. Neither tokenizer has a token across such a place (the pieces of the second are
searched for one; if there is, a text is one unit). A unit longer than ``GIANT`` bytes stays whole in
the span in which it begins.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import read, stored
from wardline.llm.units import NOT_PLAIN, Encoded, Units, byte_letters, flat, ranks

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
RANGE = 2_048
SPAN = 65_536
GIANT = 16_384
FAN = 8
SLICE = 1 << 20
MOST_PAIRS = 1 << 20

_INNER = r"[^\s▁\u180e\u200b\ufeff]"
UNIT_END = re.compile(rf"(?<={_INNER}) (?={_INNER})")


class Tokenizers:
    """Both tokenizers with the bytes of their tokens, and the units met so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, own in self.a.get_vocab().items():
            known = all(c in letters for c in token)
            self.a_bytes[own] = bytes(map(letters.get, token)) if known else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)])
            if re.fullmatch(r"<0x[0-9A-F]{2}>", p)
            else p.replace("▁", " ").encode()
            for p in pieces
        ]
        self.whole = any(re.search("[^▁]▁", p) for p in pieces)
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)
        # Equal to the first tokenizer on plain units, and quicker.
        self.quick = ranks(a_path, public_tokenizers.PATTERN)
        self.known = Units(self.encoded, tables=3, most=1 << 21)

    def units(self, text: str) -> list[str]:
        """The units of a text, each without the space before it, which the first one has too."""
        return [text] if self.whole else UNIT_END.split(text)

    def encoded(self, units: list[str]) -> Encoded:
        """Ids of both, and whether they give back the unit's bytes."""
        b, b_counts = flat(self.b.encode(units, num_threads=1))  # puts the space before a text itself
        plain = [not NOT_PLAIN.search(unit) for unit in units] if self.quick else [False] * len(units)
        if all(plain):
            a, a_counts = self.quickly(units)
        else:
            rest = (u for u, known in zip(units, plain, strict=True) if not known)
            slow = iter(self.a.encode_batch_fast([f" {u}" for u in rest], add_special_tokens=False))
            a, a_counts = flat(
                [self.quick.encode_ordinary(f" {u}") if p else next(slow).ids for u, p in zip(units, plain, strict=True)]
            )
        lengths = np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units))
        exact = np.ones(len(units), np.int64)
        raw = f" {' '.join(units)}".encode()
        for ids, counts, known, sizes in (
            (a, a_counts, self.a_bytes, self.a_lengths), (b, b_counts, self.b_bytes, self.b_lengths)
        ):
            sums = np.concatenate([[0], np.cumsum(sizes[ids])])
            bounds = np.concatenate([[0], np.cumsum(counts)])
            whole = b"".join(map(known.__getitem__, ids.tolist()))
            if whole == raw and (np.diff(sums[bounds]) == lengths).all():
                continue
            at = sums[bounds].tolist()
            exact &= [whole[i:j] == f" {u}".encode() for i, j, u in zip(at, at[1:], units, strict=False)]
        return [(a, a_counts), (b, b_counts), (exact, np.ones(len(units), np.int64))]

    def quickly(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain units by ranks: all in one text, parted where the bytes of each end."""
        ids = np.array(self.quick.encode_ordinary(f" {' '.join(units)}"), np.int64)
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        last = np.searchsorted(np.cumsum(self.a_lengths[ids]), ends) + 1
        return ids, np.diff(last, prepend=0)


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _none() -> np.ndarray:
    return np.zeros(0, np.int64)


@dataclass
class Tokens:
    """Tokens of both in a stretch of a text, with the byte at which each ends."""

    a: np.ndarray = field(default_factory=_none)
    a_ends: np.ndarray = field(default_factory=_none)
    b: np.ndarray = field(default_factory=_none)
    b_ends: np.ndarray = field(default_factory=_none)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(
            np.concatenate([self.a, other.a]),
            np.concatenate([self.a_ends, other.a_ends]),
            np.concatenate([self.b, other.b]),
            np.concatenate([self.b_ends, other.b_ends]),
        )

    def between(self, low: int, high: int) -> Tokens:
        """The tokens that end behind ``low`` and not behind ``high``."""
        i, j = np.searchsorted(self.a_ends, [low, high], "right")
        k, m = np.searchsorted(self.b_ends, [low, high], "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def __bool__(self) -> bool:
        return bool(len(self.a) or len(self.b))


@lru_cache(maxsize=1)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all numbers below ``n``, and how many each has."""
    shown = [str(k).encode() for k in range(n)]
    width = max(map(len, shown)) + 1
    table = np.frombuffer(b"".join(s.ljust(width) for s in shown), np.uint8).reshape(n, width)
    return table, np.array([len(s) for s in shown])


def _shown(ids: np.ndarray, marks: np.ndarray) -> bytes:
    """Every id in decimal with its mark behind it."""
    table, lengths = _digits(1 << max(16, int(ids.max(initial=0)).bit_length()))
    wide = table[ids]
    lengths = lengths[ids]
    wide[np.arange(len(ids)), lengths] = marks
    return wide[np.arange(wide.shape[1]) <= lengths[:, None]].tobytes()


def sealed(tokens: Tokens, cuts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Closed groups as ``a1,a2|b1;`` one after the other, and their links as ``b << 32 | a``.

    ``cuts`` are the common ends, the last token's own among them.
    """
    group_a, group_b = np.searchsorted(cuts, tokens.a_ends), np.searchsorted(cuts, tokens.b_ends)
    n_a, n_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    place_a = np.arange(len(group_a)) + (last_b - n_b)[group_a]
    place_b = np.arange(len(group_b)) + last_a[group_b]
    ids = np.empty(len(group_a) + len(group_b), np.int64)
    marks = np.full(len(ids), ord(","), np.uint8)
    ids[place_a], ids[place_b] = tokens.a, tokens.b
    marks[last_a + last_b - n_b - 1], marks[last_a + last_b - 1] = ord("|"), ord(";")
    ends = np.union1d(tokens.a_ends, tokens.b_ends)
    a = tokens.a[np.searchsorted(tokens.a_ends, ends)]
    b = tokens.b[np.searchsorted(tokens.b_ends, ends)]
    return _shown(ids, marks), b << 32 | a


@dataclass
class Fragment:
    """A stretch of a text: open head, closed groups, open tail.

    Without a common end (``cut`` false) all tokens are in ``head``. ``text`` and ``links`` are those
    of the closed groups, as lists of parts that are put together once at the end.
    """

    head: Tokens = field(default_factory=Tokens)
    cut: bool = False
    n_groups: int = 0
    n_a: int = 0
    n_b: int = 0
    text: list[bytes] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)
    tail: Tokens = field(default_factory=Tokens)

    @staticmethod
    def closing(tokens: Tokens) -> Fragment:
        """The tokens of one group, closed, and no more."""
        if not tokens:
            return Fragment(cut=True)
        text, links = sealed(tokens, tokens.a_ends[-1:])
        return Fragment(Tokens(), True, 1, len(tokens.a), len(tokens.b), [text], [links])


def fragment(tokens: Tokens) -> Fragment:
    """The fragment of some neighbouring tokens."""
    cuts = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    if not len(cuts):
        return Fragment(tokens)
    inner = tokens.between(cuts[0], cuts[-1])
    closed = Fragment(tokens.between(-1, cuts[0]), True, tail=tokens.between(cuts[-1], np.iinfo(np.int64).max))
    if inner:
        text, links = sealed(inner, cuts[1:])
        closed.n_groups, closed.n_a, closed.n_b = len(cuts) - 1, len(inner.a), len(inner.b)
        closed.text, closed.links = [text], [links]
    return closed


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring stretches; associative, with ``Fragment()`` as neutral element."""
    met = fragment((left.tail if left.cut else left.head) + right.head)
    if not met.cut:
        head, tail = (left.head, met.head) if left.cut else (met.head, Tokens())
        return Fragment(
            head, left.cut, left.n_groups, left.n_a, left.n_b, left.text, left.links, tail
        )
    parts = [left, met, right]
    head = met.head
    if left.cut:
        head = left.head
        parts.insert(1, Fragment.closing(met.head))
    return Fragment(
        head,
        True,
        sum(p.n_groups for p in parts),
        sum(p.n_a for p in parts),
        sum(p.n_b for p in parts),
        [x for p in parts for x in p.text],
        [x for p in parts for x in p.links],
        right.tail if right.cut else met.tail,
    )


def reduced(fragments: list[Fragment]) -> Fragment:
    """All of them composed, neighbours first."""
    while len(fragments) > 1:
        pairs = [compose(*fragments[k : k + 2]) for k in range(0, len(fragments) - 1, 2)]
        fragments = pairs + fragments[len(pairs) * 2 :]
    return fragments[0] if fragments else Fragment()


@dataclass
class Span:
    """The part of a text whose tokens start in bytes ``low`` to ``high``, and units around it."""

    doc_id: object
    row: int
    span: int
    n_spans: int
    begin: int
    low: int
    high: int
    text: str | None


def _ranges(spans: list[Span], tools: Tokenizers, size: int, giant: int) -> list[Fragment | None]:
    """The fragment of every span, from those of its ranges; ``None`` if its bytes are not kept."""
    lists = [tools.units(span.text) for span in spans]
    counts = np.array([len(own) for own in lists])
    numbers = tools.known.numbers([unit for own in lists for unit in own])
    (a, per_a), (b, per_b), (exact, _) = (tools.known.of(numbers, table) for table in range(3))
    sums_a, sums_b = np.concatenate([[0], np.cumsum(per_a)]), np.concatenate([[0], np.cumsum(per_b)])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    first_a, first_b = sums_a[bounds], sums_b[bounds]
    found: list[Fragment | None] = []
    for k, span in enumerate(spans):
        own_a, own_b = a[first_a[k] : first_a[k + 1]], b[first_b[k] : first_b[k + 1]]
        if not exact[bounds[k] : bounds[k + 1]].all():
            found.append(None)
            continue
        ends_a = span.begin + np.cumsum(tools.a_lengths[own_a])
        ends_b = span.begin + np.cumsum(tools.b_lengths[own_b])
        starts_a, starts_b = ends_a - tools.a_lengths[own_a], ends_b - tools.b_lengths[own_b]
        if span.n_spans > 1:
            # Tokens of a very long unit count where the unit begins.
            lengths = np.array([len(u.encode()) + 1 for u in lists[k]])
            unit_starts = span.begin + np.cumsum(lengths) - lengths
            for starts, per in ((starts_a, per_a), (starts_b, per_b)):
                own = per[bounds[k] : bounds[k + 1]]
                long = np.repeat(lengths > giant, own)
                starts[long] = np.repeat(unit_starts, own)[long]
        parts = []
        last = max(starts_a[-1], starts_b[-1])
        edges = np.append(np.arange(span.low, min(span.high, last + 1), size), span.high)
        edges_a, edges_b = np.searchsorted(starts_a, edges), np.searchsorted(starts_b, edges)
        for n in range(len(edges) - 1):
            i, j = edges_a[n : n + 2]
            p, q = edges_b[n : n + 2]
            parts.append(fragment(Tokens(own_a[i:j], ends_a[i:j], own_b[p:q], ends_b[p:q])))
        found.append(reduced(parts))
    return found


# A fragment as columns; ``kept`` is false where a tokenizer loses bytes.
_LONGS = pa.list_(pa.int64())
_OPEN = ("a", "a_ends", "b", "b_ends")
_COUNTS = ("n_groups", "n_a", "n_b")
FRAGMENT_FIELDS = (
    [("span", pa.int64()), ("kept", pa.bool_()), ("cut", pa.bool_())]
    + [(name, pa.int64()) for name in _COUNTS]
    + [("text", pa.binary()), ("links", _LONGS)]
    + [(f"{part}_{name}", _LONGS) for part in ("head", "tail") for name in _OPEN]
)
FRAGMENT_SCHEMA = "span long, kept boolean, cut boolean, n_groups long, n_a long, n_b long, " + (
    "text binary, links array<long>, "
    + ", ".join(f"{part}_{name} array<long>" for part in ("head", "tail") for name in _OPEN)
)
ROW_SCHEMA = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>"
)


def _as_row(span: int, part: Fragment | None) -> dict:
    kept, part = part is not None, part or Fragment()
    found = {"span": span, "kept": kept, "cut": part.cut, "text": b"".join(part.text)}
    found |= {name: getattr(part, name) for name in _COUNTS}
    found["links"] = np.concatenate([_none(), *part.links])
    for side in ("head", "tail"):
        found |= {f"{side}_{name}": getattr(getattr(part, side), name) for name in _OPEN}
    return found


def _of_row(row: dict) -> Fragment | None:
    if not row["kept"]:
        return None
    sides = [
        Tokens(*(np.array(row[f"{side}_{name}"], np.int64) for name in _OPEN)) for side in ("head", "tail")
    ]
    counts = [row[name] for name in _COUNTS]
    return Fragment(sides[0], row["cut"], *counts, [row["text"]], [np.array(row["links"], np.int64)], sides[1])


def _batch(doc_ids: pa.Array, row_ids: pa.Array, rows: list[dict], fields) -> pa.RecordBatch:
    """Rows with the document and the row that each belongs to."""
    columns = [pa.array([row[name] for row in rows], kind) for name, kind in fields]
    names = ["doc_id", "row", *(name for name, _ in fields)]
    return pa.RecordBatch.from_arrays([doc_ids, row_ids, *columns], names=names)


def finished(whole: Fragment | None) -> dict:
    """Counts, the digest of the groups and counted links of a whole text; its start closes the head."""
    if whole is None:
        whole = Fragment(cut=True)
    if not whole.cut and whole.head or whole.tail:
        raise AssertionError("tokens behind the last common end")
    parts = [Fragment.closing(whole.head), whole]
    links = np.concatenate([_none(), *(x for p in parts for x in p.links)])
    pairs, times = np.unique(links, return_counts=True)
    n_groups = sum(p.n_groups for p in parts)
    digest = hashlib.sha256()
    text = [x for p in parts for x in p.text if x]
    for x in text[:-1]:
        digest.update(x)
    if text:
        digest.update(text[-1][:-1])
    return {
        "n_a": sum(p.n_a for p in parts),
        "n_b": sum(p.n_b for p in parts),
        "n_groups": n_groups,
        "n_links": len(links),
        "groups_sha256": digest.hexdigest() if n_groups else "",
        "pairs": pairs,
        "times": times.astype(np.int32),
    }


_ROW_FIELDS = (
    [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("pairs", _LONGS), ("times", pa.list_(pa.int32()))]
)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``SLICE`` bytes of text, so that memory does not follow the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // SLICE
        edges = np.flatnonzero(np.diff(part, prepend=-1))
        for k, end in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            yield batch.slice(k, end - k)


def _of_texts(paths: tuple[str, str], size: int, giant: int):
    """Rows of texts that are one span."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(*paths)
        for batch in _slices(batches):
            texts = batch.column("text").to_pylist()
            spans = [Span(None, k, 0, 1, 0, 0, len(t.encode()) + 1, t) for k, t in enumerate(texts) if t]
            found = dict(zip((s.row for s in spans), _ranges(spans, tools, size, giant), strict=True))
            rows = [finished(found.get(k)) for k in range(len(texts))]
            yield _batch(batch.column("doc_id"), batch.column("row"), rows, _ROW_FIELDS)

    return emit


SPAN_SCHEMA = "span long, n_spans long, begin long, low long, high long, text string"


def _cut(paths: tuple[str, str], span: int, giant: int):
    """Long texts as spans: the units that overlap each, a very long one where it begins."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(*paths)
        for batch in batches:
            for n in range(batch.num_rows):
                units = tools.units(batch.column("text")[n].as_py())
                lengths = np.array([len(u.encode()) + 1 for u in units])
                ends = np.cumsum(lengths)
                starts = ends - lengths
                reach = np.where(lengths > giant, starts + 1, ends)
                edges = np.arange(0, ends[-1], span)
                for k, low in enumerate(edges):
                    i, j = np.searchsorted(reach, low, "right"), np.searchsorted(starts, low + span)
                    if i == j:
                        continue
                    own = [k, len(edges), starts[i], low, low + span, " ".join(units[i:j])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id")[n : n + 1], batch.column("row")[n : n + 1]]
                        + [pa.array([x]) for x in own],
                        names=["doc_id", "row", "span", "n_spans", "begin", "low", "high", "text"],
                    )

    return emit


def _of_spans(paths: tuple[str, str], size: int, giant: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(*paths)
        for batch in _slices(batches):
            spans = [Span(**row) for row in batch.to_pylist()]
            found = _ranges(spans, tools, size, giant)
            rows = [_as_row(span.span, part) for span, part in zip(spans, found, strict=True)]
            yield _batch(batch.column("doc_id"), batch.column("row"), rows, FRAGMENT_FIELDS)

    return emit


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``doc_id, row, span, parts``: the parts of each composed in order."""
    for batch in batches:
        for n in range(batch.num_rows):
            parts = [_of_row(part) for part in batch.column("parts")[n].as_py()]
            whole = None if any(p is None for p in parts) else reduced(parts)
            own = [_as_row(batch.column("span")[n].as_py(), whole)]
            yield _batch(batch.column("doc_id")[n : n + 1], batch.column("row")[n : n + 1], own, FRAGMENT_FIELDS)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(batch.num_rows):
            one = batch.slice(n, 1)
            own = [finished(_of_row(one.to_pylist()[0]))]
            yield _batch(one.column("doc_id"), one.column("row"), own, _ROW_FIELDS)


def _long_texts(long: DataFrame, paths, size: int, span: int, giant: int) -> DataFrame:
    """The same columns as of short texts, by rounds that compose ``FAN`` neighbouring spans each."""
    keys = f"doc_id {long.schema['doc_id'].dataType.simpleString()}, row long, "
    spans = long.mapInArrow(_cut(paths, span, giant), keys + SPAN_SCHEMA)
    spans = spans.repartition("row", "span")
    parts = stored(spans.mapInArrow(_of_spans(paths, size, giant), keys + FRAGMENT_SCHEMA), "fragments")
    most = parts.agg(F.max("span")).first()[0] or 0
    columns = [name for name, _ in FRAGMENT_FIELDS]
    while most:
        grouped = parts.groupBy("doc_id", "row", F.floor(F.col("span") / FAN).alias("next")).agg(
            F.array_sort(F.collect_list(F.struct(*columns))).alias("parts")
        )
        grouped = grouped.select("doc_id", "row", F.col("next").alias("span"), "parts")
        parts = stored(grouped.mapInArrow(_composed, keys + FRAGMENT_SCHEMA), "fragments")
        most //= FAN
    return parts.mapInArrow(_finished, keys + ROW_SCHEMA)


def aligned(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    size: int = RANGE,
    span: int = SPAN,
    giant: int = GIANT,
) -> DataFrame:
    """``doc_id, row`` and the alignment of each row of ``docs``, stored.

    ``pairs`` are the linked ids (``b << 32 | a``), each once, ``times`` how often each is linked in the
    text. A text that is null or empty, or whose bytes a tokenizer does not give back, has no tokens:
    zeros, no pairs and an empty digest. Rows keep their ids, null and repeated ones too, and repeated
    rows are aligned alike. Other columns are not read, whatever their names. ``a_path`` is a file of
    the byte-level tokenizer and ``b_path`` one of the other, at a place that every executor has.
    """
    paths = (a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE))
    docs = docs.select("doc_id", "text")
    keys = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row long, "
    is_long = F.coalesce(F.octet_length("text") >= span, F.lit(False))
    # Even numbers for short texts, odd ones for long: the two plans need not number rows alike.
    number = F.monotonically_increasing_id() * 2
    short = docs.where(~is_long).withColumn("row", number)
    short = short.mapInArrow(_of_texts(paths, size, giant), keys + ROW_SCHEMA)
    long = docs.where(is_long).withColumn("row", number + 1)
    return stored(short.unionByName(_long_texts(long, paths, size, span, giant)), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each pair of ids, and whether its second id has no higher count."""
    counted = rows.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = counted.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counted = stored(counted, "pairs")
    second = F.shiftright("pair", 32)
    highest = counted.groupBy(second.alias("second")).agg(F.max("count").alias("highest"))
    joined = counted.join(highest, second == F.col("second"))
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, most_pairs: int = MOST_PAIRS, **options) -> DataFrame:
    """Per document the counts of :func:`aligned` and how common its links are in the corpus.

    ``n_best`` are the links whose pair is the commonest of its second id, ties included; ``count_sum``
    adds the corpus-wide counts over all links. Odd rows as in :func:`aligned`. The counts of pairs are
    broadcast if there are at most ``most_pairs`` of them, else joined through a shuffle.
    """
    rows = aligned(docs, **options)
    pairs = stored(pair_counts(rows), "pair-counts")
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times")))
    if pairs.count() <= most_pairs:
        pairs = F.broadcast(pairs)
    links = links.join(pairs, F.col("pairs") == F.col("pair"))
    sums = links.groupBy(F.col("row").alias("summed")).agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    joined = rows.drop("pairs", "times").join(sums, F.col("row") == F.col("summed"), "left")
    return joined.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Both tokenizers on every document."""
    return alignment(read(spark, folder, "documents"))
