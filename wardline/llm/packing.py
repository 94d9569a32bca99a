"""Packing documents into sequences of bounded length by best fit and a local search.

Every document becomes a list of ids with an end mark; one that is longer than a sequence is cut into
full pieces and a rest. Pieces are dealt evenly, by their key, into cells of about ``CELL`` pieces.
A cell packs its pieces by best fit in the order of their keys and then searches locally: the
emptiest sequence gives to fuller ones, by moving a piece, by exchanging one piece for a smaller
one, two for one or one for two, always the step that raises the sum of squared fills most,
until it is empty or no step is left. Then the next emptiest one gives. The search ends when there are
as few sequences as the sum of lengths allows, or none can be emptied.

Sequences that are more than ``OPEN`` of their length short of full are opened again, and their pieces
are dealt into the cells of another round, so that each cell does not keep a rest of its own. Rounds
end when what is open fits one cell, or no longer halves.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import read, stored
from wardline.llm.units import NOT_PLAIN, Encoded, Units, flat, ranks
from wardline.llm.words import slices, text_buffer

TOKENIZER = "word_bpe_49k.json"
END_MARK = 1
LENGTH = 4_096
CELL = 4_096
OPEN = 1 / 16


# Words of plain text, lower-cased, as the tokenizer parts them.
_LETTER = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
WORD = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
END = "\x01"


class Words:
    """Ids of texts from those of words met before.

    The tokenizer drops white space and has no token across it. Words of plain texts are parted here and
    encoded by ranks; other texts are parted at spaces only and left to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join([NOT_PLAIN.pattern, *(re.escape(t.content) for t in added)]))
        self.quick = ranks(path, f"[^{END}]*{END}", "</w>", END.encode())
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, own in self.tokenizer.get_vocab().items():
            self.ends[own] = token.endswith("</w>")
        self.words, self.others = Units(self.by_ranks), Units(self.by_tokenizer)

    def by_ranks(self, words: list[str]) -> Encoded:
        ids = np.array(self.quick.encode_ordinary(END.join(words) + END), np.int64)
        return [(ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))]

    def by_tokenizer(self, words: list[str]) -> Encoded:
        return [flat([e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)])]

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts one after the other, and how many each has."""
        plain = [self.quick is not None and not self.special.search(text) for text in texts]
        lists = [WORD.findall(t.lower()) if p else t.split(" ") for t, p in zip(texts, plain, strict=True)]
        if all(plain) or not any(plain):
            units = self.words if all(plain) else self.others
            ids, counts = units.of(units.numbers([word for own in lists for word in own]))
            bounds = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, lists)])]
            return ids, np.diff(bounds)
        parts = [self.ids([text]) for text in texts]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def _pieces(path: str, end_mark: int, length: int):
    """``doc_id, piece, start, length, ids_crc32, ids`` of every text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = words(path)
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for first, last in slices(offsets):
                some = batch.slice(first, last - first)
                ids, counts = tools.ids([text or "" for text in some.column("text").to_pylist()])
                bounds = np.concatenate([[0], np.cumsum(counts)])
                rows, own_pieces, own_starts, own_lengths, marks = [], [], [], [], []
                for k in range(len(some)):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], end_mark).astype("<u4")
                    for n, at in enumerate(range(0, len(own), length)):
                        part = own[at : at + length]
                        rows.append(k)
                        own_pieces.append(n)
                        own_starts.append(at)
                        own_lengths.append(len(part))
                        marks.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(own_pieces, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (own_starts, own_lengths, marks)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return emit


def pieces(
    docs: DataFrame, path: str | None = None, end_mark: int = END_MARK, length: int = LENGTH
) -> DataFrame:
    """``key, doc_id, piece, start, length, ids_crc32``: the pieces of all documents, stored.

    ``key`` is a number of each piece's own.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        _pieces(path, end_mark, length),
        f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long",
    )
    return stored(found.withColumn("key", F.monotonically_increasing_id()), "pieces")


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Pieces by number in bins: each goes where least room stays, or into a bin of its own."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []  # room and bin, ascending
    for k, length in enumerate(lengths):
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, own = rooms.pop(at)
        else:
            room, own = most, len(bins)
            bins.append([])
        bins[own].append(k)
        if room > length:
            insort(rooms, (room - length, own))
    return bins


class Search:
    """Local search over the bins of a cell; ``bins`` lists the pieces of each by number."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], most: int):
        self.lengths, self.bins, self.most = lengths, bins, most
        self.fills = np.array([lengths[own].sum() for own in bins], np.int64)
        self.bin_of = np.empty(len(lengths), np.int64)
        for k, own in enumerate(bins):
            self.bin_of[own] = k

    def put(self, piece: int, to: int) -> None:
        here, length = self.bin_of[piece], self.lengths[piece]
        self.bins[here].remove(piece)
        self.bins[to].append(piece)
        self.bin_of[piece] = to
        self.fills[here] -= length
        self.fills[to] += length

    def best(self, gains: np.ndarray, to: np.ndarray, giver: int) -> int | None:
        """The place of the step that raises the sum of squares most, if any is allowed."""
        room = self.most - self.fills[to]
        rise = gains * (self.fills[to] - self.fills[giver] + gains)
        rise[(gains <= 0) | (gains > room) | (to == giver)] = 0
        at = int(rise.argmax()) if rise.size else 0
        return at if rise.size and rise.flat[at] > 0 else None

    def step(self, giver: int) -> bool:
        """One improving step that takes from the giver: a move, else an exchange."""
        own = np.array(self.bins[giver])
        sizes = self.lengths[own]
        # Bins with room, and the pieces in them.
        takers = np.flatnonzero((self.fills < self.most) & (self.fills >= self.fills[giver]))
        takers = takers[takers != giver]
        if not len(takers):
            return False
        at = self.best(
            np.repeat(sizes, len(takers)), np.tile(takers, len(own)), giver
        )
        if at is not None:
            self.put(own[at // len(takers)], takers[at % len(takers)])
            return True
        theirs = np.array([piece for k in takers for piece in self.bins[k]])
        bins, others = self.bin_of[theirs], self.lengths[theirs]
        at = self.best((sizes[:, None] - others).ravel(), np.tile(bins, len(own)), giver)
        if at is not None:
            self.exchange([own[at // len(theirs)]], [theirs[at % len(theirs)]])
            return True
        i, j = np.triu_indices(len(own), 1)
        if len(i):
            at = self.best(
                ((sizes[i] + sizes[j])[:, None] - others).ravel(), np.tile(bins, len(i)), giver
            )
            if at is not None:
                k = at // len(theirs)
                self.exchange([own[i[k]], own[j[k]]], [theirs[at % len(theirs)]])
                return True
        for mine, size in zip(own, sizes, strict=True):
            small = theirs[others < size]
            if self.one_for_two(mine, size, small, giver):
                return True
        return False

    def one_for_two(self, mine: int, size: int, small: np.ndarray, giver: int) -> bool:
        """One piece of the giver for two smaller ones that share a bin; ``small`` is in order of bins."""
        bins = self.bin_of[small]
        counts = np.diff(np.append(np.flatnonzero(np.diff(bins, prepend=-1)), len(bins)))
        for apart in range(1, int(counts.max(initial=1))):
            same = np.flatnonzero(bins[apart:] == bins[:-apart])
            first, second = small[same], small[same + apart]
            at = self.best(size - self.lengths[first] - self.lengths[second], bins[same], giver)
            if at is not None:
                self.exchange([mine], [first[at], second[at]])
                return True
        return False

    def exchange(self, mine: list[int], theirs: list[int]) -> None:
        here, there = self.bin_of[mine[0]], self.bin_of[theirs[0]]
        for piece in mine:
            self.put(piece, there)
        for piece in theirs:
            self.put(piece, here)

    def run(self) -> list[list[int]]:
        least = -(-int(self.lengths.sum()) // self.most)
        left = len(self.bins)
        tried = self.fills == self.most
        while left > least and not tried.all():
            fills = np.where(tried, self.most + 1, self.fills)
            giver = int(fills.argmin())
            tried[giver] = True
            room = int((self.most - self.fills)[(self.fills > 0)].sum()) - (self.most - self.fills[giver])
            if room < self.fills[giver]:
                break
            while self.fills[giver] and self.step(giver):
                pass
            left -= not self.fills[giver]
        return [own for own in self.bins if own]


def packed(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Pieces by number in as few bins of ``most`` as best fit and the local search find."""
    return Search(lengths, best_fit(lengths.tolist(), most), most).run()


def _cell(most: int, least_open: int, turn: int):
    """One cell: every piece with its sequence, its place there, and whether the sequence is open."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        lengths = table.column("length").to_numpy()
        cell = table.column("cell")[0].as_py()
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        is_open = np.empty(len(lengths), bool)
        for k, own in enumerate(packed(lengths, most)):
            sizes = lengths[own]
            sequence[own] = turn << 57 | cell << 20 | k
            offset[own] = np.cumsum(sizes) - sizes
            is_open[own] = most - sizes.sum() > least_open
        table = table.drop_columns(["cell"])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("open", is_open)):
            table = table.append_column(name, pa.array(values))
        return table

    return pack


def in_sequences(found: DataFrame, most: int = LENGTH, cell: int = CELL, left_open: float = OPEN) -> DataFrame:
    """Rows with a ``key`` of their own and a ``length`` of at most ``most``, each with its place.

    Adds ``sequence_id`` and ``offset``; the lengths of a sequence's rows add up to ``most`` or less.
    """
    columns = found.columns
    shape = ", ".join(f"`{name}` {kind}" for name, kind in found.dtypes)
    shape += ", sequence_id long, offset long, open boolean"
    n, turn, done = found.count(), 0, None
    while True:
        cells = max(1, round(n / cell))
        dealt = found.withColumn("cell", F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(cells)))
        pack = _cell(most, int(most * left_open), turn)
        result = stored(dealt.groupBy("cell").applyInArrow(pack, shape), "packed")
        left = result.where("open").count() if cells > 1 else 0
        if cells == 1 or not left or left * 2 > n:
            part = result
        else:
            part = result.where("NOT open")
        done = part if done is None else done.unionByName(part)
        if part is result:
            return done.select(*columns, "sequence_id", "offset")
        found, n, turn = result.where("open").select(*columns), left, turn + 1


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    end_mark: int = END_MARK,
    length: int = LENGTH,
    cell: int = CELL,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of ``docs``.

    A null text counts as empty: its one piece is the end mark. Rows keep their ids, null and repeated
    ones too; repeated rows are packed each for itself. Other columns are not read, whatever their
    names. Without rows there are no pieces. ``path`` is a tokenizer that every executor has.
    """
    found = in_sequences(pieces(docs, path, end_mark, length), length, cell)
    return found.drop("key")


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4,096 ids."""
    return pack_documents(read(spark, folder, "documents"))
