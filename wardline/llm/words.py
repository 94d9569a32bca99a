"""Words of a text column as numpy arrays, hashed straight from the Arrow buffer.

Texts are taken in pieces of about ``PIECE`` bytes, and a longer text in blocks that end at a
separator, so that memory does not depend on the number of rows of a batch. Every hash is a
polynomial in an odd multiplier modulo 2**64 whose coefficients and result are mixed; since the
multiplier can be inverted, the hash of any range follows from two running sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 1 << 18

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32
# Everything in ASCII but letters and digits parts words; bytes of longer characters do not.
SYMBOLS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U)) | U(1)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64; short tables are kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE + 1), base, U)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 2 * PIECE:
            _POWERS[base] = known
    return known[:n]


class Ranges:
    """Hashes of ranges of a sequence of 64-bit integers."""

    def __init__(self, values: np.ndarray, multiplier: int):
        self.back = powers(pow(multiplier, -1, 1 << 64), len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * powers(multiplier, len(values)), out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


@dataclass
class Piece:
    """Rows ``first`` to ``first + len(counts)`` of a batch, their words in order.

    ``prefixes`` has a line for each wanted prefix length, with the hash of every word's first
    bytes, or of the whole word if that is shorter.
    """

    first: int
    counts: np.ndarray
    hashes: np.ndarray
    prefixes: np.ndarray | None = None

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


def slices(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes; a longer row is alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _blocks(data: np.ndarray, parting: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes that end behind a separator."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data):
            last = np.flatnonzero(parting[data[max(at, end - PIECE) : end]])
            if len(last):
                end = max(at, end - PIECE) + int(last[-1]) + 1
                break
            end += PIECE
        end = min(end, len(data))
        yield at, end
        at = end


def _hashed(data, offsets, parting, fold, prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, hashes and prefix hashes of the words of ``data``; no word goes beyond a row."""
    inside = ~parting[data]
    starts, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    starts[1:-1] = inside[1:] & ~inside[:-1]
    ends[1:-1] = inside[:-1] & ~inside[1:]
    heads = offsets[offsets < len(data)]
    starts[heads[inside[heads]]] = True
    heads = offsets[offsets > 0]
    ends[heads[inside[heads - 1]]] = True
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends)
    coded = Ranges(_BYTES[fold[data]], MULTIPLIERS[0])
    short = [coded.hashes(begin, np.minimum(end, begin + n)) for n in prefixes]
    return begin, coded.hashes(begin, end), np.array(short, U).reshape(len(prefixes), len(begin))


def pieces(column: pa.Array, parting=WHITE, fold=SAME, prefixes=()) -> Iterator[Piece]:
    """The words of every row of a column, piece by piece."""
    data, offsets = text_buffer(column)
    for first, last in slices(offsets):
        own = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        if not len(part):
            none = np.zeros((len(prefixes), 0), U)
            yield Piece(first, np.zeros(last - first, np.int64), np.zeros(0, U), none)
        elif len(part) <= PIECE:
            begin, hashes, short = _hashed(part, own, parting, fold, prefixes)
            yield Piece(first, np.diff(np.searchsorted(begin, own)), hashes, short)
        else:
            each = [
                _hashed(part[a:b], np.array([0, b - a]), parting, fold, prefixes)
                for a, b in _blocks(part, parting)
            ]
            hashes = np.concatenate([h for _, h, _ in each])
            short = np.concatenate([s for *_, s in each], axis=1)
            yield Piece(first, np.array([len(hashes)]), hashes, short)


def windows(piece: Piece, length: int) -> np.ndarray:
    """Starts of all runs of ``length`` words that stay in one row."""
    ends = np.repeat(piece.bounds[1:], piece.counts)
    at = np.arange(len(piece.hashes))
    return at[at + length <= ends]


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs."""
    return x.view(np.int64)
