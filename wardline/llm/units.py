"""Token ids of texts that are put together from units encoded once, and a quick encoder of units.

A unit is a part of a text that a tokenizer encodes alike wherever it stands, such as a word with the
space before it. Words repeat, so most units of a batch are known already: a text becomes an array of
unit numbers, and its ids are gathered from one table.

The merges of a BPE file whose ids are in the order of its merges are ranks, so the units that are new
can be encoded by ranks, all in one call. That is done for plain units, of Latin letters and other
characters below U+0180, whose classes are the same in every version of Unicode; the file's
own tokenizer encodes the others.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import tiktoken

MOST_IDS = 4 << 20
NOT_PLAIN = re.compile("[^\t-\r -~\xa0-\u017f]")


def gathered(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of all ranges that begin at ``starts`` and are ``counts`` long, in order."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def flat(lists: list[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All elements of some lists, and how many each has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


Encoded = list[tuple[np.ndarray, np.ndarray]]


class Units:
    """The units met so far, each with a list of ids in each of some tables.

    ``encode`` turns units into one ``(ids, counts)`` a table. What is kept is bounded: beyond ``most`` ids
    everything is forgotten before the next batch.
    """

    def __init__(self, encode: Callable[[list[str]], Encoded], tables: int = 1, most: int = MOST_IDS):
        self.encode, self.tables, self.most = encode, tables, most
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.known: dict[str, int] = {}
        self.ids, self.counts = [none] * self.tables, [none] * self.tables
        self.starts = [none] * self.tables

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each unit; new ones are encoded together."""
        if max(map(len, self.ids)) > self.most:
            self.forget()
        new = list(set(units).difference(self.known))
        if new:
            first = len(self.known)
            for k, (ids, counts) in enumerate(self.encode(new)):
                self.starts[k] = np.concatenate(
                    [self.starts[k], len(self.ids[k]) + np.cumsum(counts) - counts]
                )
                self.ids[k] = np.concatenate([self.ids[k], ids])
                self.counts[k] = np.concatenate([self.counts[k], counts])
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def of(self, numbers: np.ndarray, table: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these units one after the other, and how many each has."""
        counts = self.counts[table][numbers]
        return self.ids[table][gathered(self.starts[table][numbers], counts)], counts


def byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ranks(path: str, pattern: str, suffix: str = "", mark: bytes = b"") -> tiktoken.Encoding | None:
    """The merges of a byte-level BPE file as ranks; ``None`` if its ids are not in their order.

    ``suffix`` is what the file's tokens have at the end of a word, and ``mark`` the byte that stands for it.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, letters = model["vocab"], byte_letters()
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    at = [vocabulary[token] for token in made]
    if at != list(range(at[0], at[0] + len(at))) or len(set(made)) != len(made):
        return None
    found = {}
    for token, own in vocabulary.items():
        ending = suffix and token.endswith(suffix)
        core = token[: -len(suffix)] if ending else token
        if all(c in letters for c in core) and own < at[0] + len(at):
            found[bytes(map(letters.get, core)) + (mark if ending else b"")] = own
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=found, special_tokens={})
