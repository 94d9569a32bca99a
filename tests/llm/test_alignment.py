"""Alignment of two tokenizers against plain Python, and the monoid's laws."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SMALL
from test_operators import none, odd  # noqa: F401
from wardline.llm import alignment
from wardline.llm.alignment import Fragment, Tokens, compose, fragment, reduced

ODD = [
    None,
    "",
    " ",
    " \n\n a \n b",
    " a  b",
    "a▁b",
    "a\x00 b",
    "x" * 5_000 + " a  b",
    "слово слово " * 400,
    "日本語テキスト" * 300,
    "<|endoftext|> foo <s> </s> <unk> <0x41>",
    "é á b don't I'm ' s",
    "᠎ a​ b ﻿ c",
    "word " * 3_000,
    "".join(chr(k) for k in range(1, 3_000)),
    " ".join(chr(k) for k in range(33, 3_000)),
]


@pytest.fixture(scope="module")
def tools():
    return alignment.tokenizers(
        alignment.public_tokenizers.path(alignment.A_FILE), alignment.public_tokenizers.path(alignment.B_FILE)
    )


def expected(tools, docs):
    """The contract, text by text, from whole texts."""
    links, rows_known = Counter(), []
    for doc_id, text in docs:
        found = None
        a, b = tools.a.encode(f" {text}", add_special_tokens=False).ids, tools.b.encode(text or "")
        known = b"".join(tools.a_bytes[x] for x in a), b"".join(tools.b_bytes[x] for x in b)
        if text and set(known) == {f" {text}".encode()}:
            a_ends = np.cumsum([len(tools.a_bytes[x]) for x in a]).tolist()
            b_ends = np.cumsum([len(tools.b_bytes[x]) for x in b]).tolist()
            groups, own, i, j = [], Counter(), 0, 0
            for end in sorted(set(a_ends) & set(b_ends)):
                p, q = a_ends.index(end) + 1, b_ends.index(end) + 1
                groups.append(f"{','.join(map(str, a[i:p]))}|{','.join(map(str, b[j:q]))}")
                for x in range(i, p):
                    for y in range(j, q):
                        low = max(a_ends[x] - len(tools.a_bytes[a[x]]), b_ends[y] - len(tools.b_bytes[b[y]]))
                        own[a[x], b[y]] += low < min(a_ends[x], b_ends[y])
                i, j = p, q
            own = +own
            links.update(own)
            found = len(a), len(b), groups, own
        rows_known.append((doc_id, found))
    highest = Counter()
    for (_, b), n in links.items():
        highest[b] = max(highest[b], n)
    rows = []
    for doc_id, found in rows_known:
        if found is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, own = found
        best = sum(n for pair, n in own.items() if links[pair] == highest[pair[1]])
        total = sum(n * links[pair] for pair, n in own.items())
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((doc_id, n_a, n_b, len(groups), own.total(), best, total, digest))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize(
    "options", [{}, {"size": 40, "span": 1_500, "giant": 300}, {"span": 4_000, "most_pairs": 0}]
)
def test_as_from_whole_texts(spark, tools, options):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    docs += [(10_000 + k, text) for k, text in enumerate(ODD)] + [(None, "again"), (None, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows_of(alignment.alignment(df, **options)) == expected(tools, docs)


def test_odd_rows_and_none(spark, tools, odd, none):  # noqa: F811
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    clashing = odd.selectExpr("*", "1 AS row", "2 AS span", "'x' AS pairs", "n_chars AS pair", "3 AS summed")
    assert rows_of(alignment.alignment(clashing)) == expected(tools, docs)
    assert alignment.alignment(none).count() == 0


def test_ids_of_units_put_together_are_the_ids_of_the_text(tools):
    for text in filter(None, ODD):
        units = tools.units(text)
        assert " ".join(units) == text
        numbers = tools.known.numbers(units)
        (a, _), (b, _) = (tools.known.of(numbers, table) for table in (0, 1))
        assert a.tolist() == tools.a.encode(" " + text, add_special_tokens=False).ids
        assert b.tolist() == tools.b.encode(text)


latin = st.text(st.characters(max_codepoint=0x250, exclude_categories=["Cc"]), max_size=40)


@settings(max_examples=300, deadline=None)
@given(latin)
def test_plain_units_have_the_ids_of_the_file(text):
    paths = [alignment.public_tokenizers.path(name) for name in (alignment.A_FILE, alignment.B_FILE)]
    tools = alignment.tokenizers(*paths)
    assert tools.quick.encode_ordinary(text) == tools.a.encode(text, add_special_tokens=False).ids


def as_value(part: Fragment):
    sides = [[x.tolist() for x in (t.a, t.a_ends, t.b, t.b_ends)] for t in (part.head, part.tail)]
    links = np.sort(np.concatenate([np.zeros(0, np.int64), *part.links])).tolist()
    return part.cut, sides, part.n_groups, part.n_a, part.n_b, b"".join(part.text), links


lengths = st.lists(st.integers(1, 4), min_size=1, max_size=30)


@settings(max_examples=200, deadline=None)
@given(lengths, lengths, st.lists(st.integers(0, 60), max_size=6), st.randoms())
def test_fragments_are_a_monoid(a_lengths, b_lengths, edges, random):
    a_ends, b_ends = np.cumsum(a_lengths), np.cumsum(b_lengths)
    end = max(a_ends[-1], b_ends[-1])
    a_ends, b_ends = (np.union1d(x, [end]) for x in (a_ends, b_ends))
    a, b = np.arange(len(a_ends)) + 100, np.arange(len(b_ends)) + 900
    a_starts, b_starts = (np.concatenate([[0], x[:-1]]) for x in (a_ends, b_ends))
    edges = [0, *sorted(edges), int(end) + 1]
    parts = []
    for low, high in zip(edges, edges[1:], strict=False):
        i, j = np.searchsorted(a_starts, [low, high])
        k, m = np.searchsorted(b_starts, [low, high])
        parts.append(fragment(Tokens(a[i:j], a_ends[i:j], b[k:m], b_ends[k:m])))
    whole = as_value(fragment(Tokens(a, a_ends, b, b_ends)))
    assert as_value(reduced(list(parts))) == whole
    # Any order of composing neighbours, with neutral elements between them.
    parts = [x for part in parts for x in (part, Fragment())]
    while len(parts) > 1:
        at = random.randrange(len(parts) - 1)
        parts[at : at + 2] = [compose(parts[at], parts[at + 1])]
    assert as_value(parts[0]) == whole
