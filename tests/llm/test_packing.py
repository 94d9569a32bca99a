"""Packing: whole pieces, gapless sequences, and how few of them there are."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SMALL
from test_operators import none, odd  # noqa: F401
from wardline.llm import packing

TEXTS = [
    None,
    "",
    "x<|endoftext|>y <|startoftext|>",
    " á ́b  ΟΔΟΣ ΟΔΟΣ. İ ǅ \n\t ﬁ",
    "it's i'm ' s 's",
    "a b c d᠎e",
    "".join(chr(k) for k in range(1, 3_000)),
    " ".join(chr(k) for k in range(33, 3_000)),
    "word " * 9_000,
]


def sequences(rows):
    found = {}
    for row in rows:
        found.setdefault(row.sequence_id, []).append((row.offset, row.length))
    return found


def check_places(rows, most):
    for own in sequences(rows).values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= most


def test_pieces_are_those_of_whole_texts(spark):
    tokenizer = Tokenizer.from_file(packing.public_tokenizers.path(packing.TOKENIZER))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    docs += [(10_000 + k, text) for k, text in enumerate(TEXTS)]
    expected = set()
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4_096)):
            part = ids[at : at + 4_096]
            expected.add((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)
    check_places(rows, 4_096)


latin = st.text(st.characters(max_codepoint=0x250, exclude_categories=["Cc"]), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(latin, st.sampled_from([t for t in TEXTS if t])), max_size=4))
def test_ids_are_those_of_the_tokenizer(texts):
    tools = packing.words(packing.public_tokenizers.path(packing.TOKENIZER))
    ids, counts = tools.ids(texts)
    expected = [tools.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert counts.tolist() == [len(own) for own in expected]
    assert ids.tolist() == [x for own in expected for x in own]


def test_odd_rows_and_none(odd, none):  # noqa: F811
    clashing = odd.selectExpr("*", "1 AS piece", "2 AS cell", "3 AS open", "4 AS sequence_id")
    rows = packing.pack_documents(clashing).collect()
    assert sorted({r.doc_id for r in rows}, key=repr) == sorted({r.doc_id for r in odd.collect()}, key=repr)
    assert sum(r.doc_id == 2 for r in rows) == 2 and sum(r.doc_id == 3 for r in rows) == 1
    check_places(rows, 4_096)
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("cell", [40, 4_096])
def test_few_sequences(spark, cell):
    rows = packing.pack_documents(spark.read.parquet(f"{SMALL}/documents.parquet"), cell=cell).collect()
    check_places(rows, 4_096)
    least = -(-sum(r.length for r in rows) // 4_096)
    assert len(sequences(rows)) <= least + 1


def test_the_search_empties_bins_that_best_fit_leaves():
    rng = np.random.default_rng(5)
    for low, high in ((1, 4_096), (900, 1_800), (300, 2_400)):
        lengths = rng.integers(low, high, 1_500)
        start = packing.best_fit(lengths.tolist(), 4_096)
        search = packing.Search(lengths, [list(own) for own in start], 4_096)
        before = (search.fills**2).sum()
        found = search.run()
        assert sorted(k for own in found for k in own) == list(range(len(lengths)))
        assert all(lengths[own].sum() <= 4_096 for own in found)
        assert len(found) < len(start) and (search.fills**2).sum() > before


@pytest.mark.parametrize(
    ("bins", "kept"),
    [
        ([[6], [4]], [[6, 4]]),  # a move
        ([[5, 3], [4, 4], [2, 1]], None),  # one for one
        ([[4, 5], [3, 2]], None),
        ([[9], [2, 2]], None),
    ],
)
def test_every_step_raises_the_sum_of_squares(bins, kept):
    lengths = np.array([x for own in bins for x in own])
    numbers = iter(range(len(lengths)))
    search = packing.Search(lengths, [[next(numbers) for _ in own] for own in bins], 10)
    giver = int(search.fills.argmin())
    before = (search.fills**2).sum()
    while search.fills[giver] and search.step(giver):
        assert (search.fills**2).sum() > before and search.fills.max() <= 10
        before = (search.fills**2).sum()
    if kept:
        assert [sorted(lengths[own].tolist(), reverse=True) for own in search.run()] == kept


@pytest.mark.parametrize(
    ("lengths", "bins"), [([3, 3, 5, 4], [[0, 1], [2, 3]]), ([6, 2, 3, 3], [[0], [1, 2, 3]])]
)
def test_two_for_one_and_one_for_two(lengths, bins):
    most = sum(lengths[k] for k in bins[1]) + 1
    sizes = [len(own) for own in bins]
    search = packing.Search(np.array(lengths), bins, most)
    before = search.fills.copy()
    assert search.step(0) and (search.fills - before).tolist() == [-1, 1]
    assert [len(own) for own in search.bins] != sizes


def test_rows_of_any_kind_in_sequences(spark):
    rows = spark.range(3_000).select(
        F.col("id").alias("key"), (F.col("id") * 37 % 100 + 1).alias("length"), F.lit("x").alias("cell_")
    )
    found = packing.in_sequences(rows, most=250, cell=200).collect()
    assert len(found) == 3_000
    check_places(found, 250)
