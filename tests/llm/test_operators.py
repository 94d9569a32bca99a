"""The operators on odd rows, on none, and against brute force."""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from wardline.llm import (
    byte_bpe,
    embedding_dedup,
    fingerprints,
    language_id,
    minhash_dedup,
    mixing,
    quality,
    sharding,
    substring_dedup,
    toxicity,
)
from wardline.llm.common import sieve, without
from wardline.llm.components import components
from wardline.llm.queries import ORACLE, QUERIES

@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns with names the operators use."""
    copy = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, copy, "en", "a", 1, 9, "x"),
        (2, copy + " tail", "en", "a", 2, 9, "x"),
        (2, copy + " tail", "en", "a", 2, 9, "x"),
        (3, None, None, None, None, None, None),
        (4, "", "de", "b/c", 0, 9, "x"),
        (5, " \t\n", "de", "b/c", 3, 9, "x"),
        (6, "word " * 4000, "de", "b", 9, 9, "x"),
        (7, "x" * 40000, None, "b", 9, 9, "x"),
        (None, copy, "en", None, 9, 9, "x"),
        (8, "zwei Wörter", "de", "b", 9, 9, "x"),
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, size long, key string"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def none(odd):
    return odd.where("false")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_repeats_of_odd_rows(odd, none):
    found = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(odd).collect()}
    assert (1, 60, 0) in found and (2, 61, 60) in found and (None, 60, 60) in found
    assert (3, 0, 0) in found and (4, 0, 0) in found and (6, 4000, 3981 + 18) in found
    assert substring_dedup.remove_repeats(odd).count() == odd.count()
    assert substring_dedup.remove_repeats(none).count() == 0
    assert substring_dedup.without_repeats(odd).columns == odd.columns


@pytest.mark.parametrize("ids", ["own", "shared", "none", "mixed"])
def test_repeats_of_rows_that_share_an_id(spark, ids):
    """Against plain Python: rows of one id are one document, and each keeps its own text."""
    draw = random.Random(7)
    shared = [[f"p{k}w{i}" for i in range(draw.randint(22, 60))] for k in range(6)]
    texts = []
    for k in range(60):
        parts = [draw.choice(shared) if draw.random() < 0.5 else [f"r{k}x{i}" for i in range(15)] for _ in range(4)]
        texts.append(" ".join(w for part in parts for w in part))
    texts += texts[:5]
    pick = {
        "own": lambda k: k,
        "shared": lambda k: k // 20,
        "none": lambda k: None,
        "mixed": lambda k: None if k % 3 == 0 else k // 2,
    }[ids]
    rows = [(pick(k), text) for k, text in enumerate(texts)]
    first = {}
    for doc_id, text in rows:
        own = text.split()
        for i in range(len(own) - 19):
            place = (doc_id is None, doc_id or 0)
            key = tuple(own[i : i + 20])
            first[key] = min(first.get(key, place), place)
    expected = []
    for doc_id, text in rows:
        own, seen, gone = text.split(), set(), set()
        for i in range(len(own) - 19):
            key = tuple(own[i : i + 20])
            if key in seen or first[key] != (doc_id is None, doc_id or 0):
                gone.update(range(i, i + 20))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        expected.append((str(doc_id), len(own), len(gone), kept))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substring_dedup.remove_repeats(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(expected)


def test_near_duplicates_of_odd_rows(odd, none):
    found = {r.doc_id: r for r in minhash_dedup.near_duplicates(odd).collect()}
    assert found[2].component_id == 1 and found[None].component_id == 1
    assert found[3].kept and found[3].n_shingles == 0 and found[6].n_shingles == 1
    assert found[8].component_id == 8
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_of_the_stage_share_80_percent_of_runs_of_five_words(spark):
    long, short = [f"w{i}" for i in range(500)], [f"v{i}" for i in range(80)]
    texts = [
        long, long + [f"t{i}" for i in range(100)],  # 0.833 of the runs of three, 0.832 of five
        short, short[:20] + ["x"] + short[21:50] + ["y"] + short[51:],  # 0.857 and 0.767
    ]
    rows = [(k, " ".join(words)) for k, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    contract = minhash_dedup.near_duplicates(docs, length=3, percent=85)
    assert sorted(r.doc_id for r in contract.where("kept").collect()) == [0, 1, 2]


def test_likelihood_follows_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 2**63, 4000).astype(np.uint64)
    for shared in (0.5, 0.85, 0.95):
        n = 1000
        k = int(2 * n * shared / (1 + shared))
        sets = np.sort(pool[:n]), np.sort(np.concatenate([pool[:k], pool[n : 2 * n - k]]))
        rows = np.repeat([0, 1], [n, n])
        x, y = minhash_dedup.registers(rows, np.concatenate(sets), 2)
        j = minhash_dedup.similarity(
            np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([n]), np.array([n])
        )
        assert abs(j[0] - k / (2 * n - k)) < 0.2


def test_fingerprints_of_odd_rows(odd, none):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[None].fingerprint
    assert by[3].fingerprint == by[4].fingerprint == "" and by[3].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.fingerprints(none).count() == 0


def test_fingerprints_estimate_weighted_similarity(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts)
    errors = []
    for r in fingerprints.fingerprints(docs).collect():
        own, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(own) // 2
        a, b = Counter(words(own)), Counter(words(own[: len(own) - half] + after[:half]))
        errors.append(r.near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.16


def test_fingerprints_do_not_depend_on_ranges(spark, odd, monkeypatch):
    """Among the ids are the largest and the smallest numbers, which no limit of a range may overflow."""
    ends = [(n, f"end {n}") for n in (2**63 - 1, 2**63 - 2, -(2**63), 1 - 2**63)]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 40").select("doc_id", "text")
    docs = docs.union(odd.select("doc_id", "text")).union(spark.createDataFrame(ends, docs.schema))
    whole = sorted((tuple(r) for r in fingerprints.fingerprints(docs).collect()), key=repr)
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 1)
    parts = fingerprints.in_ranges(docs)[0].agg(F.countDistinct("part")).first()[0]
    assert parts > 40
    assert sorted((tuple(r) for r in fingerprints.fingerprints(docs).collect()), key=repr) == whole


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 100])
def test_limits_below_a_number(spark, n):
    cuts = sorted(random.Random(n).sample(range(-300, 300), n))
    ids = spark.range(-310, 310).select("id", fingerprints.below([float(c) for c in cuts], F.col("id")))
    assert all(found == bisect.bisect_right(cuts, value) for value, found in ids.collect())
    nothing = ids.select(fingerprints.below([float(c) for c in cuts], F.lit(None).cast("long")))
    assert nothing.first()[0] == 0


def test_ranges_do_not_multiply_what_the_driver_plans(spark, tmp_path, monkeypatch):
    """Spark writes out what a range is made of, down to the files, and that may not grow as a power."""
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 1)
    pruning = spark._jvm.org.apache.spark.sql.execution.dynamicpruning
    pruning = getattr(getattr(pruning, "PartitionPruning$"), "MODULE$")

    def written_out(n):
        spark.range(n).selectExpr("id AS doc_id", "'a b' AS text").write.parquet(f"{tmp_path}/{n}")
        rows = fingerprints.in_ranges(spark.read.parquet(f"{tmp_path}/{n}"))[0]
        plan = rows._jdf.queryExecution().optimizedPlan()
        part = plan.output().apply(rows.columns.index("part"))
        return len(pruning.findExpressionAndTrackLineageDown(part, plan).get()._1().toString())

    assert written_out(128) < 10 * written_out(16)


def test_mixing_odd_rows(odd, none):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == odd.count()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target)
        assert all(0 <= r.taken <= 3 * r["size"] for r in own)
    assert sum(r.taken for r in rows) >= sum(r["size"] for r in rows) - 5
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(odd).columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_the_mix_has_the_words_it_promises(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mixed = mixing.mix_sources(docs)
    taken = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    real = Counter()
    for r in mixing.repeated(mixed, docs.columns).collect():
        real[r.source] += len(words(r.text))
    assert real == taken


def test_languages(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs.where("doc_id % 3 > 0"))
    assert (model.weights == 0).mean() > 0.5
    held = docs.where("doc_id % 3 = 0").select("doc_id", "text", "lang")
    said = language_id.predict(held, model).join(held.select("doc_id", "lang"), "doc_id")
    assert said.where("lang_pred = lang").count() >= 0.9 * said.count()
    by = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert by[3].lang_pred == by[4].lang_pred == by[5].lang_pred == "und" and by[3].score == 0
    assert language_id.fit(none).languages == []
    assert language_id.predict(none, model).count() == 0


def test_toxicity(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    languages = language_id.fit(docs.where("doc_id % 3 > 0"))
    net = toxicity.fit(docs, labels.where("doc_id % 3 > 0"), languages)
    held = labels.where("doc_id % 3 = 0")
    scored = toxicity.scores(docs, net, languages).join(held, "doc_id")
    right = scored.where("(score >= 0.5) = (toxic = 1)").count()
    assert right >= 0.95 * scored.count() > 0
    assert all(0 <= r.score <= 1 for r in toxicity.scores(odd, net, languages).collect())
    assert toxicity.scores(none, net, languages).count() == 0
    empty = toxicity.fit(docs, labels.where("false"), languages)
    assert toxicity.scores(odd, empty, languages).where("score >= 0.5").count() == 0


def test_texts_to_learn_from_are_bounded_in_bytes(spark):
    rows = [(k, "x" * (10 + k % 7)) for k in range(200)] + [(900, "y" * 5_000), (901, None), (902, ""), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = sorted({k for k, _ in rows})
    chosen = spark.createDataFrame([(k, k % 2, -k) for k in ids], "doc_id long, toxic int, order long")
    size = Counter()
    for k, text in rows:
        size[k] += len(text or "")
    for most in (160, 1_600, 10**6):
        expected = set()
        for label in (0, 1):
            held = 0
            for k in sorted((k for k in ids if k % 2 == label and size[k] <= most // 16), reverse=True):
                held += size[k]
                if held <= most:
                    expected.add(k)
        found = toxicity.bounded_bytes(docs, chosen, most)
        assert found.columns == chosen.columns
        assert {r.doc_id for r in found.collect()} == expected
    assert toxicity.bounded_bytes(docs.where("false"), chosen).count() == 0


def test_embeddings_of_odd_rows(spark):
    nan = float("nan")
    rows = [
        (5, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [1.0, 0.01]), (1, None), (3, []), (4, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [None, 1.0]), (8, [0.0, 1.0]), (8, [0.0, 1.0]), (None, [0.0, -1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=repr)
    assert (2, 2, 2, True) in found and (5, 2, 2, False) in found and (9, 2, 2, False) in found
    assert found.count((8, 1, 8, True)) == 2 and (None, 0, None, True) in found
    assert all((k, 0, k, True) in found for k in (1, 3, 4, 6, 7))
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def around(mean, n, dims=64, seed=5):
    """Random unit vectors with a shared direction, and a copy of each at cosine 0.951."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) + mean * np.eye(dims)[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    return x, 0.951 * x + np.sqrt(1 - 0.951**2) * u / np.linalg.norm(u, axis=1, keepdims=True)


@pytest.mark.parametrize("mean", [0.0, 1.0, 1.5, 2.0])
def test_planted_links_meet_with_and_without_a_common_mean(mean):
    model, limit = embedding_dedup.fit(around(mean, 4000)[0], 0.95)
    differ = np.bitwise_xor(*[embedding_dedup.encode(x, model) for x in around(mean, 3000, seed=6)])
    meet = np.bitwise_count(differ.view(np.uint16)).min(axis=1) <= 1
    assert (meet & (np.bitwise_count(differ).sum(axis=1, dtype=int) <= limit)).mean() >= 0.997


@pytest.mark.parametrize("width", [16, 18, 21, 24])
def test_planted_links_meet_in_longer_substrings(width):
    model, limit = embedding_dedup.fit(around(0.3, 4000)[0], 0.95, width)
    differ = np.bitwise_xor(*[embedding_dedup.encode(x, model) for x in around(0.3, 3000, seed=6)])
    bits = model[0][1].shape[1]
    parts = [p for word in differ.T for p in embedding_dedup.substrings(word, bits, width)]
    assert len(parts) == len(model) * (64 // width)
    meet = np.min([np.bitwise_count(p) for p in parts], axis=0) <= 1
    assert (meet & (np.bitwise_count(differ).sum(axis=1, dtype=int) <= limit)).mean() >= 0.997


def test_substrings_grow_with_the_number_of_vectors():
    assert embedding_dedup.widths(500) == [16] and embedding_dedup.widths(1 << 24) == [16, 19, 22, 25]
    sample, chosen = around(0.3, 4000)[0], []
    assert embedding_dedup.fit(sample, 0.95, 32) is None
    for n in (1 << 16, 1 << 20, 1 << 24, 1 << 33):
        fits = {w: f for w in embedding_dedup.widths(n) if (f := embedding_dedup.fit(sample, 0.95, w))}
        chosen.append(min(fits, key=lambda w: embedding_dedup.work(fits[w][0], w, n)))
        assert n / 2 ** chosen[-1] <= 512
    assert chosen == sorted(chosen) and chosen[-1] > chosen[0]


@pytest.mark.parametrize("width", [None, 21, 24])
def test_thousands_of_links_against_brute_force(spark, width):
    """Pairs, clusters around one vector and equal vectors, of 6,000 vectors in all."""
    pairs = np.concatenate(around(0.5, 2000))
    rng = np.random.default_rng(9)
    middle = rng.normal(size=(20, 1, 64))
    near = (middle + 0.18 * rng.normal(size=(20, 90, 64))).reshape(-1, 64)
    x = np.concatenate([pairs, near, pairs[:200]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = embedding_dedup.near_duplicates(df, width=width).collect()
    close = x @ x.T >= 0.95
    label = np.arange(len(x))
    while True:
        lower = np.array([label[row].min() for row in close])
        if (lower == label).all():
            break
        label = lower
    links = close.sum(axis=1) - 1
    assert links.sum() > 20_000
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == set(
        zip(range(len(x)), links.tolist(), label.tolist(), strict=True)
    )


def test_vectors_of_every_length_link_among_themselves(spark):
    sets = [around(0.0, 40, dims=8), around(0.0, 20, dims=12), around(0.5, 540, dims=64), around(0.5, 520, dims=48)]
    sets = [np.concatenate(pair) for pair in sets]
    x = [v for own in sets for v in own]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    links = [n for own in sets for n in (own @ own.T >= 0.95).sum(axis=1) - 1]
    assert [found[k] for k in range(len(x))] == links


def test_links_of_vectors_with_a_strong_common_mean(spark):
    x = np.concatenate(around(3.0, 700))
    assert embedding_dedup.fit(x, 0.95) is None
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert links.sum() >= 1400 and [found[k] for k in range(len(x))] == links.tolist()


def test_chunks_do_not_change_ids(spark):
    texts = ["x" * 5000, "a b" * 3000, "12 " * 2000 + "don't  \n\n won't!!!'sabc" * 300, None, "", "!" * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoding = byte_bpe.tokenizer(byte_bpe.public_tokenizers.path(byte_bpe.RANKS))
    tokens = byte_bpe.encode(df, chunk=300, overlap=40)
    assert {r.doc_id: list(r.ids) for r in tokens.collect()} == {
        k: encoding.encode_ordinary(t or "") for k, t in enumerate(texts)
    }
    raw = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(tokens).collect()}
    assert raw == {k: (t or "").encode() for k, t in enumerate(texts)}


@pytest.mark.parametrize("size, overlap", [(20, 5), (64, 16), (byte_bpe.PART, byte_bpe.PART_OVERLAP)])
def test_pieces_of_a_text_have_the_ids_of_the_whole(spark, size, overlap):
    encoding = byte_bpe.tokenizer(byte_bpe.public_tokenizers.path(byte_bpe.RANKS))
    pattern = byte_bpe.regex.compile(byte_bpe.public_tokenizers.PATTERN)
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["日本語の文章、" * 400, "x" * 5000, " \n\t " * 900, "a1b22c333 " * 500, "don't  stop!!\r\n" * 300, "é́" * 2000]
    cuts = 0
    for text in texts:
        cuts += len(byte_bpe.meetings(text or "", size, overlap, pattern))
        ids = byte_bpe.encoded_pieces(text or "", encoding, pattern, size, overlap)
        assert ids == encoding.encode_ordinary(text or "")
    assert cuts > 100


def test_digests_are_those_of_the_tokenizer(spark):
    encoding = byte_bpe.tokenizer(byte_bpe.public_tokenizers.path(byte_bpe.RANKS))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "z" * 40_000)], docs.schema))
    expected = set()
    for doc_id, text in docs.collect():
        ids, raw = encoding.encode_ordinary(text or ""), (text or "").encode()
        listed = ",".join(map(str, ids)).encode()
        expected.add((doc_id, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(raw).hexdigest()))
    assert {tuple(r) for r in byte_bpe.digests(docs).collect()} == expected


def test_bytes_of_odd_rows(odd, none):
    assert byte_bpe.digests(odd).count() == odd.count()
    assert byte_bpe.digests(none).count() == 0


def test_a_short_text_is_encoded_and_digested_by_one_worker(spark):
    """A second worker after the first would hold ids and an encoder once more."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = byte_bpe.digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert 0 <= plan.index("Union") < plan.index("MapInArrow")


def test_quality(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    model = quality.fit(docs, labels.where("doc_id % 3 > 0"))
    scored = quality.classify(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id")
    assert scored.where("(quality_score >= 0.5) = (quality = 1)").count() >= 0.97 * scored.count()
    assert quality.classify(odd, model).count() == odd.count()
    assert quality.classify(none, model).count() == 0
    assert quality.fit(docs, labels.where("false")).base == 0.5


def test_hosts_and_paths_of_slash_and_url_sources(spark):
    sites = {
        "a/b/c": ("a", "b/c"), "a/b/d": ("a", "b/d"), "web": ("web", ""), "": ("", ""), None: ("\0", ""),
        "http://a.com/x": ("a.com", "x"), "HTTPS://a.com/x/y": ("a.com", "x/y"), "s3a://b": ("b", ""),
    }
    docs = spark.createDataFrame([(s,) for s in sites], "source string")
    assert {r.source: (r._host, r._path) for r in quality.with_sites(docs).collect()} == sites
    rows = [("http://good.org/x", 6.0)] * 200 + [("http://bad.org/x/p", -6.0)] * 200 + [("http://bad.org/x/q", 6.0)] * 100
    evidence = quality.with_sites(spark.createDataFrame(rows, "source string, log_odds double"))
    prior = {(r._host, r._path): r.prior for r in quality.site_priors(evidence, 0.5).collect()}
    assert prior["good.org", "x"] > 0.9 > 0.1 > prior["bad.org", "x/p"] and prior["bad.org", "x/q"] > 0.5


def test_sites_shrink_to_the_rate_above(spark):
    rows = [("big", "", 6.0)] * 400 + [("bad", "", -6.0)] * 400 + [("tiny", "", -6.0)]
    evidence = spark.createDataFrame(rows, "_host string, _path string, log_odds double")
    prior = {r._host: r.prior for r in quality.site_priors(evidence, 0.5).collect()}
    assert prior["big"] > 0.9 > prior["tiny"] > prior["bad"]


def test_shards(spark, odd, none, tmp_path):
    rows = sharding.shard_documents(odd, f"file://{tmp_path}/a", 3).collect()
    assert len(rows) == odd.count()
    for shard in range(3):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    assert sharding.shard_documents(none, f"file://{tmp_path}/b", 3).count() == 0
    with pytest.raises(Exception, match="exist"):
        sharding.write_map(spark, f"file://{tmp_path}/a", 1, {0: 0})


def test_documents_are_placed_by_the_edited_map(spark, tmp_path):
    """Sizes, checksums, places and bytes of the shards against plain Python, over three versions."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    folder = f"file://{tmp_path}/maps"
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    maps, loads = {}, {}
    for version, shards in ((None, 8), (2, 10)):
        rows = sharding.shard_documents(docs, folder, shards, version).collect()
        last = 2 if version is None else version + 1
        maps[last] = {r.slot: r.shard for r in sharding.read_map(spark, folder, last).collect()}
        assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
            k: (len(t) + 16, zlib.crc32(t)) for k, t in texts.items()
        }
        assert all(maps[last][r.virtual_slot] == r.shard for r in rows)
        loads[last] = [sum(r.size for r in rows if r.shard == k) for k in range(shards)]
        # No shard is further from the mean than what holds no slot that could move.
        assert max(loads[last]) - min(loads[last]) <= 0.1 * sum(loads[last]) / shards
        for k in range(shards):
            own = sorted(r.slot for r in rows if r.shard == k)
            assert own == list(range(len(own)))
    maps[1] = {r.slot: r.shard for r in sharding.read_map(spark, folder, 1).collect()}
    assert maps[1] == {slot: slot % 8 for slot in range(sharding.SLOTS)}
    used = {r.virtual_slot for r in sharding.with_slots(docs).collect()}
    for old, new in ((1, 2), (2, 3)):
        moved = {slot for slot in maps[old] if maps[old][slot] != maps[new][slot]}
        assert moved and moved <= used and len(moved) < len(used)


def test_a_shard_that_cannot_give_does_not_stop_the_others():
    sizes = {0: (1000, 1), **{slot: (10, 1) for slot in range(1, 40)}}
    chosen = sharding.rebalance({0: 0, **dict.fromkeys(range(1, 40), 1)}, sizes, 4)
    held = Counter(chosen.values())
    assert held == {0: 1, 1: 13, 2: 13, 3: 13}


def test_an_edited_map_moves_slots_to_the_new_shard_only():
    sizes = {slot: (100 + slot % 7, 1) for slot in range(4096)}
    before = sharding.first_map(sizes, 40)
    after = sharding.rebalance(before, sizes, 41)
    moved = {slot for slot in before if before[slot] != after[slot]}
    assert {after[slot] for slot in moved} == {40} and 80 <= len(moved) <= 120


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 101), (None, 3)]
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


CLASHES = """_row _none _host _path prior top log_odds _prior_host _prior_path host quality_score _order _bucket
 _whole _extra _before _edge _s _source _more words weight most size source_size target taken _turn own_0 own_1 own_5
 id repeated first open late mark run context n_words n_removed kept_text kept_id dropped suspected row
 component_id kept n_shingles rid part cut piece""".split()


def clashing(odd):
    """Rows with a column for every name the operators use themselves, and their values by row."""
    kept = odd.select("doc_id", "text", "lang", "source", "n_chars")
    return kept.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHES])


def own_values(df, but=()):
    names = [c for c in CLASHES if c not in but]
    return {tuple(r) for r in df.select(*names).collect()} <= {tuple(f"mine {c}" for c in names)}


def test_columns_with_the_names_of_the_operators_own(spark, odd):
    df = clashing(odd)
    model = quality.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    judged = quality.classify(df, model)
    assert judged.count() == df.count() and own_values(judged, ["quality_score"])
    mixed = mixing.mix_sources(df)
    counts = ["size", "source_size", "target", "taken"]
    assert mixed.count() == df.count() and own_values(mixed, counts)
    plain = mixing.mix_sources(odd)
    shown = ["doc_id", *counts]
    assert Counter(map(tuple, mixed.select(*shown).collect())) == Counter(map(tuple, plain.select(*shown).collect()))
    columns = [c for c in df.columns if c not in counts]
    again = mixing.repeated(mixed, columns)
    assert again.columns == columns and own_values(again, counts)
    assert again.count() == mixing.repeated(plain, ["doc_id", "text"]).count()
    left = substring_dedup.without_repeats(df)
    assert left.columns == df.columns and left.count() == df.count() and own_values(left)
    assert minhash_dedup.near_duplicates(df).count() == df.count()
    assert byte_bpe.digests(df).count() == df.count()


def test_columns_through_the_stages(spark, odd):
    df = clashing(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, df, SMALL)
        assert done.columns == df.columns and own_values(done) and done.count() > 0, name


def shingles(text, n):
    own = words(lower(text))
    return {tuple(own[k : k + n]) for k in range(max(1, len(own) - n + 1))} if own else set()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def one_of_each_group(rows):
    sets, least = {k: shingles(t, 5) for k, t in rows}, {k: k for k, _ in rows}
    for _ in rows:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    return [(k, t) for k, t in rows if least[k] == k]


def without_repeats(rows, n=20):
    seen, out = set(), []
    for k, text in sorted(rows):
        own, gone = words(text), set()
        for at in range(len(own) - n + 1):
            run = tuple(own[at : at + n])
            if run in seen:
                gone.update(range(at, at + n))
            seen.add(run)
        out.append((k, " ".join(w for i, w in enumerate(own) if i not in gone) if gone else text))
    return out


def test_stages_against_plain_python(spark):
    rng = np.random.default_rng(8)
    base = [[f"w{rng.integers(10**6)}" for _ in range(int(rng.integers(30, 120)))] for _ in range(24)]
    shared = [f"s{k}" for k in range(55)]
    texts = [" ".join(t) for t in base]
    texts += [" ".join([*base[k], "Tail"]) for k in range(6)] + [texts[0], texts[0].upper()]
    texts += [" ".join(base[k][:20] + shared + base[k][20:25]) for k in range(10, 14)] + ["", "one two"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, f"src{k % 3}", len(t)) for k, t in rows], "doc_id long, text string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)

    def found(df):
        return sorted((r.doc_id, r.text) for r in df.collect())

    docs = stages["near duplicates"](spark, docs, SMALL)
    rows = one_of_each_group(rows)
    assert found(docs) == rows and len(rows) == 24 + 4 + 2
    docs = stages["repeated passages"](spark, docs, SMALL)
    rows = without_repeats(rows)
    assert found(docs) == rows and sum("s30" in words(t) for _, t in rows) == 1
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect()}
    docs = stages["mix"](spark, docs, SMALL)
    expected = []
    for k, text in rows:
        own, left = words(text), taken[k]
        while left > 0:
            expected.append((k, text if left >= len(own) else " ".join(own[:left])))
            left -= len(own)
    assert found(docs) == sorted(expected)
    encoding = byte_bpe.tokenizer(byte_bpe.public_tokenizers.path(byte_bpe.RANKS))
    counts = Counter((r.doc_id, r.n_tokens) for r in stages["tokens"](spark, docs, SMALL).collect())
    assert counts == Counter((k, len(encoding.encode_ordinary(t))) for k, t in expected)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == before.columns, name
    ids = {r.doc_id for r in docs.collect()}
    tokens = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in tokens.collect()} == ids
    assert len(corpus_pipeline.STAGES) == 5


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("least", [0, 32_767, 32_768, 65_535, 65_536])
def test_cells_of_any_number_of_blocks(spark, least):
    """A cell of one block is told from a cell of two, and no two cells are one."""
    cell = cells_of(spark, least)
    own = np.array([c for low, high, c in cell if low == high])
    other = np.array([c for low, high, c in cell if low != high])
    assert not embedding_dedup.crosses(own).any() and embedding_dedup.crosses(other).all()
    assert len({c for *_, c in cell}) == len({(low, high) for low, high, _ in cell})


def cells_of(spark, least):
    blocks = [least, least + 1, least + 65_536]
    pairs = spark.createDataFrame([(a, b) for a in blocks for b in blocks if a <= b], "low int, high int")
    both = pairs.withColumn("cell", embedding_dedup.cell_of("high", "low"))
    assert both.where(F.col("cell") != embedding_dedup.cell_of("low", "high")).isEmpty()
    return [tuple(r) for r in both.collect()]


@pytest.mark.parametrize("few", [0, 10_000])
def test_few_vectors_have_the_same_links_with_codes_and_without(spark, few):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 32))
    x = np.concatenate([x, x[:150] + 0.2 * rng.normal(size=(150, 32)), x[:20]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, few=few).collect()}
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert links.sum() > 100 and [found[k] for k in range(len(x))] == links.tolist()


def test_a_sieve_lets_all_of_its_values_through(spark):
    ids = spark.range(0, 5_000, 5).toDF("x").unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS x"))
    some = spark.range(5_000).toDF("id").unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS id"))
    for bits, most in ((1 << 25, 1_010), (1 << 12, 5_001)):
        passed = some.where(sieve(ids, bits)(F.col("id")))
        assert passed.join(ids, F.col("id").eqNullSafe(F.col("x"))).count() == 1_001
        assert passed.count() <= most


def test_rows_without_dropped_ids(spark, odd):
    names = odd.selectExpr("*", "1 AS dropped", "2 AS suspected", "3 AS row", "4 AS kept_id")
    dropped = spark.createDataFrame([(2,), (None,), (77,)], "doc_id long")
    kept = without(names, dropped)
    assert kept.columns == names.columns
    expected = sorted((tuple(r) for r in names.collect() if r.doc_id not in (2, None)), key=repr)
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == expected
    assert without(names, dropped.where("false")).count() == names.count()


def test_fingerprints_have_no_python_worker(spark):
    plan = fingerprints.op3_fingerprints(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "InArrow", "InPandas"):
        assert operator not in plan
