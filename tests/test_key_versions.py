from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, rows, unique_failure
from wardline.functions import key_versions as kv
from wardline.plans import protection

KEYS = [
    ("s", "k", 1, "0123456789abcdef"),
    ("s", "k", 2, "0123456789abcdef01234567"),
    ("s", "k", 3, "0123456789abcdef0123456789abcdef"),
    ("s", "other", 1, "0123456789abcdef"),
    ("s/k", "", 1, "0123456789abcdef"),
    ("s", "twice", 1, "0123456789abcdef"),
    ("s", "twice", 2, "fedcba9876543210"),
    ("s", "twice", 2, "fedcba9876543210"),
    ("s", "short", 1, "0123"),
    ("s", "none", None, "0123456789abcdef"),
]


def keys(spark, most=3):
    df = spark.createDataFrame(KEYS, "scope string, key string, version int, secret string")
    return df.where(F.col("version").isNull() | (F.col("version") <= most))


def people(spark):
    return spark.createDataFrame(
        [("a", "1-2", "z"), ("b", None, "é" * 200), ("c", "", "1-2")], "n string, s string, z string"
    )


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_values_of_every_version_in_one_reading(spark, tmp_path):
    df = people(spark)
    hidden = None
    for version in (1, 2, 3):
        own = kv.encrypt_columns(df, ["s", "z"], keys(spark, version), "s", "k")
        hidden = own if hidden is None else hidden.unionByName(own)
    hidden = stored(hidden, tmp_path / "h")
    assert {r[0] for r in hidden.select(kv.version_of("z")).collect()} == {1, 2, 3}
    assert {r[0] for r in hidden.where("n = 'b'").select(kv.version_of("s")).collect()} == {None}
    shown = kv.decrypt_columns(hidden, {"s": "s", "z": "zip"}, keys(spark), "s", "k")
    assert shown.columns == ["n", "s", "zip"]
    assert rows(shown) == rows(df.unionByName(df).unionByName(df).withColumnRenamed("z", "zip"))


def test_a_value_is_bound_to_its_scope_key_and_version(spark, tmp_path):
    hidden = stored(kv.encrypt_columns(people(spark), ["z"], keys(spark, 1), "s", "k"), tmp_path / "h")
    # The other keys have the same secret under another name.
    for scope, key in (("s", "other"), ("s/k", "")):
        assert unique_failure(kv.decrypt_columns(hidden, ["z"], keys(spark), scope, key).collect)
        tolerant = kv.decrypt_columns(hidden, ["z"], keys(spark), scope, key, tolerant=True)
        assert [r.z for r in tolerant.collect()] == [None] * 3
    moved = hidden.withColumn("z", F.regexp_replace("z", "^v1:", "v2:"))
    assert unique_failure(kv.decrypt_columns(moved, ["z"], keys(spark), "s", "k").collect)


@pytest.mark.parametrize("text", ["v9:AAAA", "AAAA", "", "v1:", "v99999999999999999999:AAAA"])
def test_values_without_a_known_version(spark, text):
    df = spark.createDataFrame([(text,), (None,)], "z string")
    failure = unique_failure(kv.decrypt_columns(df, ["z"], keys(spark), "s", "k").collect)
    assert "no usable version of s/k" in failure
    tolerant = kv.decrypt_columns(df, ["z"], keys(spark), "s", "k", tolerant=True)
    assert [r.z for r in tolerant.collect()] == [None, None]


def test_unusable_versions_fail_where_they_are_needed(spark, tmp_path):
    for key in ("missing", "twice", "short", "none"):
        hidden = kv.encrypt_columns(people(spark), ["z"], keys(spark), "s", key)
        assert f"no usable newest version of s/{key}" in unique_failure(hidden.collect)
    hidden = stored(kv.encrypt_columns(people(spark), ["z"], keys(spark, 1), "s", "twice"), tmp_path / "h")
    shown = kv.decrypt_columns(hidden, ["z"], keys(spark), "s", "twice")
    assert rows(shown) == rows(people(spark))


def test_no_rows(spark):
    none = people(spark).where("false")
    hidden = kv.encrypt_columns(none, ["z"], keys(spark), "s", "k")
    assert kv.decrypt_columns(hidden, ["z"], keys(spark), "s", "k").count() == 0


def test_secrets_are_not_in_the_plan(spark):
    hidden = kv.encrypt_columns(people(spark), ["s", "z"], stored_keys(spark), "s", "k")
    shown = kv.decrypt_columns(hidden, ["s", "z"], stored_keys(spark), "s", "k")
    text = final_plan(shown) + shown._jdf.queryExecution().toString()
    assert not any(secret in text for *_, secret in KEYS if len(secret) > 4)


def stored_keys(spark):
    keys(spark).write.mode("overwrite").saveAsTable("version_keys")
    return spark.read.table("version_keys")


def files(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_rotation_rewrites_only_batches_of_older_versions(spark, tmp_path):
    target = tmp_path / "people"
    for batch, version in enumerate((1, 2, 3)):
        protection.publish_batch(people(spark), ["s", "z"], keys(spark, version), "s", "k", str(target), batch)
    # One batch holds values of two versions.
    mixed = kv.encrypt_columns(people(spark), ["s", "z"], keys(spark, 1), "s", "k").unionByName(
        kv.encrypt_columns(people(spark), ["s", "z"], keys(spark, 3), "s", "k")
    )
    mixed.write.parquet(str(target / "batch=7"))
    new = spark.read.parquet(str(target / "batch=7")).where(kv.version_of("z") == 3).select("z")
    kept = rows(new)
    before = files(target)
    args = (spark, str(target), ["s", "z"], keys(spark), "s", "k")
    assert protection.rotate_key(*args) == [0, 1, 7]
    after = files(target)
    untouched = {p for p in before if "batch=2" in str(p)}
    assert untouched and all(after[p] == before[p] for p in untouched)
    assert not any(p in after for p in before if p not in untouched)
    assert set(kept) <= set(rows(spark.read.parquet(str(target / "batch=7")).select("z")))
    # The older secrets are needed no more.
    newest = keys(spark).where("version = 3")
    shown = protection.read_batches(spark, str(target), ["s", "z"], newest, "s", "k")
    assert rows(shown) == sorted(rows(people(spark)) * 5, key=repr)
    assert protection.rotate_key(*args) == []
    assert files(target) == after


def test_a_rotation_that_fails_changes_nothing_and_goes_on_later(spark, tmp_path):
    target = tmp_path / "people"
    for batch, version in enumerate((1, 2)):
        protection.publish_batch(people(spark), ["z"], keys(spark, version), "s", "k", str(target), batch)
    before = files(target)
    lost = keys(spark).where("version != 1")
    unique_failure(lambda: protection.rotate_key(spark, str(target), ["z"], lost, "s", "k"))
    assert files(target) == before
    assert protection.rotate_key(spark, str(target), ["z"], keys(spark), "s", "k") == [0, 1]
    shown = protection.read_batches(spark, str(target), ["z"], keys(spark), "s", "k")
    assert rows(shown) == sorted(rows(people(spark)) * 2, key=repr)


def test_publishing_a_batch_again_replaces_it(spark, tmp_path):
    for _ in range(2):
        protection.publish_batch(people(spark), ["z"], keys(spark), "s", "k", str(tmp_path / "p"), 4)
    shown = protection.read_batches(spark, str(tmp_path / "p"), ["z"], keys(spark), "s", "k")
    assert rows(shown) == rows(people(spark))


def test_functions_read_every_version(spark, tmp_path):
    stored_keys(spark)
    kv.register_cipher_functions(spark, "version_keys", "s", "k", "seal", "unseal")
    hidden = kv.encrypt_columns(people(spark), ["s", "z"], keys(spark, 2), "s", "k")
    hidden = stored(hidden, tmp_path / "h")
    shown = spark.sql("SELECT n, unseal(s) AS s, unseal(seal(unseal(z))) AS z FROM {h}", h=hidden)
    assert rows(shown) == rows(people(spark))
    sealed = stored(spark.sql("SELECT n, s, seal(z) AS z FROM {p}", p=people(spark)), tmp_path / "f")
    assert {r[0] for r in sealed.select(kv.version_of("z")).collect()} == {3}
    assert rows(kv.decrypt_columns(sealed, ["z"], keys(spark), "s", "k")) == rows(people(spark))
    assert "no usable version" in unique_failure(spark.sql("SELECT unseal('v9:AAAA')").collect)
