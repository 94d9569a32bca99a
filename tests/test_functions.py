from __future__ import annotations

import re

from pyspark.sql import functions as F

from conftest import rows, unique_failure
from wardline.functions import cipher, names, routine_rules

KEYS = [
    ("s", "k16", "0123456789abcdef"),
    ("s", "k24", "0123456789abcdef01234567"),
    ("s", "k32", "0123456789abcdef0123456789abcdef"),
    ("s", "other", "fedcba9876543210"),
    ("s", "short", "0123"),
    ("s", "twice", "0123456789abcdef"),
    ("s", "twice", "0123456789abcdef"),
    ("s", "null", None),
]


def test_names_and_types(spark):
    data = [("a",), ("a.b",), ("a.b.c",), ("a.b.c.d",), (None,), ("",), ("a.",)]
    df = spark.createDataFrame(data, "n string").select(
        "n", names.securable_type("n"), *[names.name_part("n", i) for i in (1, 2, 3)]
    )
    assert [tuple(row) for row in df.collect()] == [
        ("a", "Catalog", "a", "", ""),
        ("a.b", "Schema", "a", "b", ""),
        ("a.b.c", "Table", "a", "b", "c"),
        ("a.b.c.d", "Table", "a", "b", "c"),
        (None, "Catalog", None, None, None),
        ("", "Catalog", "", "", ""),
        ("a.", "Catalog", "a", "", ""),
    ]


def test_identifiers(spark):
    df = spark.createDataFrame([("a", "b`c", "d"), ("a", None, "d")], "x string, y string, z string")
    assert [tuple(row) for row in df.select(
        names.identifier("x", "y", "z"), names.quoted_identifier("x", "y", "z")
    ).collect()] == [("a.b`c.d", "`a`.`b``c`.`d`"), ("a.d", "`a`.`d`")]


# Definition, whether it calls no banned function, whether its first secret call is allowed.
VERDICTS = [
    ("sha2(value, 256)", False, False),
    ("select mask(x)", False, False),
    ("mask_x(value)", True, False),
    ("MD5(value)", True, False),
    ("xxhash64(value)", True, False),
    ("hash", False, False),
    ("éhash(value)", True, False),
    ("hash́(value)", False, False),
    ("hash²(value)", True, False),
    ("a.crc32.b", False, False),
    ("sha\n1", False, False),
    ("sha1x sha256", True, False),
    ("", True, False),
    ("secret('scope1','key1')", True, True),
    ('secret("scope1",\t \'key1\')', True, True),
    ('secret(\'scope1",\'key1\') secret(\'scope2\',\'key2\')', True, True),
    ("secret('bad','key1') secret('scope2','key2')", True, False),
    ("secret('scope2','key2') secret('bad','key1')", True, True),
    ("secret( 'scope1','key1')", True, False),
    ("secret('scope1' ,'key1')", True, False),
    ("secret('scope1',\xa0'key1')", True, True),
    ("secret('scopé','key1')", True, False),
    ("secret('scope1','key2')", True, False),
    ("mysecret('encryptionkeys','ssn')", True, True),
    ("secret(scope1,key1)", True, False),
    ("secret('scope.1','key1')", True, False),
]


def test_rules(spark):
    df = spark.createDataFrame([(text,) for text, *_ in VERDICTS], "d string").select(
        "d",
        routine_rules.function_validity("d") == "validFunction",
        routine_rules.secret_validity("d") == "validSecret",
    )
    assert [tuple(row) for row in df.collect()] == VERDICTS


def test_rule_options(spark):
    df = spark.createDataFrame([("MD5(x)",), ("f+g",), (None,)], "d string")
    verdicts = df.select(
        routine_rules.function_validity("d", ignore_case=True),
        routine_rules.function_validity("d", banned=[]),
        routine_rules.function_validity("d", banned=["f+g"]),
        routine_rules.secret_validity("d", allowed={}),
    )
    assert [tuple(row) for row in verdicts.collect()] == [
        ("invalidFunction", "validFunction", "validFunction", "invalidSecret"),
        ("validFunction", "validFunction", "invalidFunction", "invalidSecret"),
        (None, None, None, None),
    ]


def people(spark):
    return spark.createDataFrame(
        [("a", "1-2", "z"), ("b", None, "é" * 200), ("c", "", "1-2")], "n string, s string, z string"
    )


def keys(spark):
    return spark.createDataFrame(KEYS, "scope string, key string, secret string")


def test_encryption_round_trip_for_every_key_length(spark):
    for name in ("k16", "k24", "k32"):
        hidden = cipher.encrypt_columns(people(spark), ["s", "z"], keys(spark), "s", name)
        assert hidden.columns == ["n", "s", "z"]
        shown = cipher.decrypt_columns(hidden, ["s", "z"], keys(spark), "s", name)
        assert rows(shown) == rows(people(spark))
        assert hidden.filter("z IS NOT NULL").count() == 3
        assert hidden.filter("s IS NULL").select("n").collect()[0].n == "b"


def test_equal_values_get_different_ciphertext(spark):
    df = spark.range(10).select(F.concat(F.lit("v"), F.col("id") % 2).alias("v"))
    hidden = cipher.encrypt_columns(df, ["v"], keys(spark), "s", "k16")
    assert len({row.v for row in hidden.collect()}) == 10


def test_long_ciphertext_is_one_line(spark):
    keys(spark).createOrReplaceTempView("test_keys")
    cipher.register_cipher_functions(spark, "test_keys", "s", "k32", "enc", "dec")
    df = spark.range(1).select(F.repeat(F.lit("x"), F.lit(1000)).alias("v"))
    by_column = cipher.encrypt_columns(df, ["v"], keys(spark), "s", "k32").collect()[0].v
    by_function = spark.sql("SELECT enc(v) AS v FROM {df}", df=df).collect()[0].v
    for text in (by_column, by_function):
        assert len(text) == 4 * -(-1028 // 3)
        assert re.fullmatch("[A-Za-z0-9+/]+=*", text)


def test_unusable_keys_fail(spark):
    for name, message in (
        ("missing", "expected one secret"),
        ("twice", "expected one secret"),
        ("short", "no usable length"),
        ("null", "no usable length"),
    ):
        hidden = cipher.encrypt_columns(people(spark), ["s"], keys(spark), "s", name)
        assert message in unique_failure(hidden.collect)


def test_the_wrong_key(spark, tmp_path):
    path = str(tmp_path / "hidden")
    cipher.encrypt_columns(people(spark), ["z"], keys(spark), "s", "k16").write.parquet(path)
    hidden = spark.read.parquet(path)
    shown = cipher.decrypt_columns(hidden, ["z"], keys(spark), "s", "other")
    assert unique_failure(shown.collect)
    tolerant = cipher.decrypt_columns(hidden, ["z"], keys(spark), "s", "other", tolerant=True)
    assert [row.z for row in tolerant.collect()] == [None, None, None]


def test_registered_functions_can_be_replaced(spark):
    keys(spark).createOrReplaceTempView("test_keys")
    people(spark).createOrReplaceTempView("test_people")
    for name in ("k16", "k32"):
        cipher.register_cipher_functions(spark, "test_keys", "s", name, "enc", "dec")
        spark.sql("SELECT n, dec(enc(z)) AS z FROM test_people").createOrReplaceTempView("shown")
        assert spark.sql("SELECT * FROM shown EXCEPT SELECT n, z FROM test_people").count() == 0
    hidden = cipher.encrypt_columns(people(spark), ["z"], keys(spark), "s", "k32")
    hidden.createOrReplaceTempView("hidden")
    assert spark.sql("SELECT dec(z) AS z FROM hidden").exceptAll(people(spark).select("z")).count() == 0


def test_registered_functions_take_awkward_names(spark):
    spark.createDataFrame(
        [("it's\\", "k'", "0123456789abcdef")], "scope string, key string, secret string"
    ).createOrReplaceTempView("test_keys")
    cipher.register_cipher_functions(spark, "test_keys", "it's\\", "k'", "enc", "dec")
    assert spark.sql("SELECT dec(enc(id)) AS v FROM range(1)").collect()[0].v == "0"


def test_functions_stored_in_the_catalog(spark, tmp_path):
    keys(spark).write.mode("overwrite").saveAsTable("stored_keys")
    cipher.register_cipher_functions(
        spark, "stored_keys", "s", "k24", "stored_enc", "stored_dec", temporary=False
    )
    assert spark.sql("SELECT stored_dec(stored_enc('v')) AS v").collect()[0].v == "v"
    shown = spark.sql("SHOW USER FUNCTIONS").collect()
    assert any(row[0].endswith("stored_enc") for row in shown)


NAMES = [
    ("a.b", "c", "`a.b`.c"), ("a", "b.c", "a.`b.c`"), ("a", "b", "a.b"), ("a", "b`c", "a.b`c"),
    ("`a", "b", "```a`.b"), ("`a`", "b.`", "```a```.`b.```"), (".", "..", "`.`.`..`"), ("a`.", "b", "`a``.`.b"),
]


def test_names_with_dots_keep_their_parts(spark):
    df = spark.createDataFrame(NAMES, "a string, b string, expected string")
    named = df.withColumn("n", names.identifier("a", "b"))
    parts = named.select("a", "b", "expected", "n", *[names.name_part("n", i) for i in (1, 2, 3)], names.securable_type("n"))
    for a, b, expected, n, one, two, three, kind in parts.collect():
        assert (n, one, two, three, kind) == (expected, a, b, "", "Schema")
    assert named.select("n").distinct().count() == len(NAMES)


def test_backticks_that_quote_no_part(spark):
    texts = {"`a.b": ("`a", "b"), "`a`b.c": ("`a`b", "c"), "``.c": ("``", "c"), "a`.b": ("a`", "b"), "`": ("`", "")}
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    found = df.select("n", *[names.name_part("n", i) for i in (1, 2)])
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == texts


def test_a_long_name_in_backticks(spark):
    df = spark.range(1).select(F.concat(F.lit("`"), F.repeat(F.lit("x."), F.lit(20_000)), F.lit("`.c")).alias("n"))
    assert df.select(names.name_part("n", 2)).first()[0] == "c"
