from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMALL, final_plan, rows, unique_failure
from samples.relations import Relations
from test_functions import VERDICTS
from wardline.constants import ALLOWED_KEYS, BANNED_FUNCTIONS
from wardline.functions import routine_rules
from wardline.operators import rule_tables as rt
from wardline.plans.audit import routine_audit


def banned(spark, names=BANNED_FUNCTIONS):
    return spark.createDataFrame([(n,) for n in names], "name string")


def allowed(spark, pairs=None):
    pairs = pairs or [(s, k) for s, own in ALLOWED_KEYS.items() for k in own]
    return spark.createDataFrame(pairs, "scope string, key string")


def test_the_verdicts_of_the_expressions(spark):
    texts = [(text,) for text, *_ in VERDICTS] * 2 + [(None,)]
    df = spark.createDataFrame(texts, "d string")
    found = rt.with_secret_validity(rt.with_function_validity(df, banned(spark), "d"), allowed(spark), "d")
    expected = df.select(
        "d", routine_rules.function_validity("d"), routine_rules.secret_validity("d")
    )
    assert rows(found) == rows(expected)


def test_every_routine_has_the_verdicts_of_the_expressions(spark):
    routines = Relations(spark, SMALL)["routines"]
    as_of = F.lit("2024-01-01 00:00:00").cast("timestamp")
    by_table = routine_audit(routines, as_of, banned(spark), allowed(spark))
    assert by_table.columns == routine_audit(routines, as_of).columns
    assert rows(by_table) == rows(routine_audit(routines, as_of))


def test_names_of_several_words_and_signs(spark):
    names = ["f+g", "+h", "a.b(", "-- no", r"x\Ey", "é", None, "f+g"]
    texts = ["f+g", "xf+g", "f+gx", "(f+g)", "1 +h", "1+h2", "a.b(1)", "a.b( 1", "aa.b(", "a.b ", "-- no", "--no",
             r"x\Ey", "xEy", "é", "e", "(é)", ""]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    found = rt.with_function_validity(df, banned(spark, names), "d")
    by_expression = routine_rules.function_validity("d", [n for n in set(names) if n])
    assert rows(found) == rows(df.select("d", by_expression))
    invalid = {d for d, v in rows(found) if v == "invalidFunction"}
    assert invalid == {"f+g", "(f+g)", "1 +h", "a.b( 1", "-- no", r"x\Ey", "é", "(é)"}


def test_a_name_without_a_word_is_an_error(spark):
    df = spark.createDataFrame([("a",)], "d string")
    assert "without a word: ++" in unique_failure(
        rt.with_function_validity(df, banned(spark, ["++", "a"]), "d").collect
    )


def test_empty_tables(spark):
    df = spark.createDataFrame([("md5",), (None,)], "d string")
    found = rt.with_function_validity(df, banned(spark).where("false"), "d")
    assert rows(found) == [("md5", "validFunction"), (None, None)]
    found = rt.with_secret_validity(df, allowed(spark).where("false"), "d")
    assert rows(found) == [("md5", "invalidSecret"), (None, None)]
    assert rt.with_function_validity(df.where("false"), banned(spark), "d").count() == 0
    odd = allowed(spark, [("", ""), (None, "k"), ("s", None), ("scope1", "key1"), ("scope1", "key1")])
    calls = spark.createDataFrame([("secret('scope1','key1')",), ("none",)], "d string")
    found = rows(rt.with_secret_validity(calls, odd, "d"))
    assert dict(found) == {"none": "invalidSecret", "secret('scope1','key1')": "validSecret"}
    assert len(found) == 2


def test_twenty_thousand_names(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    names = [f"fn_{i}" for i in range(20_000)]
    df = spark.range(500).selectExpr("concat('select fn_', id * 100, '(x), fn_z(', id, ')') AS d")
    text = final_plan(rt.with_function_validity(df, banned(spark, names), "d"))
    assert "Python" not in text and "InArrow" not in text and "NestedLoop" not in text
    found = rt.with_function_validity(df, banned(spark, names), "d").where("isFunctionValid = 'invalidFunction'")
    assert found.count() == 200


def test_calls_by_name(spark):
    df = spark.createDataFrame([("md5(md5(x))",), ("md5(sha1(x))",), ("md5(md5(x))",), ("x",)], "d string")
    calls = rt.banned_calls(df, banned(spark), "d")
    assert rows(calls.groupBy("name").count()) == [("md5", 2), ("sha1", 1)]


def test_columns_of_routines_with_the_names_of_rules(spark):
    df = spark.createDataFrame(
        [("md5", "a", "b", "c", "d", "e", "f")],
        "d string, name string, word string, found string, scope string, key string, definition string",
    )
    found = rt.with_secret_validity(rt.with_function_validity(df, banned(spark), "d"), allowed(spark), "d")
    assert rows(found) == [("md5", "a", "b", "c", "d", "e", "f", "invalidFunction", "invalidSecret")]
