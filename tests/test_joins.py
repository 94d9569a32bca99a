from __future__ import annotations

from pyspark.sql import functions as F

from conftest import final_plan, rows
from wardline.operators.joins import left_join_many


def test_same_rows_as_a_left_outer_join(spark):
    left = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5), ("c", 5)], "k string, l int"
    )
    right = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", "y"), (None, "z"), ("d", "w"), ("c", None)],
        "k string, r string",
    )
    expected = left.join(right.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "left")
    assert rows(left_join_many(left, right, {"k": "k"})) == rows(expected.drop("k2"))


def test_several_keys_under_different_names(spark):
    left = spark.createDataFrame([("a", "b", 1), ("a", None, 2), ("c", "d", 3)], "x string, y string, l int")
    right = spark.createDataFrame([("a", "b", 9), ("c", "e", 8)], "p string, q string, r int")
    joined = left_join_many(left, right, {"x": "p", "y": "q"})
    assert joined.columns == ["x", "y", "l", "r"]
    assert rows(joined) == [("a", "b", 1, 9), ("a", None, 2, None), ("c", "d", 3, None)]


def test_a_small_left_side_is_broadcast_and_the_right_is_not_shuffled_for_it(spark, tmp_path):
    spark.range(100_000).select((F.col("id") % 50).alias("k"), "id").write.parquet(
        str(tmp_path / "right")
    )
    right = spark.read.parquet(str(tmp_path / "right"))
    left = spark.createDataFrame([(1,), (77,)], "k long")
    text = final_plan(left_join_many(left, right, {"k": "k"}))
    assert text.index("BroadcastHashJoin") < text.index("Union")


def test_a_superset_of_the_left_keys_adds_no_rows(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, l int")
    right = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, r string")
    more = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert rows(left_join_many(left, right, {"k": "k"}, left_keys=more)) == rows(
        left_join_many(left, right, {"k": "k"})
    )
