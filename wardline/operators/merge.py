"""Merging a source into a stored table, as joins that return the table's new contents.

``keys`` maps each key column of the source to the target column or expression it must
equal; NULL keys never match. ``set_columns`` maps target columns to the source columns
that replace them. A condition is a function of two accessors, for a target and for a
source column, for instance ``lambda target, source: source("ts") >= target("ts")``.

A target row must not match more than one source row: the job fails if it does.

The source is grouped once, by key and whole row, into rows with a count of their copies. Everything
else is derived from that grouping: the one row per key that meets the target, and the rows of keys
that the target lacks. Its shuffle is the same in all of them, so Spark computes it once and
reads the source once, however expensive the source is.

``colocated=True`` joins on the keys as they are, so that a target bucketed by them is not shuffled.
Use it where keys are (nearly) unique on both sides; otherwise null-safe keys make Spark shuffle for
the join, since only such a shuffle can be split at a hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.joins import not_null, null_safe

Accessor = Callable[[str], Column]
Condition = Callable[[Accessor, Accessor], Column]
Keys = Mapping[str, "str | Column"]


def _always(target: Accessor, source: Accessor) -> Column:
    return F.lit(True)


def _of_source(name: str) -> Column:
    return F.col(f"__value_{name}")


def _target_keys(keys: Keys) -> dict[str, Column]:
    return {
        f"__target_{name}": F.col(value) if isinstance(value, str) else value
        for name, value in keys.items()
    }


def _key_pairs(keys: Keys) -> dict[str, str]:
    return {f"__target_{name}": f"__source_{name}" for name in keys}


def _join_on(left: DataFrame, right: DataFrame, keys: Mapping[str, str], colocated: bool) -> Column:
    if not colocated:
        return null_safe(left, right, keys)
    return reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in keys.items()])


def _grouped(source: DataFrame, keys: Keys) -> DataFrame:
    """Distinct source rows with their keys and the number of their copies.

    Copies of a row are counted on the map side first, so that not even a source of equal rows gathers
    in one task. The keys are results of the grouping rather than what it groups by: what is later asked
    of a key then stays above the grouping, which so remains the same wherever it is used.
    """
    return (
        source.groupBy(F.struct(*source.columns).alias("__row"))
        .agg(
            F.count(F.lit(1)).alias("__copies"),
            *[F.any_value(name).alias(f"__source_{name}") for name in keys],
        )
    )


def _by_key(grouped: DataFrame, keys: Keys) -> DataFrame:
    """One row per key that is not NULL: how many source rows it has, and one of them."""
    names = [f"__source_{name}" for name in keys]
    return (
        grouped.groupBy(*[F.col(name).alias(f"__group_{name}") for name in names])
        .agg(
            F.sum("__copies").alias("__matches"),
            F.any_value("__row").alias("__row"),
            F.bool_and(not_null(names)).alias("__known"),
            *[F.any_value(name).alias(name) for name in names],
        )
        .filter("__known")
    )


def _with_match(
    target: DataFrame, grouped: DataFrame, keys: Keys, columns: list[str], colocated: bool
) -> DataFrame:
    """Target rows with the number of source rows of their key (NULL if none) and its values."""
    by_key = _by_key(grouped, keys).select(
        *[f"__source_{name}" for name in keys],
        "__matches",
        *[F.col("__row")[name].alias(f"__value_{name}") for name in columns],
    )
    keyed = target.withColumns(_target_keys(keys))
    too_many = F.raise_error(F.lit("a target row matches more than one source row"))
    return keyed.join(by_key, _join_on(keyed, by_key, _key_pairs(keys), colocated), "left").filter(
        F.when(F.col("__matches") > 1, too_many.cast("boolean")).otherwise(F.lit(True))
    )


def _updated(target, grouped, columns, keys, set_columns, when, colocated) -> DataFrame:
    applies = F.col("__matches").isNotNull() & when(F.col, _of_source)
    return _with_match(target, grouped, keys, columns, colocated).select(
        *[
            F.when(applies, _of_source(set_columns[name])).otherwise(F.col(name)).alias(name)
            if name in set_columns
            else F.col(name)
            for name in target.columns
        ]
    )


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Keys,
    set_columns: Mapping[str, str],
    when: Condition = _always,
    colocated: bool = False,
) -> DataFrame:
    """Every target row; where the source has its key and ``when`` holds, with new values."""
    return _updated(
        target, _grouped(source, keys), source.columns, keys, set_columns, when, colocated
    )


# Copies of a row are repeated in runs of at most so many.
RUN_OF_COPIES = 4_096


def _unmatched_source(
    target: DataFrame, grouped: DataFrame, keys: Keys, colocated: bool
) -> DataFrame:
    """Source rows, as a struct, whose key the target lacks; a NULL key always does.

    The target's keys are first narrowed to those the source has. A small source is thereby
    broadcast and the target is not shuffled at all.
    """
    target_keys = target.select(*[c.alias(name) for name, c in _target_keys(keys).items()])
    # The count is asked for so that the grouping below is the same as elsewhere.
    source_keys = _by_key(grouped, keys).filter(F.col("__matches") > 0)
    pairs = _key_pairs(keys)
    matched = target_keys.join(
        source_keys, _join_on(target_keys, source_keys, pairs, colocated), "left_semi"
    ).distinct()
    own_keys = {f"__source_{name}": f"__target_{name}" for name in keys}
    left = grouped.join(matched, _join_on(grouped, matched, own_keys, colocated), "left_anti")
    runs = F.sequence(F.lit(0), F.col("__copies") - 1, F.lit(RUN_OF_COPIES))
    left = left.select("__row", F.explode(runs).alias("__from"), "__copies")
    copies = F.least(F.lit(RUN_OF_COPIES), F.col("__copies") - F.col("__from")).cast("int")
    return left.select(F.explode(F.array_repeat("__row", copies)).alias("__row"))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Keys,
    set_columns: Mapping[str, str],
    when: Condition = _always,
    colocated: bool = False,
) -> DataFrame:
    """:func:`merge_update`, and whole source rows for the keys the target lacks."""
    grouped = _grouped(source, keys)
    updated = _updated(target, grouped, source.columns, keys, set_columns, when, colocated)
    inserted = _unmatched_source(target, grouped, keys, colocated)
    return updated.unionByName(inserted.select(*[F.col("__row")[n].alias(n) for n in target.columns]))


def merge_outcome(
    target: DataFrame, source: DataFrame, keys: Keys, when: Condition = _always
) -> DataFrame:
    """What an upsert does, per row: the key and ``update``, ``stale``, ``keep`` or ``insert``."""
    outcome = (
        F.when(F.col("__matches").isNull(), F.lit("keep"))
        .when(when(F.col, _of_source), F.lit("update"))
        .otherwise(F.lit("stale"))
    )
    grouped = _grouped(source, keys)
    stored = _with_match(target, grouped, keys, source.columns, False).select(
        *[F.col(f"__target_{name}").alias(name) for name in keys], outcome.alias("outcome")
    )
    new = _unmatched_source(target, grouped, keys, False).select(
        *[F.col("__row")[name].alias(name) for name in keys], F.lit("insert").alias("outcome")
    )
    return stored.unionByName(new)
