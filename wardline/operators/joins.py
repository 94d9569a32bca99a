"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> Column:
    """Equality on every key pair under which NULL equals NULL.

    Spark shuffles such a join by derived keys, so it reads both inputs through shuffles of
    its own even where one is already grouped by the key. Only those can be split at run
    time when a key turns out to be hot.
    """
    return reduce(
        lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in keys.items()]
    )


def not_null(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])


def left_join_many(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    left_keys: DataFrame | None = None,
) -> DataFrame:
    """Left outer join (left key -> right key) whose right side may hold any number of rows per key.

    Spark can split a hot key on the right of an inner join, but not of a left outer join,
    where one task would get all of it. So the left keys without a partner are found first,
    from the distinct keys of both sides, and join as rows with empty right columns; the join
    proper is then an inner one. It also lets Spark broadcast a left side that is small enough,
    and the rows of the left side, however wide, are shuffled once at most.

    ``left_keys`` may name a cheaper source of the left keys, with their columns; it must hold
    every key of the left side and may hold others. The right side's key columns are not part
    of the result.
    """
    partner_keys = {l: f"__right_{r}" for l, r in keys.items()}
    payload = [name for name in right.columns if name not in keys.values()]
    partners = right.filter(not_null(keys.values())).select(
        *[F.col(r).alias(partner_keys[l]) for l, r in keys.items()], *payload
    )

    candidates = (left if left_keys is None else left_keys).select(
        *[F.col(l).alias(k) for l, k in partner_keys.items()]
    )
    lonely = candidates.distinct().join(
        partners.select(*partner_keys.values()).distinct(),
        on=list(partner_keys.values()),
        how="left_anti",
    )
    types = {field.name: field.dataType for field in right.schema.fields}
    fillers = lonely.select(
        *partner_keys.values(), *[F.lit(None).cast(types[name]).alias(name) for name in payload]
    )

    complete = partners.unionByName(fillers)
    joined = left.join(complete, null_safe(left, complete, partner_keys), "inner")
    return joined.select(*[left[name] for name in left.columns], *payload)
