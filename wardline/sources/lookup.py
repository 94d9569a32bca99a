"""The privilege lookup: fixed rows that say what a collective privilege contains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.constants import ALL_PRIVILEGES, INHERITED_PRIVILEGES


def privilege_lookup(spark: SparkSession) -> DataFrame:
    """The lookup as an inline table.

    Spark knows the exact size of an inline table when it plans, so it broadcasts the lookup
    from the start. Rows handed over from Python have no known size: a join with them would
    shuffle the other side before finding out.
    """
    rows = ", ".join(
        f"('{kind}', '{ALL_PRIVILEGES}', '{privilege}')"
        for kind, privileges in INHERITED_PRIVILEGES.items()
        for privilege in privileges
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS lookup(type, privilegeType, privilegeInheritance)"
    )
