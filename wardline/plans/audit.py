"""Auditing registered routines: verdicts, the removal plan, and marking what was removed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import schemas
from wardline.constants import (
    ALLOWED_KEYS,
    BANNED_FUNCTIONS,
    NOT_AUDITED,
    REMOVE,
    VALID_FUNCTION,
    VALID_SECRET,
)
from wardline.functions.names import identifier, quoted_identifier
from wardline.functions.routine_rules import function_validity, secret_validity
from wardline.operators.merge import merge_update
from wardline.operators.rule_tables import with_function_validity, with_secret_validity
from wardline.sinks.tables import append_audit, exists, publish_version, write_partitions
from wardline.sources.tables import read_saved, routines_with_definition, typed


def routine_audit(
    routines: DataFrame,
    as_of: Column | None = None,
    banned: Iterable[str] | DataFrame = BANNED_FUNCTIONS,
    allowed: Mapping[str, Iterable[str]] | DataFrame = ALLOWED_KEYS,
) -> DataFrame:
    """One row per routine with a definition: both verdicts, their conjunction, time and status.

    A routine that uses no allowed key is invalid, even if it encrypts nothing. Rules may also be
    tables: ``(name)`` of banned functions, ``(scope, key)`` of allowed keys.
    """
    text = "routine_definition"
    judged = routines_with_definition(routines)
    if isinstance(banned, DataFrame):
        judged = with_function_validity(judged, banned, text)
    else:
        judged = judged.withColumn("isFunctionValid", function_validity(text, banned))
    if isinstance(allowed, DataFrame):
        judged = with_secret_validity(judged, allowed, text)
    else:
        judged = judged.withColumn("isSecretValid", secret_validity(text, allowed))
    return judged.withColumns(
        {
            "isValid": (F.col("isFunctionValid") == VALID_FUNCTION)
            & (F.col("isSecretValid") == VALID_SECRET),
            "markedAt": F.current_timestamp() if as_of is None else as_of,
            "status": F.lit(NOT_AUDITED),
        }
    )


def removal_plan(audit: DataFrame, include_history: bool = False) -> DataFrame:
    """One row per invalid audit row, with the statement that would remove the routine.

    The plan is a table to review; nothing here runs the statements. Rows marked in an earlier
    run are left out unless ``include_history`` is set.
    """
    invalid = audit.filter(~F.col("isValid"))
    if not include_history:
        invalid = invalid.filter(F.col("status") == NOT_AUDITED)
    return invalid.select(
        identifier(*schemas.ROUTINE_KEY).alias("toRemove"),
        "markedAt",
        F.lit(REMOVE).alias("action"),
        F.concat(
            F.lit("DROP FUNCTION IF EXISTS "), quoted_identifier(*schemas.ROUTINE_KEY)
        ).alias("statement"),
    )


def mark_removed(audit: DataFrame, plan: DataFrame) -> DataFrame:
    """The audit with the plan's action as the status of every row the plan names."""
    return merge_update(
        audit,
        plan.select("toRemove", "markedAt", "action"),
        keys={"toRemove": identifier(*schemas.ROUTINE_KEY), "markedAt": "markedAt"},
        set_columns={"status": "action"},
    )


def record_audit(
    routines: DataFrame, target: str, as_of: Column | None = None
) -> None:
    """One run of the audit, stored as a partition of the history; recording it again replaces it.

    A history that was not stored by run is appended to.
    """
    found = typed(routine_audit(routines, as_of), schemas.ROUTINE_AUDIT)
    spark = routines.sparkSession
    if exists(spark, target) and schemas.RUN not in read_saved(spark, target).columns:
        append_audit(found, target)
    else:
        write_partitions(found.withColumn(schemas.RUN, _run()), target, schemas.RUN)


def _run() -> Column:
    return F.unix_micros(F.col("markedAt").cast("timestamp"))


def read_history(spark: SparkSession, source: str) -> DataFrame:
    """All runs of a stored history, in the columns of an audit."""
    return read_saved(spark, source).select(*schemas.ROUTINE_AUDIT.names)


def mark_removed_in_runs(spark: SparkSession, target: str, plan: DataFrame) -> list[int]:
    """Mark the rows that a stored ``plan`` names in a history stored by run; returns the runs.

    Only the runs that the plan names are read and written; the files of all others are not touched.
    There is one run, and one number here, for each time the audit was recorded. Marking again
    changes nothing.
    """
    runs = sorted(r[0] for r in plan.select(_run()).distinct().collect() if r[0] is not None)
    if not runs:
        return runs
    named = read_saved(spark, target).where(F.col(schemas.RUN).isin(runs))
    write_partitions(mark_removed(named, plan), target, schemas.RUN)
    return runs


def mark_removed_in_table(spark: SparkSession, table: str, folder: str, plan: DataFrame) -> str:
    """Mark the rows that ``plan`` names in a stored audit; returns where its rows are.

    ``plan`` is the stored :func:`removal_plan` whose statements have been carried out. Rows that
    were added after it was made are not marked. A history stored by run is marked run by run; any
    other one is written anew, as the table's next version under ``folder``.
    """
    stored = read_saved(spark, table)
    if schemas.RUN in stored.columns:
        mark_removed_in_runs(spark, table, plan)
        return table
    return publish_version(mark_removed(stored, plan), table, folder)
