"""Publishing a table with encrypted columns, reading it back in plain text, and replacing its key.

A table under a key with versions is stored by batch, a partition for each publication. Replacing the
key rewrites the batches that still hold an older version, and no file of any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import key_versions
from wardline.functions.cipher import decrypt_columns, encrypt_columns
from wardline.sinks.tables import save, write_partitions
from wardline.sources.tables import read_saved


def publish_encrypted(
    df: DataFrame, columns: Iterable[str], keys: DataFrame, scope: str, key: str, target: str
) -> None:
    """Write ``df`` with the named columns encrypted; fails if the target exists.

    Readers get the written ciphertext, never a frame that would encrypt anew.
    """
    save(encrypt_columns(df, columns, keys, scope, key), target, "errorifexists")


def read_decrypted(
    spark: SparkSession,
    source: str,
    columns: Iterable[str] | Mapping[str, str],
    keys: DataFrame,
    scope: str,
    key: str,
    tolerant: bool = False,
) -> DataFrame:
    """A published table in plain text, for a reader who may read the key table."""
    return decrypt_columns(read_saved(spark, source), columns, keys, scope, key, tolerant)


BATCH = "batch"


def publish_batch(
    df: DataFrame,
    columns: Iterable[str],
    keys: DataFrame,
    scope: str,
    key: str,
    target: str,
    batch: int,
) -> None:
    """Write ``df`` as one batch of a table, encrypted under the newest version of the key.

    Publishing a batch again replaces it, so a run that died is started again. ``df`` must not
    have a column ``batch``.
    """
    hidden = key_versions.encrypt_columns(df, columns, keys, scope, key)
    write_partitions(hidden.withColumn(BATCH, F.lit(batch).cast("long")), target, BATCH)


def read_batches(
    spark: SparkSession,
    source: str,
    columns: Iterable[str] | Mapping[str, str],
    keys: DataFrame,
    scope: str,
    key: str,
    tolerant: bool = False,
) -> DataFrame:
    """All batches of a table in plain text, whatever versions of the key they hold."""
    stored = read_saved(spark, source).drop(BATCH)
    return key_versions.decrypt_columns(stored, columns, keys, scope, key, tolerant)


def outdated_batches(
    spark: SparkSession, source: str, columns: Iterable[str], newest: int
) -> list[int]:
    """The batches that hold a value of another version than ``newest``; one number a publication.

    Versions stand in front of the values, so the files of a batch that has only the newest one are
    passed over by what their footers say about the column.
    """
    older = [~F.col(c).startswith(f"v{newest}:") for c in columns]
    found = read_saved(spark, source).where(reduce(lambda a, b: a | b, older))
    return sorted(row[0] for row in found.select(BATCH).distinct().collect())


def rotate_key(
    spark: SparkSession, target: str, columns: Iterable[str], keys: DataFrame, scope: str, key: str
) -> list[int]:
    """Move a table to the newest version of its key; returns the batches that were written anew.

    In those, values that have the newest version stay byte for byte. A run that died is started
    again and goes on with the batches that are left. Keep the older versions' secrets until it
    returns an empty list, and only one job at a time may write to the table.
    """
    columns = list(columns)
    batches = outdated_batches(spark, target, columns, key_versions.newest_version(keys, scope, key))
    if batches:
        stored = read_saved(spark, target).where(F.col(BATCH).isin(batches))
        write_partitions(
            key_versions.reencrypt_columns(stored, columns, keys, scope, key), target, BATCH
        )
    return batches
