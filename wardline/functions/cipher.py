"""Encryption of columns with a key that never appears in a query plan.

The key is read by a scalar subquery over a key table ``(scope, key, secret)``. Spark runs it
once, refuses more than one row, and hands the single value to the tasks; the plan names only
the subquery. Access to the key table's files must be restricted.

Ciphertext is salted at random, so equal values encrypt differently. Spark takes the
expression for deterministic all the same and may compute it twice: write an encrypted frame
before using it more than once, and never join or group by ciphertext.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Key lengths of the cipher, in bytes.
KEY_LENGTHS = (16, 24, 32)


def secret(keys: DataFrame, scope: str, key: str) -> Column:
    """The one secret stored under ``(scope, key)``; it fails if there is none, or no fit."""
    stored = F.max("secret")
    return (
        keys.filter((F.col("scope") == scope) & (F.col("key") == key))
        .agg(
            F.when(
                F.count(F.lit(1)) != 1,
                F.raise_error(F.lit(f"expected one secret for {scope}/{key}")),
            )
            .when(
                F.coalesce(F.octet_length(stored), F.lit(0)).isin(*KEY_LENGTHS), stored
            )
            .otherwise(F.raise_error(F.lit(f"secret {scope}/{key} has no usable length")))
            .alias("secret")
        )
        .scalar()
    )


def encrypted(column: str, key: Column) -> Column:
    """Ciphertext as one line of base64; Spark itself breaks lines after 76 characters."""
    encoded = F.base64(
        F.aes_encrypt(F.col(column).cast("string").cast("binary"), key.cast("binary"))
    )
    return F.replace(encoded, F.lit("\r\n"), F.lit(""))


def decrypted(column: str, key: Column, tolerant: bool = False) -> Column:
    """Plain text; with ``tolerant`` a value that does not decrypt becomes NULL."""
    decrypt = F.try_aes_decrypt if tolerant else F.aes_decrypt
    return decrypt(F.unbase64(F.col(column)), key.cast("binary")).cast("string")


def encrypt_columns(
    df: DataFrame, columns: Iterable[str], keys: DataFrame, scope: str, key: str
) -> DataFrame:
    """Replace the named columns by their ciphertext and keep the others."""
    return df.withColumns({name: encrypted(name, secret(keys, scope, key)) for name in columns})


def decrypt_columns(
    df: DataFrame,
    columns: Iterable[str] | Mapping[str, str],
    keys: DataFrame,
    scope: str,
    key: str,
    tolerant: bool = False,
) -> DataFrame:
    """Replace the named columns by their plain text; a mapping also renames them."""
    names = dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}
    return df.select(
        *[
            decrypted(name, secret(keys, scope, key), tolerant).alias(names[name])
            if name in names
            else F.col(name)
            for name in df.columns
        ]
    )


def text_literal(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_cipher_functions(
    spark: SparkSession,
    key_view: str,
    scope: str,
    key: str,
    encrypt_name: str = "encrypt_value",
    decrypt_name: str = "decrypt_value",
    temporary: bool = True,
) -> None:
    """Create or replace SQL functions for encrypting and decrypting a string.

    Both are inlined into the calling query, with the key as a subquery over ``key_view``.
    They last as long as the session, or stay in the catalog unless ``temporary``; the latter
    needs a stored key table rather than a temporary view.
    """
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    lengths = ", ".join(str(length) for length in KEY_LENGTHS)
    stored = f"""(
        SELECT CASE WHEN count(*) = 1 AND octet_length(max(secret)) IN ({lengths})
                    THEN max(secret)
                    ELSE raise_error({text_literal(f"no usable secret for {scope}/{key}")}) END
        FROM {key_view} WHERE scope = {text_literal(scope)} AND key = {text_literal(key)})"""
    for name, body in (
        (encrypt_name, f"replace(base64(aes_encrypt(value, {stored})), chr(13) || chr(10), '')"),
        (decrypt_name, f"cast(aes_decrypt(unbase64(value), {stored}) AS STRING)"),
    ):
        spark.sql(
            f"CREATE OR REPLACE {kind} {name}(value STRING)"
            f" RETURNS STRING RETURN {body}"
        )
