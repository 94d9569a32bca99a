"""Encryption under a key that is replaced from time to time.

Keys are rows ``(scope, key, version, secret)``; the newest version of a key encrypts. A value is
stored as ``v<version>:<base64>``, so a reader finds the secret of each value by a join on its
version, and rows of several versions are read at once. Scope, key and version are authenticated
with the value: a value whose version is changed by hand, or that was encrypted under another key,
does not decrypt. NULL stays NULL.

As in :mod:`wardline.functions.cipher`, ciphertext is salted, secrets are in no plan text, and an
encrypted frame must be written before it is used more than once. Values stored without a version
are not read here.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.cipher import KEY_LENGTHS, text_literal

# A version and what it has encrypted.
SEALED = "^v([0-9]+):([A-Za-z0-9+/=]+)$"


def versions(keys: DataFrame, scope: str, key: str) -> DataFrame:
    """``(version, secret)``, one row a version of the key; an unusable version has no secret.

    A version is unusable if it is stored twice or its secret has no length of the cipher. That is
    an error for a value that needs it, and for no other.
    """
    stored = F.max("secret")
    fits = (F.count(F.lit(1)) == 1) & F.octet_length(stored).isin(*KEY_LENGTHS)
    own = keys.filter((F.col("scope") == scope) & (F.col("key") == key) & F.col("version").isNotNull())
    return own.groupBy(F.col("version").cast("long").alias("version")).agg(
        F.when(fits, stored).alias("secret")
    )


def newest(keys: DataFrame, scope: str, key: str) -> Column:
    """The version that encrypts, as a struct; looked up once."""
    latest = F.max(F.struct("version", "secret"))
    problem = F.raise_error(F.lit(f"no usable newest version of {scope}/{key}"))
    checked = F.when(latest["secret"].isNotNull(), latest).otherwise(problem)
    return versions(keys, scope, key).agg(checked.alias("newest")).scalar()


def newest_version(keys: DataFrame, scope: str, key: str) -> int:
    """The number of the version that encrypts."""
    return keys.sparkSession.range(1).select(newest(keys, scope, key)["version"]).first()[0]


def version_of(column: str) -> Column:
    """The version a stored value names; 0 if it names none, NULL for NULL."""
    number = F.regexp_extract(F.col(column), SEALED, 1)
    return F.coalesce(number.try_cast("long"), F.when(F.col(column).isNotNull(), F.lit(0)))


def _bound_to(scope: str, key: str, version: Column) -> Column:
    own = F.lit(json.dumps([scope, key], ensure_ascii=False))
    return F.concat(own, version.cast("string")).cast("binary")


def sealed(value: Column, scope: str, key: str, version: Column, secret: Column) -> Column:
    """``value`` encrypted under one version, with the version in front."""
    hidden = F.aes_encrypt(
        value.cast("string").cast("binary"),
        secret.cast("binary"),
        F.lit("GCM"),
        F.lit("DEFAULT"),
        F.lit("").cast("binary"),
        _bound_to(scope, key, version),
    )
    line = F.replace(F.base64(hidden), F.lit("\r\n"), F.lit(""))
    return F.concat(F.lit("v"), version.cast("string"), F.lit(":"), line)


def _opened(
    column: str, scope: str, key: str, version: Column, secret: Column, tolerant: bool
) -> Column:
    decrypt = F.try_aes_decrypt if tolerant else F.aes_decrypt
    hidden = F.unbase64(F.regexp_extract(F.col(column), SEALED, 2))
    bound = _bound_to(scope, key, version)
    shown = decrypt(hidden, secret.cast("binary"), F.lit("GCM"), F.lit("DEFAULT"), bound)
    found = F.when(secret.isNotNull(), shown.cast("string"))
    if tolerant:
        return found
    problem = F.concat(F.lit(f"no usable version of {scope}/{key}: "), version_of(column))
    return found.when(F.col(column).isNotNull(), F.raise_error(problem))


def encrypt_columns(
    df: DataFrame, columns: Iterable[str], keys: DataFrame, scope: str, key: str
) -> DataFrame:
    """Replace the named columns by ciphertext of the newest version and keep the others."""
    latest = newest(keys, scope, key)
    return df.withColumns(
        {c: sealed(F.col(c), scope, key, latest["version"], latest["secret"]) for c in columns}
    )


def _with_secrets(
    df: DataFrame, columns: Iterable[str], keys: DataFrame, scope: str, key: str
) -> DataFrame:
    """``df`` with the version and the secret of each named column's value.

    A version has one row, so rows do not multiply. The key side is broadcast if Spark measures
    it to be small; else the rows are on the preserved side, where a frequent version is split.
    """
    known = versions(keys, scope, key)
    for column in columns:
        own = known.select(
            F.col("version").alias(f"__version_{column}"), F.col("secret").alias(f"__secret_{column}")
        )
        df = df.join(own, version_of(column) == F.col(f"__version_{column}"), "left")
    return df


def decrypt_columns(
    df: DataFrame,
    columns: Iterable[str] | Mapping[str, str],
    keys: DataFrame,
    scope: str,
    key: str,
    tolerant: bool = False,
) -> DataFrame:
    """Replace the named columns by plain text, whatever version each value has; a mapping renames.

    A value that does not decrypt, or whose version is missing, is an error; with ``tolerant`` it
    becomes NULL.
    """
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    joined = _with_secrets(df, names, keys, scope, key)

    def shown(c: str) -> Column:
        version, secret = F.col(f"__version_{c}"), F.col(f"__secret_{c}")
        return _opened(c, scope, key, version, secret, tolerant).alias(names[c])

    return joined.select(*[shown(c) if c in names else F.col(c) for c in df.columns])


def reencrypt_columns(
    df: DataFrame, columns: Iterable[str], keys: DataFrame, scope: str, key: str
) -> DataFrame:
    """Values of older versions under the newest one; values that have it stay byte for byte."""
    columns = list(columns)
    latest = newest(keys, scope, key)
    joined = _with_secrets(df, columns, keys, scope, key)

    def renewed(c: str) -> Column:
        version, secret = F.col(f"__version_{c}"), F.col(f"__secret_{c}")
        plain = _opened(c, scope, key, version, secret, False)
        moved = sealed(plain, scope, key, latest["version"], latest["secret"])
        return F.when(version_of(c) == latest["version"], F.col(c)).otherwise(moved).alias(c)

    return joined.select(*[renewed(c) if c in columns else F.col(c) for c in df.columns])


def register_cipher_functions(
    spark: SparkSession,
    key_view: str,
    scope: str,
    key: str,
    encrypt_name: str = "encrypt_value",
    decrypt_name: str = "decrypt_value",
    temporary: bool = True,
) -> None:
    """Create or replace SQL functions that encrypt by the newest version and decrypt any.

    The versions of the one key are a subquery over ``key_view``, which is run once; there are as many
    as the key was replaced times.
    """
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    lengths = ", ".join(str(length) for length in KEY_LENGTHS)
    own = text_literal(json.dumps([scope, key], ensure_ascii=False))
    usable = f"""SELECT CAST(version AS BIGINT) AS version,
        CASE WHEN count(*) = 1 AND octet_length(max(secret)) IN ({lengths}) THEN max(secret) END AS secret
        FROM {key_view}
        WHERE scope = {text_literal(scope)} AND key = {text_literal(key)} AND version IS NOT NULL
        GROUP BY 1"""
    latest = f"(SELECT max(struct(version, secret)) FROM ({usable}))"
    all_of_them = f"(SELECT map_from_entries(collect_list(struct(version, secret))) FROM ({usable}))"
    problem = f"raise_error({text_literal(f'no usable version of {scope}/{key}')})"
    number = f"try_cast(regexp_extract(value, '{SEALED}', 1) AS BIGINT)"
    hide = f"""concat('v', {latest}.version, ':', replace(base64(aes_encrypt(value,
        coalesce({latest}.secret, {problem}), 'GCM', 'DEFAULT', '',
        concat({own}, {latest}.version))), chr(13) || chr(10), ''))"""
    show = f"""cast(aes_decrypt(unbase64(regexp_extract(value, '{SEALED}', 2)),
        CASE WHEN value IS NOT NULL THEN coalesce(try_element_at({all_of_them}, {number}), {problem}) END,
        'GCM', 'DEFAULT', concat({own}, {number})) AS STRING)"""
    for name, body in ((encrypt_name, hide), (decrypt_name, show)):
        spark.sql(f"CREATE OR REPLACE {kind} {name}(value STRING) RETURNS STRING RETURN {body}")
