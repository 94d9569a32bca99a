"""Routine rules that are rows of tables rather than parts of an expression.

A list of many thousand names would be a regular expression of as many branches, tried at every
place of every text. Here each distinct definition is split into its words once, and the words are
joined with the rules. The verdicts are those of :mod:`wardline.functions.routine_rules`.

Verdicts depend on the definition alone, so they are found once for each distinct one and joined
back by a hash of it. A word or a definition that occurs very often has one row on the other side of
its join, where Spark can split it; rules are broadcast only if Spark measures them to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.constants import INVALID_FUNCTION, INVALID_SECRET, VALID_FUNCTION, VALID_SECRET
from wardline.functions.routine_rules import SECRET_CALL, WORD


def _words(text: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(f"({WORD}+)"), F.lit(1)))


def _longest(words: Column) -> Column:
    """The longest of some words, the first if several are."""
    return F.reduce(
        words, F.lit(""), lambda a, b: F.when(F.length(b) > F.length(a), b).otherwise(a)
    )


def name_rules(banned: DataFrame, name: str = "name") -> DataFrame:
    """``(word, name)`` of every distinct banned name: the word by which it is looked up.

    That is the longest word in it, itself as a rule. A name without a word is an error, since
    nothing could look it up; NULL is no name.
    """
    word = _longest(_words("name"))
    problem = F.raise_error(F.concat(F.lit("a banned name without a word: "), F.col("name")))
    return (
        banned.select(F.col(name).alias("name"))
        .where("name IS NOT NULL")
        .distinct()
        .select(F.when(word != "", word).otherwise(problem).alias("word"), "name")
    )


def _literal(name: str) -> Column:
    r"""A regular expression of a name: ``\Q…\E``, with any ``\E`` in it taken out of the quotes."""
    return F.concat(F.lit(r"\Q"), F.replace(F.col(name), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def banned_calls(
    routines: DataFrame, banned: DataFrame, definition: str = "routine_definition", name: str = "name"
) -> DataFrame:
    """``(definition_key, name)``: which banned names occur as whole words in which definition.

    One row for each distinct pair. Definitions are named by their SHA-256.
    """
    texts = routines.select(
        F.sha2(definition, 256).alias("definition_key"), F.col(definition).alias("definition")
    ).where("definition IS NOT NULL")
    words = texts.dropDuplicates(["definition_key"]).select(
        "definition_key", "definition", F.explode(_words("definition")).alias("found")
    )
    rules = name_rules(banned, name)
    # A name of one word needs no text: that the word occurs says it all.
    plain = rules.where("word = name").select("word", "name")
    phrases = rules.where("word != name")
    hits = words.select("definition_key", "found").join(plain, F.col("found") == F.col("word"))
    whole = F.concat(F.lit(f"(?<!{WORD})"), _literal("name"), F.lit(f"(?!{WORD})"))
    within = words.join(phrases, F.col("found") == F.col("word")).where(
        F.regexp_like(F.col("definition"), whole)
    )
    return hits.select("definition_key", "name").unionByName(
        within.select("definition_key", "name")
    )


def with_function_validity(
    routines: DataFrame,
    banned: DataFrame,
    definition: str = "routine_definition",
    name: str = "name",
    verdict: str = "isFunctionValid",
) -> DataFrame:
    """``routines`` with the verdict of a table of banned names; NULL for a NULL definition."""
    calls = banned_calls(routines, banned, definition, name)
    found = calls.select(F.col("definition_key").alias("__banned")).distinct()
    key = F.sha2(F.col(definition), 256)
    judged = F.when(F.col("__banned").isNotNull(), F.lit(INVALID_FUNCTION)).when(
        F.col(definition).isNotNull(), F.lit(VALID_FUNCTION)
    )
    joined = routines.join(found, key == F.col("__banned"), "left")
    return joined.select(*routines.columns, judged.alias(verdict))


def with_secret_validity(
    routines: DataFrame,
    allowed: DataFrame,
    definition: str = "routine_definition",
    verdict: str = "isSecretValid",
) -> DataFrame:
    """``routines`` with the verdict of a table ``(scope, key)`` of allowed keys; NULL for NULL.

    As in the rule by expression, only the first call of ``secret`` counts.
    """
    known = allowed.select(F.col("scope").alias("__scope"), F.col("key").alias("__key"))
    known = known.where("__scope IS NOT NULL AND __key IS NOT NULL").distinct()
    call = F.regexp_extract(F.col(definition), SECRET_CALL, 0)
    # Neither part of a call that is matched can be empty; no call gives empty parts.
    scope, key = (F.regexp_replace(call, SECRET_CALL, part) for part in ("$2", "$4"))
    judged = F.when(F.col("__scope").isNotNull(), F.lit(VALID_SECRET)).when(
        F.col(definition).isNotNull(), F.lit(INVALID_SECRET)
    )
    joined = routines.join(
        known.where("__scope != '' AND __key != ''"),
        (scope == F.col("__scope")) & (key == F.col("__key")),
        "left",
    )
    return joined.select(*routines.columns, judged.alias(verdict))
