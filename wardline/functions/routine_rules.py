"""Rules a registered routine's definition must keep, as native regular expressions.

Word characters are letters and numbers of any script and the underscore, spelled out so
that the verdict does not depend on how the JVM reads ``\\w`` and ``\\b``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.constants import (
    ALLOWED_KEYS,
    BANNED_FUNCTIONS,
    INVALID_FUNCTION,
    INVALID_SECRET,
    VALID_FUNCTION,
    VALID_SECRET,
)

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
# Fixed value: the form of a call whose scope and key are checked.
SECRET_CALL = rf"secret\((['\"])({WORD}+)\1,{SPACE}*(['\"])({WORD}+)\3\)"


def function_validity(
    definition: str, banned: Iterable[str] = BANNED_FUNCTIONS, ignore_case: bool = False
) -> Column:
    """Invalid if a banned function name occurs as a whole word; NULL stays NULL.

    Most places of a text are ruled out by their first character alone, which is far cheaper
    to test than what precedes them.
    """
    banned = list(banned)
    text = F.col(definition)
    if not banned:
        return F.when(text.isNotNull(), F.lit(VALID_FUNCTION))
    names = "|".join(re.escape(name) for name in banned)
    initials = "".join(sorted({re.escape(name[0]) for name in banned}))
    flag = "(?iu)" if ignore_case else ""
    found = text.rlike(rf"{flag}(?=[{initials}])(?<!{WORD})(?:{names})(?!{WORD})")
    return F.when(found, F.lit(INVALID_FUNCTION)).when(text.isNotNull(), F.lit(VALID_FUNCTION))


def secret_validity(
    definition: str, allowed: Mapping[str, Iterable[str]] = ALLOWED_KEYS
) -> Column:
    """Valid if the first ``secret('scope', 'key')`` call names an allowed key; NULL stays NULL.

    The text is searched once; the scope and key are then taken from the short match. A word
    has no dot in it, so ``scope.key`` stands for the pair without doubt.
    """
    text = F.col(definition)
    call = F.regexp_extract(text, SECRET_CALL, 0)
    pair = F.regexp_replace(call, SECRET_CALL, "$2.$4")
    pairs = [f"{scope}.{key}" for scope, keys in allowed.items() for key in keys]
    known = pair.isin(pairs) if pairs else F.lit(False)
    return F.when(known, F.lit(VALID_SECRET)).when(text.isNotNull(), F.lit(INVALID_SECRET))
