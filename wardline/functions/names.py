"""Dotted securable names and the type they imply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.constants import CATALOG, SCHEMA, TABLE


# A part in backticks, where two stand for one, or a part without a dot. Neither gives back
# what it has matched, so a dot in backticks never parts a name.
QUOTED = "`(?!`(?!`))[^`]*+(?:``[^`]*+)*+`"
PART = rf"(?>{QUOTED}(?=\.|$)|[^.]+)"


def identifier(*parts: str) -> Column:
    """Name parts joined with dots; a NULL part is left out.

    A part with a dot in it, or a backtick in front, is put in backticks, so that the parts can be
    told apart again: ``a.b`` and ``c`` make another name than ``a`` and ``b.c``. All other
    names are as they are written.
    """

    def told_apart(part: str) -> Column:
        name = F.col(part)
        quoted = F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
        return F.when(name.contains(".") | name.startswith("`"), quoted).otherwise(name)

    return F.concat_ws(".", *[told_apart(part) for part in parts])


def _written_part(name: str, position: int) -> Column:
    leading = rf"{PART}\." * (position - 1)
    return F.regexp_extract(name, f"^{leading}({PART})", 1)


def name_part(name: str, position: int) -> Column:
    """Part 1, 2 or 3 of a dotted name, or an empty string where there is none.

    A part in backticks is given without them. Backticks that are not closed at the end of a part
    are characters like any other.
    """
    part = _written_part(name, position)
    inner = F.replace(part.substr(F.lit(2), F.length(part) - 2), F.lit("``"), F.lit("`"))
    return F.when(part.rlike(f"^{QUOTED}$"), inner).otherwise(part)


def securable_type(name: str) -> Column:
    """Type implied by the number of parts; more than three parts still mean a table."""
    return (
        F.when(_written_part(name, 3) != "", F.lit(TABLE))
        .when(_written_part(name, 2) != "", F.lit(SCHEMA))
        .otherwise(F.lit(CATALOG))
    )


def quoted_identifier(*parts: str) -> Column:
    """Like :func:`identifier`, with every part in backticks for use in a statement."""
    return F.concat_ws(
        ".",
        *[
            F.concat(F.lit("`"), F.replace(F.col(part), F.lit("`"), F.lit("``")), F.lit("`"))
            for part in parts
        ],
    )
