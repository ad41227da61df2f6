"""Turning XML text into typed values. All of it runs inside the JVM.

The conversions exist as SQL, for use in larger expressions, and as column functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of a number and of a UTC instant. They end at the very
# end of the text (``$`` would allow a line end after it).
NUMBER = r"^[+-]?[0-9]+\z"
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?Z\z"


def number_sql(text: str, kind: str) -> str:
    """A number of the given type, or NULL for anything but an optional sign and digits that fit.

    The pattern matters: a plain cast would accept surrounding blanks.
    """
    number = f"try_cast({text} AS {kind})"
    # Digits as a number is written itself need no look at the pattern.
    return f"(CASE WHEN CAST({number} AS STRING) = {text} OR {text} RLIKE r'{NUMBER}' THEN {number} END)"


def instant_sql(text: str) -> str:
    """UTC instant cut to whole seconds, as TIMESTAMP_NTZ; independent of the session time zone.

    Years have four digits, hours run to 23 and seconds to 59: midnight written as 24:00:00 and
    leap seconds, which dumps do not contain, count as unreadable.
    """
    seconds = f"try_cast(substring({text}, 1, 19) AS TIMESTAMP_NTZ)"
    return f"(CASE WHEN {text} RLIKE r'{INSTANT}' THEN {seconds} END)"


def strict_long(text: str) -> Column:
    """Column ``text`` as BIGINT, see :func:`number_sql`."""
    return F.expr(number_sql(text, "BIGINT"))


def strict_short(text: str) -> Column:
    """Column ``text`` as SMALLINT, see :func:`number_sql`."""
    return F.expr(number_sql(text, "SMALLINT"))


def instant_seconds(text: str) -> Column:
    """Column ``text`` as TIMESTAMP_NTZ, see :func:`instant_sql`."""
    return F.expr(instant_sql(text))


def last_filled(values: str) -> Column:
    """Last non-empty string of an array; NULL when there is none (an empty tag is a missing one)."""
    return F.expr(f"try_element_at(array_remove({values}, ''), -1)")
