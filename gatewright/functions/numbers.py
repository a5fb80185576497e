"""Numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column) -> Column:
    """The text as a double, null where it is no number.

    Java also parses a trailing d or f as a type suffix; that is not a number here.
    """
    suffixed = text.rlike(r"[dDfF]\s*\z") & ~F.lower(F.trim(text)).rlike(r"\A[+-]?inf\z")
    return F.when(~suffixed, text.try_cast("double"))
