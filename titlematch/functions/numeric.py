"""Number parsing and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from titlematch.functions._col import as_col

# Blanks and control characters around a number are trimmed, a fraction is cut.
_LONG = r"^[\x00-\x20]*(?=[+-]?[0-9.])([+-]?[0-9]*)(?:\.[0-9]*)?[\x00-\x20]*\z"


def to_long(c: Column | str) -> Column:
    """String -> bigint with the non-ANSI cast's results under ANSI mode.

    ``'12'`` -> 12, ``' 7 '`` -> 7, ``'12.9'`` -> 12 (truncated, never
    rounded), ``'.5'`` -> 0; ``'n/a'``, ``'1e3'``, blanks and values out of
    range -> NULL.  The integer part is taken as text, so no digit is lost to
    a decimal on the way.
    """
    text = as_col(c).cast("string")
    number = F.regexp_extract(text, _LONG, 1)
    # without digits before the point the value is 0
    whole = F.when(number.isin("", "+", "-"), F.lit("0")).otherwise(number)
    return F.when(text.rlike(_LONG), whole.try_cast("bigint"))


def ratio(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """``round(numerator / denominator, digits)`` as double, HALF_UP.

    Division by zero gives NULL under ``try_divide``; the job filters zero
    budgets out before it gets here anyway.
    """
    return F.round(F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double")), digits)
