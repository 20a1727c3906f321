"""Date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from titlematch.functions._col import as_col


def year_of(c: Column | str) -> Column:
    """Calendar year of a date string/date/timestamp; unparseable -> NULL."""
    return F.year(as_col(c).try_cast("date"))


def year_string(c: Column | str) -> Column:
    """Year as a string (the join key type on both sides); NULL stays NULL."""
    return year_of(c).cast("string")
