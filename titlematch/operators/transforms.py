"""Projection, cast and filter operators (``DataFrame -> DataFrame``)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlematch import columns as C
from titlematch.functions import clean_title, names_of, parse_json, ratio, to_long, year_of


def subset(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns, in list order."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by ``{old: new}``; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def _cast_one(c: Column, target: T.DataType | str) -> Column:
    if isinstance(target, (T.ArrayType, T.StructType, T.MapType)):
        return parse_json(c, target)
    name = target if isinstance(target, str) else target.simpleString()
    if name in ("long", "bigint"):
        return to_long(c)
    return c.try_cast(name)


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Typed cast per column; a bad value becomes NULL instead of failing.

    Nested types (arrays/structs/maps) are parsed from JSON text, ``long``
    keeps the legacy truncation of fractional strings, everything else is a
    ``try_cast``.  One projection, so Catalyst sees a single Project.
    """
    return df.withColumns({name: _cast_one(F.col(name), t) for name, t in types.items()})


def filter_all(df: DataFrame, conditions: Mapping[str, Column] | Iterable[Column]) -> DataFrame:
    """AND of all conditions (names in a mapping are labels only).

    Emitted as one conjunction so the whole predicate can reach the scan.
    """
    conds = list(conditions.values()) if isinstance(conditions, Mapping) else list(conditions)
    if not conds:
        return df
    return df.filter(reduce(lambda a, b: a & b, conds))


def pluck(df: DataFrame, cols: Iterable[str], field: str = "name") -> DataFrame:
    """Replace each array-of-struct column by the array of one field."""
    return df.withColumns({c: names_of(c, field) for c in cols})


def add_year(df: DataFrame, date_col: str = C.RELEASE_DATE, out: str = C.YEAR, drop_source: bool = True) -> DataFrame:
    """Integer year of a date column; the source column is dropped by default."""
    df = df.withColumn(out, year_of(date_col))
    return df.drop(date_col) if drop_source and date_col != out else df


def add_ratio(
    df: DataFrame,
    numerator: str = C.REVENUE,
    denominator: str = C.BUDGET,
    out: str = C.REVENUE_TO_BUDGET,
    digits: int = 2,
) -> DataFrame:
    """``out = round(numerator / denominator, digits)`` as double."""
    return df.withColumn(out, ratio(numerator, denominator, digits))


def add_cleaned_title(df: DataFrame, source: str = C.TITLE, out: str = C.CLEANED_TITLE) -> DataFrame:
    """Movie-side join key: ``lower(trim(title))``."""
    return df.withColumn(out, clean_title(source))


def repartition_by(df: DataFrame, column: str, enabled: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Hash-repartition by ``column`` when enabled (results are unchanged).

    Off by default: the joins that follow already place exactly one
    exchange per side on their keys, and AQE coalesces or splits the
    resulting partitions at run time.  An explicit repartition here only
    adds a shuffle on a coarser key.
    """
    if not enabled:
        return df
    return df.repartition(num_partitions, column) if num_partitions else df.repartition(column)
