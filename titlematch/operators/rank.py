"""Ordering, top-k, explode and distinct-value operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlematch.staging import staged

#: Rows of a partition are numbered in the low bits of a generated id.
_PLACE_BITS = 33
#: Bins of a round of ``top_k_wide``, and its most rounds.
_BINS, _ROUNDS = 4096, 12


def _order(by: str | Column, ascending: bool) -> Column:
    c = F.col(by) if isinstance(by, str) else by
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def _tie(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def sort_by(
    df: DataFrame, by: str | Column, ascending: bool = False, tie_breakers: Sequence[str | Column] = ()
) -> DataFrame:
    """Global sort: ``by`` (DESC NULLS LAST by default), then ascending tie-breakers."""
    return df.orderBy(_order(by, ascending), *[_tie(t) for t in tie_breakers])


def top_k(
    df: DataFrame,
    by: str | Column | None,
    n: int | None,
    ascending: bool = False,
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """Sort by ``by`` then keep ``n`` rows.

    ``by=None`` skips the sort; ``n=None`` skips the limit; ``n=0`` gives
    zero rows.  Sort + limit plans as ``TakeOrderedAndProject``: each task
    keeps its own top ``n`` and only those reach the final merge, so no
    global sort of the input happens.  Pass tie-breakers that make the order
    total when the exact row set at the cut matters.
    """
    if n is not None and n < 0:
        raise ValueError("n must be >= 0")
    out = sort_by(df, by, ascending, tie_breakers) if by is not None else df
    return out.limit(n) if n is not None else out


def explode_column(df: DataFrame, column: str, suffix: str = "_exploded") -> DataFrame:
    """All columns plus one row per element of ``column`` as ``<column>_exploded``.

    The array column itself is dropped.  NULL and empty arrays produce no
    row (``explode``, not ``explode_outer``).
    """
    out = f"{column}{suffix}"
    return df.select("*", F.explode(F.col(column)).alias(out)).drop(column)


def top_exploded(
    df: DataFrame,
    column: str,
    by: str,
    n: int,
    ascending: bool = False,
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """Explode ``column`` and keep the top ``n`` exploded rows by ``by``.

    ``n`` counts exploded rows, not distinct values.
    """
    return top_k(explode_column(df, column), by, n, ascending, tie_breakers)


def distinct_values(df: DataFrame, column: str, order: Sequence[str | tuple[str, str]] | None = None) -> DataFrame:
    """Distinct values of ``column``.

    With ``order`` (column names; ``(name, "desc")`` for a number from high to
    low, NULLs last) the values come sorted by their first appearance under that
    order, which must be total for a definite result.  ``first_seen`` holds the
    sort key of that appearance.  The input is only aggregated: a partial
    minimum of the sort key per value, so hot values collapse map-side, and
    then a sort of the distinct values alone.
    """
    if not order:
        return df.select(column).distinct()
    parts = []
    for i, by in enumerate(order):
        name, descending = (by, False) if isinstance(by, str) else (by[0], by[1] == "desc")
        if descending and not isinstance(df.schema[name].dataType, T.NumericType):
            raise ValueError(f"only numbers can be ordered descending: {name}")
        # a struct compares field by field, NULL first
        parts += [F.col(name).isNull().alias(f"n{i}"), (-F.col(name)).alias(f"k{i}")] if descending else [F.col(name).alias(f"k{i}")]
    return df.groupBy(column).agg(F.min(F.struct(*parts)).alias("first_seen")).orderBy("first_seen")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number", partitions: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) in the global order ``order``.

    No window over all rows: the rows are dealt to partitions by range, sorted
    there and staged with their place in the partition; a partition's first
    place is the sum of the row counts before it (a row a partition, broadcast).
    ``order`` should be total; the numbers of rows equal in it are not defined,
    and such rows share a partition.  ``df`` is read twice (range bounds, rows).
    """
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = staged(dealt.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("__at", _PLACE_BITS)
    counts = sorted(tuple(r) for r in rows.groupBy(part.alias("p")).count().collect())
    before, first = 0, []
    for p, n in counts:
        first.append((p, before))
        before += n
    firsts = df.sparkSession.createDataFrame(first, "__part long, __before long")
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    joined = rows.join(F.broadcast(firsts), part == F.col("__part"))
    return joined.select(*df.columns, place.alias(name))


def _threshold(keys: DataFrame, n: int) -> float | None:
    """A value that at least ``n`` of the keys ``r`` (doubles) reach, and not many
    more than ``n`` where the keys tell them apart; None if all rows pass.

    A round counts the keys in equal bins between two values, and the next one
    looks into the bin in which the n-th key lies.  A round returns one row a bin."""
    finite = (F.col("r") > float("-inf")) & (F.col("r") < float("inf"))
    total, above, lo, hi = keys.agg(
        F.count(F.lit(1)),
        F.count(F.when(F.col("r") == float("inf"), 1)),
        F.min(F.when(finite, F.col("r"))),
        F.max(F.when(finite, F.col("r"))),
    ).first()
    if n >= total:
        return None
    if n <= above:
        return float("inf")
    if lo is None:
        return None
    found = None
    for _ in range(_ROUNDS):
        width = hi / _BINS - lo / _BINS
        place = F.least(F.floor((F.col("r") - lo) / width), F.lit(_BINS - 1)) if width > 0 else F.lit(0)
        inside = keys.filter((F.col("r") >= lo) & (F.col("r") <= hi)).groupBy(place.cast("int").alias("bin"))
        bins = inside.agg(F.count(F.lit(1)), F.min("r"), F.max("r")).collect()
        passing = above
        for _, count, low, high in sorted(bins, reverse=True):
            passing += count
            if passing >= n:
                found, above, lo, hi = low, passing - count, low, high
                break
        else:
            return found  # the rest are the lowest keys (-inf)
        if passing <= 2 * n or lo == hi:
            break
    return found


def top_k_wide(
    df: DataFrame, by: str, n: int, ascending: bool = False, tie_breakers: Sequence[str | Column] = ()
) -> DataFrame:
    """``top_k`` for an ``n`` that one task should not hold, sorted the same way.

    A threshold of the numeric key is found by histograms; only rows that reach
    it are sorted, by range over many tasks, and numbered.  Rows equal in key and
    tie-breakers are interchangeable.  ``df`` is read once a round, by its key
    column, so pass a staged table.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    if not isinstance(df.schema[by].dataType, T.NumericType):
        raise ValueError(f"the key of top_k_wide must be a number: {by}")
    key = F.col(by).cast("double")
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    # the order's value: NULLs are last going down and first going up, NaN is above all numbers
    if ascending:
        r = F.when(key.isNull(), high).when(F.isnan(key), low).otherwise(-key)
    else:
        r = F.when(key.isNull(), low).when(F.isnan(key), high).otherwise(key)
    if n == 0:
        return df.limit(0)
    least = _threshold(df.select(r.alias("r")), n)
    passing = df if least is None else df.filter(r >= F.lit(least))
    order = [_order(by, ascending), *[_tie(t) for t in tie_breakers]]
    return numbered(passing, order, "__number").filter(F.col("__number") <= n).orderBy("__number").drop("__number")
