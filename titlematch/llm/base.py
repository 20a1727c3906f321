"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlematch.staging import new_folder, shared_dir, staged

__all__ = ["few", "fold_ascii", "looked_up", "new_folder", "shared_dir", "staged", "table", "text_of", "word_count"]

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of keys that are broadcast; more are joined by a shuffle.
FEW_KEYS = 1_000_000


def few(keys: DataFrame) -> DataFrame:
    """Narrow keys for the small side of a semi or anti join: broadcast if a count
    shows that they are few, else as they are."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


#: A key of more rows than this is looked up by a broadcast.
HOT_ROWS = 1000


def looked_up(rows: DataFrame, on: list[str], known: DataFrame, count: str, value: str, spread: Column) -> DataFrame:
    """``rows`` with ``value`` of the row of ``known`` that has their key, null
    where none has or a part of the key is null.  ``known`` has a row a key, ``count`` says how many rows may
    ask for it, and ``value`` is not null there.  Keys of many rows are broadcast
    (at most a ``HOT_ROWS``-th of the rows, and only if a count shows them few);
    their rows, and those without a key, go through the second join under
    ``spread``, over all tasks."""

    def side(part: DataFrame, name: str) -> DataFrame:
        return part.select(*[F.col(k).alias(f"__{name}_{k}") for k in on], F.col(value).alias(f"__{name}"))

    hot = few(side(known.filter(F.col(count) > HOT_ROWS), "hot"))
    cold = side(known.filter(F.col(count) <= HOT_ROWS), "cold").withColumn("__at", F.lit(0).cast("long"))
    first = rows.join(hot, [F.col(k) == F.col(f"__hot_{k}") for k in on], "left")
    found = reduce(lambda a, b: a | b, [F.col("__hot").isNotNull(), *[F.col(k).isNull() for k in on]])
    asked = first.withColumn("__spread", F.when(found, spread.cast("long")).otherwise(0))
    for k in on:
        asked = asked.withColumn(f"__ask_{k}", F.when(~found, F.col(k)))
    same = [F.col(f"__ask_{k}") == F.col(f"__cold_{k}") for k in on] + [F.col("__spread") == F.col("__at")]
    both = asked.join(cold, same, "left")
    return both.select(*[c for c in rows.columns if c != value], F.coalesce("__hot", "__cold").alias(value))


def text_of(col: str | Column = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII text (where
    characters and bytes are as many); other text goes through ``translate``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
