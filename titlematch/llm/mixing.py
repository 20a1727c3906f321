"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash of its id.  For each source the sizes are
summed by the top 12 bits of the hash; the running sum over those 4,096 buckets
finds the one bucket in which the source's budget ends.  Only that bucket is
summed again by the next 12 bits, and so on until it holds a single hash.  The
result is one threshold a source: a document is taken when its hash lies below
it, so documents are filtered and never sorted, and a smaller budget takes a
subset of what a larger one takes.

Rows with one id, or with none, share a hash.  Where several stand at a source's
threshold, they are split in the same way by a hash of the text, and rows that
share that too by their staged row number.

All of it is DataFrame operations.  The running sums go over histogram rows (at
most 4,096 a source) and over one row per source, never over documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlematch.llm.base import WORD, staged, text_of, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at this many times its source's size.
MAX_EPOCHS = 3
HASH_BITS = 60
LEVEL_BITS = 12
#: What documents are told apart by: hash of the id, hash of the text, row number
#: (which has 33 bits and the partition's, below ``HASH_BITS`` in all).
KEYS = ("hash", "digest", "row")


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the id's MD5, as a long (a null id counts as '')."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` -> also ``target``: the whole size shared by
    weight, no target over ``max_epochs`` times its source's size, the excess
    reshared by weight until none is above.  Closed form: with sources ordered
    by cap / weight, the words a unit of weight gets are the largest of
    (size left) / (weight left)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1)
    ranked = (
        totals.withColumn("_rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_weight", weight.cast("long"))
        .withColumn("_cap", max_epochs * F.col("source_size"))
    )
    whole = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy(F.col("_cap") / F.col("_weight"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    weight_left = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    return (
        ranked.withColumn("_level", left.cast("double") / weight_left)
        .withColumn("_level", F.max("_level").over(whole))
        .select("source", "source_size", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")).alias("target"))
    )


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row a source: ``source, source_size, target, full, t_hash, t_digest,
    t_row``.  Each document is taken ``full`` times, and once more if its hash,
    digest and row number are below these three, compared in that order."""
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    zeros = [F.lit(0).cast("long").alias(f"t_{k}") for k in KEYS]
    # _left: budget that remains in the boundary bucket; _open: still to be refined
    state = targets.withColumn("full", full).select(
        "source", "source_size", "target", "full", *zeros, (F.col("target") - F.col("full") * F.col("source_size")).alias("_left"), F.lit(True).alias("_open")
    )
    state = staged(state, "mix-targets")
    for place, key in enumerate(KEYS):
        state = _refined(sizes, state, KEYS[:place], key)
        if key == KEYS[-1] or state.filter("_open").isEmpty():
            break  # no boundary holds several rows
    return state.drop("_left", "_open")


def _refined(sizes: DataFrame, state: DataFrame, above: Sequence[str], key: str) -> DataFrame:
    """``state`` with ``t_<key>`` of the open sources, whose boundary rows have
    the thresholds of the keys ``above``.  Sources stay open where several rows
    share a value at the boundary."""
    # _lower: first value of the boundary bucket
    state = state.withColumn("_lower", F.lit(0).cast("long"))
    shift = HASH_BITS
    while shift > 0:
        width, shift = 1 << shift, shift - LEVEL_BITS
        bounds = state.filter("_open").select(F.col("source").alias("_s"), F.col("_lower").alias("_from"), *[F.col(f"t_{k}").alias(f"_{k}") for k in above])
        inside = (F.col(key) >= F.col("_from")) & (F.col(key) < F.col("_from") + F.lit(width))
        for k in above:
            inside &= F.col(k) == F.col(f"_{k}")
        histogram = (
            sizes.filter("size > 0")
            .join(bounds, F.col("source").eqNullSafe(F.col("_s")) & inside)
            .groupBy("_s", F.shiftright(F.col(key) - F.col("_from"), shift).alias("_bucket"))
            .agg(F.sum("size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
        )
        order = W.partitionBy("_s").orderBy("_bucket")
        summed = histogram.withColumn("_upto", F.sum("_words").over(order))
        hit = summed.join(
            state.select(F.col("source").alias("_t"), F.col("_left").alias("_budget")), F.col("_s").eqNullSafe(F.col("_t"))
        ).filter((F.col("_upto") > F.col("_budget")) & (F.col("_upto") - F.col("_words") <= F.col("_budget")))
        hit = hit.select("_s", "_bucket", "_words", "_rows", (F.col("_upto") - F.col("_words")).alias("_before"))
        state = staged(
            state.drop("_words", "_rows")
            .join(hit, F.col("source").eqNullSafe(F.col("_s")), "left")
            .withColumn("_lower", F.col("_lower") + F.shiftleft(F.coalesce(F.col("_bucket"), F.lit(0)).cast("long"), shift))
            .withColumn("_left", F.col("_left") - F.coalesce(F.col("_before"), F.lit(0)))
            .drop("_s", "_bucket", "_before"),
            "mix-level",
        )
        if state.filter("_rows > 1").isEmpty():
            break  # every boundary bucket holds one document
    # where the boundary holds one row, it is taken if that comes nearer to the budget
    tied = F.col("_open") & (F.coalesce("_rows", F.lit(0)) > 1) & F.lit(key != KEYS[-1])
    nearer = ~tied & (2 * F.col("_left") > F.coalesce(F.col("_words"), F.lit(0)))
    found = F.col("_lower") + F.when(nearer, F.lit(1 << shift)).otherwise(F.lit(0))
    state = state.withColumn(f"t_{key}", F.when(F.col("_open"), found).otherwise(F.col(f"t_{key}")))
    return state.withColumn("_open", tied).drop("_lower", "_words", "_rows")


def _sizes(docs: DataFrame, *also: str) -> DataFrame:
    """What the thresholds need; to be staged, so that the row numbers hold."""
    return docs.select(
        *also,
        "doc_id",
        "source",
        word_count(text_of()).alias("size"),
        id_hash(F.col("doc_id")).alias("hash"),
        id_hash(text_of()).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )


def _marks(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sizes, source_targets(totals, weights, max_epochs)).withColumnRenamed("source", "_s")


def _copies() -> Column:
    below = F.struct(*KEYS) < F.struct(*[F.col(f"t_{k}").alias(k) for k in KEYS])
    return F.when(F.col("size") > 0, F.col("full") + F.when(below, 1).otherwise(0)).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target,
    copies, taken``.

    ``size`` is the number of words, ``copies`` how often the mix takes the
    document and ``taken`` = ``copies`` x ``size``.  A null text has size 0, a
    null source is a source of its own, last in order.  A source without words
    has target 0.  Rows with the same id (repeated rows, null ids) share a hash;
    at a threshold they are taken one by one.  An empty table gives an empty result.  Only
    ``doc_id``, ``source`` and ``text`` are read.
    """
    sizes = staged(_sizes(docs), "mix-sizes")
    return (
        sizes.join(_marks(sizes, weights, max_epochs), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("copies", _copies())
        .select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents the mix takes, each as often as it takes it; all columns
    stay.  The documents are staged with their row numbers.  The thresholds (a row
    a source) come to them, so texts are not shuffled unless the sources are too
    many to broadcast.  Documents without words add nothing to a mix and are left
    out."""
    rows = _sizes(docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text"), "_row")
    rows = staged(rows, "mix-rows")
    marks = _marks(rows.drop("_row"), weights, max_epochs)
    return (
        rows.join(marks, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_n", _copies())
        .filter("_n > 0")
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy"))
        .select("_row.*")
    )
