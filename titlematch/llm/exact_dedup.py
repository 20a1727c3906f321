"""Exact dedup: counting quotient filters, then byte verification.

Each input partition builds one counting quotient filter of its 64-bit text
fingerprints, cut into blocks by the fingerprints' top bits; the blocks are
merged by sorted remainders, so the counts are exact.  A fingerprint with count
one is a text without a copy.  The others route to byte verification: their
texts are grouped by the normalised text itself, which a partial aggregate
collapses before the shuffle, however many copies there are.

Texts are equal when identical after lower-casing A-Z only; the row with the
largest ``doc_id`` stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import few, fold_ascii, staged, text_of
from titlematch.llm.quotient import QuotientFilter

#: Documents a filter block is sized for; blocks grow in number, not in size.
BLOCK_DOCS = 1 << 16
#: Fingerprints a task holds before it folds them into its counts.
BUFFER = 1 << 21


def normalised() -> Column:
    return fold_ascii(text_of())


def repeated_fingerprints(fingerprints: DataFrame, n_docs: int) -> DataFrame:
    """``fingerprints`` (one long column ``fp``) -> ``fp, copies`` of those that
    occur more than once, by merged counting quotient filters."""
    block_bits = max(4, (max(n_docs, 1) // BLOCK_DOCS).bit_length())
    quotient_bits = 16
    remainder_bits = 64 - block_bits - quotient_bits
    low = np.uint64(64 - block_bits)

    def fold(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        return keys[first], np.add.reduceat(counts, first)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for batch in batches:
            if len(batch):
                keys, counts = np.unique(batch["fp"].to_numpy().view(np.uint64), return_counts=True)
                parts.append((keys, counts))
                held += len(keys)
            if held > BUFFER:
                parts = [fold(parts)]
                held = 0
        if not parts:
            return
        keys, counts = fold(parts)
        blocks = keys >> low
        starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        inner = keys & np.uint64((1 << int(low)) - 1)
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(keys)), strict=True):
            out.append((int(blocks[a]), QuotientFilter(quotient_bits, remainder_bits, inner[a:b], counts[a:b]).to_bytes()))
        yield pd.DataFrame(out, columns=["block", "filter"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        merged = QuotientFilter.merge(map(QuotientFilter.from_bytes, group["filter"]))
        many = merged.counts > 1
        keys = merged.keys[many] | (np.uint64(group["block"].iloc[0]) << low)
        return pd.DataFrame({"fp": keys.view(np.int64), "copies": merged.counts[many]})

    filters = fingerprints.mapInPandas(build, "block long, filter binary")
    return filters.groupBy("block").applyInPandas(merge, "fp long, copies long")


def _routed(docs: DataFrame, extra: list[Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with fingerprint and digest; the repeated fingerprints; the verified
    groups (``_fp, _sha, keep_id, group_size``)."""
    fp = F.xxhash64(normalised())
    repeated = staged(repeated_fingerprints(docs.select(fp.alias("fp")), docs.count()), "exact-repeated").select(
        F.col("fp").alias("_repeated")
    )
    repeated = few(repeated)
    rows = docs.select(*extra, fp.alias("_fp"), F.sha2(normalised(), 256).alias("_sha"), F.col("doc_id").alias("_doc"))
    groups = (
        docs.select(F.col("doc_id").alias("_doc"), normalised().alias("_norm"))
        .withColumn("_fp", F.xxhash64("_norm"))
        .join(repeated, F.col("_fp") == F.col("_repeated"), "left_semi")
        .groupBy("_fp", "_norm")
        .agg(F.max("_doc").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_fp", F.sha2("_norm", 256).alias("_sha"), "keep_id", "group_size")
    )
    return rows, repeated, groups


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    A null text counts as empty, and empty texts are equal to each other.  Null
    ids lose against any id; a group of null ids has a null ``keep_id``, and all
    of it is kept.  Rows that repeat the kept id with the same text are one
    document written twice: all of them say ``kept``.  An empty table gives an
    empty result.  Only ``doc_id`` and ``text`` are read.
    """
    rows, _, groups = _routed(docs, [])
    found = groups.select(F.col("_fp").alias("_gfp"), F.col("_sha").alias("_gsha"), "keep_id", "group_size")
    joined = rows.join(found, (F.col("_fp") == F.col("_gfp")) & (F.col("_sha") == F.col("_gsha")), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("_doc")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("_doc").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        keep.eqNullSafe(F.col("_doc")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, all their columns; of rows that repeat the kept
    id, one."""
    rows, repeated, groups = _routed(docs, [F.struct("*").alias("_row")])
    single = rows.join(repeated, F.col("_fp") == F.col("_repeated"), "left_anti")
    found = staged(groups.select(F.col("_fp").alias("_gfp"), F.col("_sha").alias("_gsha"), "keep_id"), "exact-kept")
    # with the id among the keys, the rows of a large group do not meet in a task
    kept = (F.col("_fp") == F.col("_gfp")) & (F.col("_sha") == F.col("_gsha")) & F.col("_doc").eqNullSafe(F.col("keep_id"))
    winners = rows.join(few(found), kept).groupBy("_fp", "_sha").agg(F.first("_row").alias("_row"))
    return single.select("_row.*").unionByName(winners.select("_row.*"))
