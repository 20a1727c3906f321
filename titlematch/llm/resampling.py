"""Target-distribution importance resampling over hashed n-gram features.

A text's features are its words and its pairs of neighbouring words; each falls
into one of ``BUCKETS`` buckets by the CRC-32 of its bytes.  A bucket's gain is
the logarithm of how much more frequent it is in the target texts than in all
documents, a document's weight the mean gain of its features, and documents are
drawn without replacement by weight plus keyed Gumbel noise.

Features are counted in batches.  The texts of a batch are joined with a separator
that no word can hold, one pass of one regular expression finds the words of all
of them, a binary search in the documents' offsets says whose a word is, and pairs
whose words belong to two documents are masked out.  Long batches are cut in
windows between two words, so memory is bounded by the window (and by a single
word).  A document's buckets are staged as 16-bit numbers: texts are read once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat
from operator import concat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import staged, text_of
from titlematch.operators.rank import numbered

BUCKETS, SCALE, SEED = 10_000, 1000, 7
#: Documents with fewer words are never drawn; the share of the others that is.
LEAST_WORDS, PERCENT = 20, 25
SEPARATOR = b"\0"
#: Bytes that a pass over joined texts looks at.
WINDOW = 1 << 20
# Fixed value: words are runs of ASCII digits, letters (A-Z folded) and all
# characters beyond ASCII, whose bytes are all 0x80 or more.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
_SCHEMA = "doc_id long, n_words long, features binary"


def batch_features(texts: list[bytes], buckets: int = BUCKETS, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of folded UTF-8 texts: the words of each text, the features of
    each text, and the bucket of every feature, text after text."""
    joined = SEPARATOR.join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    owners, places = [], []
    words_of = np.zeros(len(texts), np.int64)
    at, last, last_owner = 0, 0, -1
    while at < len(joined):
        cut = _NO_WORD.search(joined, min(at + window, len(joined)))
        end = cut.start() if cut else len(joined)
        found = list(WORD.finditer(joined, at, end))
        at = end
        if not found:
            continue
        words = [m[0] for m in found]
        owner = np.searchsorted(starts, np.fromiter((m.start() for m in found), np.int64, len(found)), side="right") - 1
        single = list(map(crc32, words))
        # the CRC of "a b" goes on from that of "a" over " b"; the first pair is with the window before
        pair = np.fromiter(map(crc32, map(concat, repeat(b" "), words), chain([last], single)), np.int64, len(words))
        whole = owner == np.concatenate([[last_owner], owner[:-1]])
        owners += [owner, owner[whole]]
        places += [np.array(single, np.int64) % buckets, pair[whole] % buckets]
        words_of += np.bincount(owner, minlength=len(texts))
        last, last_owner = single[-1], owner[-1]
    if not owners:
        return words_of, words_of, np.zeros(0, np.uint16)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return words_of, np.bincount(owner, minlength=len(texts)), np.concatenate(places)[order].astype(np.uint16)


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text is a range alone."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    a = 0
    while a < len(sizes):
        b, held = a + 1, int(sizes[a])
        while b < len(sizes) and held + sizes[b] <= most:
            held += int(sizes[b])
            b += 1
        yield a, b
        a = b


def features(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, features`` (16-bit bucket numbers, one a feature)."""
    if buckets > 1 << 16:
        raise ValueError("bucket numbers have 16 bits")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(batch.column("text"), 4 * WINDOW):
                part = batch.slice(a, b - a)
                # bytes.lower() folds A-Z and nothing else
                texts = [t.encode().lower() for t in part.column("text").to_pylist()]
                words, n, places = batch_features(texts, buckets)
                ends = np.cumsum(np.append(0, 2 * n))
                data = places.astype("<u2").tobytes()
                own = [data[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words), pa.array(own, pa.binary())], names=["doc_id", "n_words", "features"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(count, _SCHEMA)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: a task adds its rows up before the shuffle,
    and ``buckets`` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                places = b"".join(batch.column("features").slice(at, 256).to_pylist())
                total += np.bincount(np.frombuffer(places, "<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in found.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(SCALE * ln((t + 1) * (S + B) / ((s + 1) * (T + B))))`` per bucket."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.array([math.floor(SCALE * math.log(x)) for x in ratio], dtype=np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = [], []
            for own in batch.column("features"):
                places = np.frombuffer(own.as_buffer(), "<u2")
                n.append(len(places))
                weight.append(int(gain[places].sum()) // len(places) if len(places) else 0)
            arrays = [batch.column("doc_id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Keyed Gumbel noise in ``SCALE``-ths, the same in every run."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / F.lit(float(1 << 32)))))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_features, weight, score, rank``.

    Of the N documents with ``least_words`` words or more, the
    ``floor(percent * N / 100)`` with the highest score are drawn and ranked from
    1, ties to the smaller id; the others have a null rank.  A null, empty or
    wordless text has no features and weight 0.  Rows are scored one by one, so
    repeated rows are drawn each for itself; a null id has the noise of an empty
    key and loses ties.  An empty target leaves every bucket at its smoothed
    count; an empty table gives an empty result.  Only ``doc_id`` and ``text`` of
    ``docs`` and ``text`` of ``target`` are read.
    """
    found = staged(features(docs), "resample-features")
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    gain = gains(bucket_counts(found), bucket_counts(wanted))
    rows = weighed(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    rows = staged(rows, "resample-scores")
    may = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = rows.filter(may)
    drawn = percent * eligible.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("weight").asc()]
    ranked = numbered(eligible.select(*columns), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.union(rows.filter(~may).select(*columns, F.lit(None).cast("long")))
