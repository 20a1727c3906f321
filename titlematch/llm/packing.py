"""Best-fit packing of documents into sequences, bulk-synchronously.

Documents are cut into pieces of at most a sequence's length and range-sorted by
length, longest first; rows of one length form a run.  A superstep takes the run
of the next length and the gaps, sorted too: the run's rows go to the successor
gap (the smallest that holds them), one row a sequence.  Rows that want the same
gap are told apart by their rank in the run: rank r takes the r-th sequence of
that gap.  The gaps shrink by the length, and the sweep repeats until the run is
placed; where no gap is left, new sequences open.  The outcome is that of
best-fit decreasing over single rows.

The sweep needs only how many rows each length has (at most ``capacity`` numbers),
so it runs on counts: it yields segments "ranks a..b of this length go to
sequences s.. at this offset".  Matching the rows to the segments is a join on
the executors; no row passes through the driver.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import staged, text_of
from titlematch.llm.tokens import bare, default_path, encoder, id_bytes

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
#: The id that ends every document.
END = 0
#: Segments that are broadcast; more are joined by a shuffle.
BROADCAST_SEGMENTS = 500_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a document's ids and the end
    id, in pieces of ``capacity`` of which the last may be shorter."""
    path = vocabulary or default_path(VOCABULARY)
    end = id_bytes([END])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, bare, id_bytes, lower=True)
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, data in zip(ids, encode.each(batch.column("text").to_pylist(), b"".join), strict=True):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Supersteps over lengths, longest first.  ``counts``: rows of each length.
    Returns ``(length, rank, rows, sequence, offset)``: that many rows from that
    rank on go to sequences from ``sequence`` on."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, how many)
    order: list[int] = []  # gaps that have sequences, ascending
    segments, opened = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if not gaps[gap]:
            bisect.insort(order, gap)
        gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                new = -(-left // (capacity // length))
                add(capacity, opened, new)
                opened += new
                continue
            gap = order[at]
            first, n = gaps[gap].pop()
            # a sequence takes rows while they fit: what remains is again the smallest gap
            each = gap // length
            full = min(n, left // each)
            rest = left % each if full < n else 0
            used = full + bool(rest)
            if used < n:
                gaps[gap].append((first + used, n - used))
            if not gaps[gap]:
                order.pop(at)
            for k, to, rows in [(k, first, full) for k in range(each) if full] + [(k, first + full, 1) for k in range(rest)]:
                segments.append((length, rank, rows, to, capacity - gap + k * length))
                rank, left = rank + rows, left - rows
            for rows, to, taken in ((full, first, each), (bool(rest), first + full, rest)):
                if rows and gap > taken * length:
                    add(gap - taken * length, to, int(rows))
    return segments


def _placed(runs: list, segments: list) -> pa.Table:
    """Segments in terms of row numbers: ``part, run_length, low, high``
    (inclusive), ``shift`` (sequence minus row number) and ``offset``."""
    by_length = defaultdict(list)
    for length, rank, n, sequence, offset in segments:
        by_length[length].append((rank, rank + n, sequence, offset))
    base: dict[int, int] = defaultdict(int)
    out = []
    for part, length, first, n in sorted(runs):
        a = base[length]
        base[length] = b = a + n
        own = by_length[length]
        i = bisect.bisect_right(own, a, key=lambda s: s[0]) - 1
        while i < len(own) and own[i][0] < b:
            low, high, sequence, offset = own[i]
            x, y = max(low, a), min(high, b)
            out.append((part, length, first + x - a, first + y - 1 - a, sequence + (x - low) - (first + x - a), offset))
            i += 1
    table = np.array(out, dtype=np.int64).reshape(-1, 6)
    names = ["part", "run_length", "low", "high", "shift", "offset"]
    return pa.table({name: table[:, i] for i, name in enumerate(names)})


def packed(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    A null or empty text is the end id alone.  Repeated rows and equal ids are
    packed as often as they occur.  An empty table gives an empty result.  Only
    ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    # the row number tells repeated rows apart, so that a range of them can be split
    rows = staged(pieces(docs, capacity, vocabulary).withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    keys = [F.col("length").desc(), "doc_id", "piece", "_row"]
    ordered = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id()),
        "pack-sorted",
    ).withColumn("_part", F.shiftrightunsigned("_at", 33))
    runs = ordered.groupBy("_part", "length").agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"))
    runs = [tuple(r) for r in runs.collect()]  # at most a row a part and a length
    counts: dict[int, int] = defaultdict(int)
    for _, length, _, n in runs:
        counts[length] += n
    places = _placed(runs, best_fit(counts, capacity))
    if not places.num_rows:
        return ordered.select("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    side = spark.createDataFrame(places)
    if places.num_rows <= BROADCAST_SEGMENTS:
        side = F.broadcast(side)
    return ordered.join(
        side, (F.col("_part") == F.col("part")) & (F.col("length") == F.col("run_length")) & F.col("_at").between(F.col("low"), F.col("high"))
    ).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_at") + F.col("shift")).alias("sequence_id"), "offset")
