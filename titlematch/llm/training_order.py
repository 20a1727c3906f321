"""Training-order materialisation: fixed-stride shards in a keyed random order.

The documents' token streams, each with an end id, run on one after the other and
are cut into sequences of ``SEQUENCE`` ids, so only the last sequence of an input
partition is shorter.  With N sequences, numbered 0 to N - 1 as the staged token
table lists them, a keyed Feistel network permutes the smallest even power of two
that holds N; values of N or more walk the cycle until they fall below it, so the
numbers are permuted among themselves and each sequence has one global slot.  No
slot is looked up or sorted for: it is computed from the number and the key.

Slots are dealt to shards of ``SHARD`` records by range (a partition a shard), sorted, and written by
Spark as files of fixed-stride records: slot s is record ``s % SHARD`` of shard
``s // SHARD``, at byte ``(s % SHARD) * STRIDE``.  A reader resumes at any slot by
that arithmetic, and reads on sequentially.

A record is a header (ids used; the document of the first id and where in it
that id stands), the ids as unsigned 16-bit little-endian numbers, zeros up to
the stride, and a line end.  A record has no room for all its documents, so the
documents that begin inside a sequence are listed in Parquet files beside the shards,
by slot: which document, and where in the sequence it begins.  The lists are narrow
and stay where the sequences were made; only records are moved.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlematch.llm.base import new_folder, staged, text_of
from titlematch.llm.tokens import bare, default_path, encoder
from titlematch.staging import scope

SEQUENCE, SHARD = 512, 1 << 14
VOCABULARY = "word_bpe_49k.json"
END, KEY, ROUNDS = 0, 20240817, 6
#: Sequences of one batch of a task's output, at most.
BLOCK = 1 << 16
HEADER = "<Hqq"
HEADER_SIZE = struct.calcsize(HEADER)
NO_ID = -(1 << 63)
DOCUMENTS = "array<struct<doc_id:long,start:long,offset:int>>"
BEGUN = "array<struct<doc_id:long,offset:int>>"
#: The staged ids lie beside the shards until those are written: pages of 8 MB, a higher level.
STAGING = {"parquet.page.size": str(8 << 20), "parquet.page.row.count.limit": "1000000", "parquet.compression.codec.zstd.level": "6"}


def stride(sequence: int = SEQUENCE) -> int:
    return HEADER_SIZE + 2 * sequence + 1


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = x + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slots of ``numbers`` (all below ``n``): a bijection of 0..n-1."""
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [int(k) for k in np.random.default_rng(key).integers(0, 1 << 63, ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & mask)
        return (left << half) | right

    out = once(numbers.astype(np.uint64))
    while (over := np.flatnonzero(out >= np.uint64(n))).size:
        out[over] = once(out[over])  # walks the cycle; it began below n, so it comes back there
    return out.astype(np.int64)


def short_ids(ids: list[int]) -> bytes:
    """Raises ``struct.error`` for ids over 65535."""
    return struct.pack(f"<{len(ids)}H", *ids)


def _cut(data: memoryview, names: pa.Array, begins: np.ndarray, sequence: int) -> pa.RecordBatch:
    """The sequences of ``data``, ids of documents one after the other; document i
    is ``names[i]`` and begins ``begins[i]`` ids from the first (which may be before it)."""
    total = len(data) // 2
    bounds = np.append(np.arange(0, total, sequence), total)
    first = np.searchsorted(begins, bounds[:-1], "right") - 1
    inside = np.flatnonzero((begins > 0) & (begins < total) & (begins % sequence != 0))
    fields = [names.take(pa.array(inside)), pa.array((begins[inside] % sequence).astype(np.int32))]
    ends = pa.array(np.searchsorted(begins[inside], bounds).astype(np.int32))
    begun = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(fields, names=["doc_id", "offset"]))
    offsets = pa.py_buffer((2 * bounds).astype(np.int32))
    ids = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(data)])
    columns = [names.take(pa.array(first)), pa.array(bounds[:-1] - begins[first]), pa.array(np.diff(bounds).astype(np.int32)), ids, begun]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "begun"])


def sequences(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, start, length, ids, begun``: the documents' ids and end ids, cut
    into sequences; whose the first id is and where in it it stands, and the
    documents that begin after it, in order."""
    path, end = vocabulary or default_path(VOCABULARY), short_ids([END])
    size = 2 * sequence

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, bare, short_ids, lower=True)
        # the open sequence, and the documents in it: their ids, and where from its beginning they begin
        held, names, begins = b"", pa.array([], pa.int64()), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                streams = [data + end for data in encode.each(part.column("text").to_pylist(), b"".join)]
                own = np.cumsum([len(held), *map(len, streams)])[:-1] // 2
                names, begins = pa.concat_arrays([names, part.column("doc_id")]), np.append(begins, own)
                data = memoryview(b"".join([held, *streams]))
                n = len(data) // size
                for k in range(0, n, BLOCK):
                    yield _cut(data[k * size : min(n, k + BLOCK) * size], names, begins - k * sequence, sequence)
                first = np.searchsorted(begins, n * sequence, "right") - 1
                held, names, begins = bytes(data[n * size :]), names.slice(first), begins[first:] - n * sequence
        if held:
            yield _cut(memoryview(held), names, begins, sequence)

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(cut, f"doc_id long, start long, length int, ids binary, begun {BEGUN}")


def documents_path(path: str) -> str:
    """The folder beside the shards that lists the documents of the sequences."""
    return f"{path}-documents"


def _little_endian(value: Column, size: int) -> Column:
    """The low ``size`` bytes of a long, lowest first, as binary."""
    digits = F.lpad(F.hex(value.cast("long")), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(size)]))


def materialise(
    docs: DataFrame, path: str, key: int = KEY, sequence: int = SEQUENCE, shard: int = SHARD, vocabulary: str | None = None
) -> int:
    """Writes the shards under ``path``, the documents of their sequences beside
    it, and returns the number of sequences.

    A null or empty text is the end id alone.  Repeated rows are written as often
    as they occur; a null id is written as the smallest long (beside the shards,
    as null).  An empty table writes no shard.  Only ``doc_id`` and ``text`` are read.
    """
    with scope(docs.sparkSession):  # the staged ids go once the shards are written
        return _written(docs, path, key, sequence, shard, vocabulary)


def _written(docs: DataFrame, path: str, key: int, sequence: int, shard: int, vocabulary: str | None) -> int:
    # written once, so that the numbers hold however often a task is run again
    rows = staged(sequences(docs, sequence, vocabulary).withColumn("_at", F.monotonically_increasing_id()), "order-tokens", options=STAGING)
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect())  # a row a partition
    n = sum(size for _, size in sizes)
    if not n:
        return 0
    before = pd.Series(np.cumsum([0] + [size for _, size in sizes])[:-1], index=[p for p, _ in sizes])

    @F.pandas_udf("long")
    def slot(parts: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series(permuted(before.loc[parts].to_numpy() + places.to_numpy(), n, key))

    header = F.concat(
        _little_endian(F.col("length"), 2), _little_endian(F.coalesce("doc_id", F.lit(NO_ID)), 8), _little_endian(F.col("start"), 8)
    )
    record = F.rpad(F.col("record"), stride(sequence) - 1, F.lit(b"\0"))
    dealt = rows.select(slot(part, place).alias("_slot"), F.concat(header, F.col("ids")).alias("record"))
    (
        dealt.withColumn("shard", F.floor(F.col("_slot") / shard))
        .repartitionById(-(-n // shard), F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "_slot")
        .select(record.cast("string").alias("value"), "shard")
        .write.partitionBy("shard")
        .option("lineSep", "\n")
        .text(path)
    )
    listed = rows.select(slot(part, place).alias("slot"), "doc_id", "start", "begun")
    listed.write.option("compression", "zstd").parquet(documents_path(path))
    return n


def read_order(
    spark: SparkSession, path: str, first: int = 0, sequence: int = SEQUENCE, shard: int = SHARD, digests: bool = False
) -> DataFrame:
    """Sequences from slot ``first`` on: ``slot, shard, byte_offset, doc_id,
    start, length, ids`` (or ``ids_crc32``, with ``digests``).  Shards before it are
    not opened."""
    size = stride(sequence)
    kind = np.dtype([("length", "<u2"), ("doc_id", "<i8"), ("start", "<i8"), ("rest", "V", size - HEADER_SIZE)])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                records = np.frombuffer(data, kind, len(data) // size)
                for a in range(max(0, first - own * shard), len(records), 4096):
                    some = records[a : a + 4096]
                    places = np.arange(a, a + len(some), dtype=np.int64)
                    begin = places * size + HEADER_SIZE
                    views = [data[x : x + 2 * k] for x, k in zip(begin.tolist(), some["length"].tolist(), strict=True)]
                    ids = pa.array(map(zlib.crc32, views), pa.int64()) if digests else pa.array(map(bytes, views), pa.binary())
                    docs = some["doc_id"].copy()
                    columns = [
                        pa.array(own * shard + places), pa.array(np.full(len(some), own, np.int64)), pa.array(places * size), pa.array(docs, mask=docs == NO_ID),
                        pa.array(some["start"].copy()), pa.array(some["length"].astype(np.int32)), ids,
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["slot", "shard", "byte_offset", "doc_id", "start", "length", last])

    last = "ids_crc32" if digests else "ids"
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= first // shard)
    schema = f"slot long, shard long, byte_offset long, doc_id long, start long, length int, {last} {'long' if digests else 'binary'}"
    return files.select(F.col("shard").cast("long"), "content").mapInArrow(parse, schema)


def read_documents(spark: SparkSession, path: str, first: int = 0) -> DataFrame:
    """``slot, documents`` from slot ``first`` on: every document of a sequence, as
    ``doc_id``, ``start`` (place in the document) and ``offset`` (place in the
    sequence) of its first id there."""
    rows = spark.read.schema(f"slot long, doc_id long, start long, begun {BEGUN}").parquet(documents_path(path))
    zero = F.lit(0).cast("long")
    head = F.array(F.struct("doc_id", "start", F.lit(0).alias("offset")))
    others = F.transform("begun", lambda d: F.struct(d["doc_id"].alias("doc_id"), zero.alias("start"), d["offset"].alias("offset")))
    return rows.filter(F.col("slot") >= first).select("slot", F.concat(head, others).cast(DOCUMENTS).alias("documents"))


def training_order(docs: DataFrame) -> DataFrame:
    """Materialises the order in the shared folder and reads it back: ``slot,
    shard, byte_offset, doc_id, start, length, ids_crc32`` (of the 16-bit ids) and
    ``documents``, the list of all documents in the sequence."""
    spark = docs.sparkSession
    path = new_folder(spark, "training-order")
    if not materialise(docs, path):
        return spark.createDataFrame([], f"slot long, shard long, byte_offset long, doc_id long, start long, length int, ids_crc32 long, documents {DOCUMENTS}")
    return read_order(spark, path, digests=True).join(read_documents(spark, path), "slot")
