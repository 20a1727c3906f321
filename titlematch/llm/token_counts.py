"""Token counts with overlap resynchronisation for huge documents.

A text of more than ``CHUNK`` characters is encoded in overlapping chunks, each
a row of its own, so that many tasks share one document.  A chunk reports the
token boundaries in its overlaps: their offset in the document and the tokens
before them.  Only stable boundaries are reported, those at which the
tokenizer's own splitting cuts whatever stands around (the starts of units, see
``tokens``); the cut ends of a chunk are none.  Two neighbours are spliced at a
boundary both report, and a document's count is the sum of what lies between its
splices.  An overlap in which no run of white space begins can hold no boundary and
is widened before anything is encoded: the chunk reads on to the next such place,
and the next chunk begins shortly before it, so a text without white space is
encoded once.  Where neighbours still share no boundary, the document is encoded
again with wider overlaps, until one chunk holds it all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import staged, text_of
from titlematch.llm.tokens import SPACE, default_path, encoder, slices, spaced

VOCABULARY = "byte_bpe_50k.json"
#: Characters a chunk advances, and characters it reads into the next one.
CHUNK, OVERLAP, WIDEN = 1 << 14, 256, 16
LIMIT = 512
_WHITE = re.compile(f"[{SPACE}]")
_RUN = re.compile(f"(?<=[^{SPACE}])[{SPACE}]")


def _direct(path: str):
    """``mapInArrow`` function that counts whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaced, len)
        for batch in batches:
            n = list(encode.each(batch.column("text").to_pylist(), sum))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return count


def chunks(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Where the chunks of a text begin and end.  Neighbours share ``overlap``
    characters, or twice that around the next place where white space begins."""
    at = 0
    while True:
        following, end = at + chunk, at + chunk + overlap
        if end < len(text):
            run = _RUN.search(text, following + 1)
            if run is None:
                end = len(text)
            elif run.start() > end:
                following, end = run.start() - overlap, run.start() + overlap
        if end >= len(text):
            yield at, len(text)
            return
        yield at, end
        at = following


def _cut(chunk: int, overlap: int):
    """``mapInArrow`` function: a text -> its overlapping chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for k, (at, end) in enumerate(chunks(text, chunk, overlap)):
                    yield pa.RecordBatch.from_pylist([{"row": row, "k": k, "at": at, "last": end == len(text), "text": text[at:end]}])

    return cut


def _marks(path: str, overlap: int):
    """``mapInArrow`` function: a chunk -> its token count and the stable
    boundaries in its overlaps (offset in the document, tokens before)."""
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), *[pa.list_(pa.int64())] * 4]
    names = ["row", "k", "last", "n", "left_at", "left_n", "right_at", "right_n"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaced, len)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text, at = r["text"], r["at"]
                left, right, n, place = [], [], 0, 0
                for part in slices(text):
                    units = spaced(part)
                    for unit, tokens in zip(units, encode.values(part), strict=True):
                        # a unit that starts with white space starts at a boundary in any context
                        if place and _WHITE.match(unit):
                            if place <= overlap and at:
                                left.append((at + place, n))
                            if place >= len(text) - overlap and not r["last"]:
                                right.append((at + place, n))
                        place += len(unit)
                        n += tokens
                columns = [[p[i] for p in side] for side in (left, right) for i in (0, 1)]
                out.append((r["row"], r["k"], r["last"], n, *columns))
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return mark


def _spliced(long: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``row, n_tokens`` of long texts; null where two chunks did not align."""
    pieces = long.mapInArrow(_cut(chunk, overlap), "row long, k long, at long, last boolean, text string")
    marks = staged(
        pieces.repartition("row", "k").mapInArrow(
            _marks(path, overlap),
            "row long, k long, last boolean, n long, left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>",
        ),
        "token-marks",
    )
    following = marks.select(
        F.col("row").alias("_row"), (F.col("k") - 1).alias("_k"), F.col("left_at").alias("_at"), F.col("left_n").alias("_n")
    )
    joined = marks.join(following, (F.col("row") == F.col("_row")) & (F.col("k") == F.col("_k")), "left")
    common = F.array_intersect("right_at", "_at")
    # the splice in the middle of the overlap; tokens here before it, and there
    splice = F.when(F.size(common) > 0, F.element_at(common, (F.size(common) / 2).cast("int") + 1))
    here = F.element_at("right_n", F.array_position("right_at", splice).cast("int"))
    there = F.element_at("_n", F.array_position("_at", splice).cast("int"))
    n = F.when(F.col("last"), F.col("n")).otherwise(F.when(splice.isNotNull(), here - there))
    return (
        joined.select("row", n.alias("_own"))
        .groupBy("row")
        .agg(F.sum("_own").alias("n_tokens"), F.count(F.when(F.col("_own").isNull(), 1)).alias("_open"))
        .select("row", F.when(F.col("_open") == 0, F.col("n_tokens")).alias("n_tokens"))
    )


def token_counts(
    docs: DataFrame, limit: int = LIMIT, vocabulary: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    Tokens as the tokenizer library gives them for the whole text, without added
    special tokens.  A null or empty text has none.  Rows are counted one by one,
    so repeated rows and null ids do no harm.  An empty table gives an empty
    result.  Only ``doc_id`` and ``text`` are read.
    """
    path = vocabulary or default_path(VOCABULARY)
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = rows.filter(F.length("text") <= chunk).withColumn("doc_id", F.col("doc_id").cast("long"))
    counted = short.mapInArrow(_direct(path), "doc_id long, n_bytes long, n_tokens long")
    # written once: every chunking below reads the same row numbers
    long = staged(rows.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()), "token-long")
    left, done = long.select("row", "text"), None
    while not left.isEmpty():
        counts = staged(_spliced(left, path, chunk, overlap), "token-counts")
        found = counts.filter("n_tokens IS NOT NULL")
        done = found if done is None else done.union(found)
        left = left.join(counts.filter("n_tokens IS NULL").select("row"), "row", "left_semi")
        overlap *= WIDEN
    if done is not None:
        counted = counted.union(long.join(done, "row").select(F.col("doc_id").cast("long"), "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
