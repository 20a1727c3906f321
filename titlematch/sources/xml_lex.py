"""Parallel lexing: XML records of any shape, cut in all splits at once.

Where a record begins depends on what stands before it: an opening tag may be part
of a comment, a CDATA section, a processing instruction or another record.  A split
does not know that, so it is lexed in two passes.

1. Every split works out a transition table: for each state it may begin in (text,
   comment, CDATA, instruction) the state it ends in and how the nesting of row
   elements changes.  Tables are composed in the order of the splits in their
   file, a row a split, which gives each split the state it really begins in.
2. Every split is cut with that state.  A record that ends in a later split is
   put together from one piece a split, by the split it begins in.

Inside a tag ``<`` cannot occur, and chunks are cut at ``<row_tag``, so a chunk never
begins inside a tag or a quoted value; these need no state of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, COMMENT, CDATA, INSTRUCTION = range(4)
_OPENS = {"<!--": COMMENT, "<![CDATA[": CDATA, "<?": INSTRUCTION}
_ENDS = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>"}


@dataclass
class Lexer:
    """The state of a scan: mode, open row elements, and the fewest so far."""

    tag: str
    mode: int = TEXT
    depth: int = 0

    def __post_init__(self) -> None:
        name = re.escape(self.tag)
        self.tokens = re.compile(rf"""<!--|<!\[CDATA\[|<\?|<{name}(?=[\s/>])(?:[^<>"']|"[^"]*"|'[^']*')*>|</{name}\s*>""")
        self.least = self.depth

    def scan(self, chunk: str) -> Iterator[tuple[int, int]]:
        """Moves over a chunk.  Yields ``(place, change)`` where the number of open
        row elements changes: behind a closing tag, before an opening one; a row
        that closes itself opens and closes."""
        at = 0
        while at < len(chunk):
            if self.mode != TEXT:
                end = chunk.find(_ENDS[self.mode], at)
                if end < 0:
                    return
                at, self.mode = end + len(_ENDS[self.mode]), TEXT
            found = self.tokens.search(chunk, at)
            if not found:
                return
            token, at = found[0], found.end()
            if token in _OPENS:
                self.mode = _OPENS[token]
            elif token.startswith("</"):
                self.depth -= 1
                self.least = min(self.least, self.depth)
                yield at, -1
            else:
                self.depth += 1
                yield found.start(), 1
                if token.endswith("/>"):
                    self.depth -= 1
                    self.least = min(self.least, self.depth)
                    yield at, -1


def _chunks(spark: SparkSession, path: str | list[str], tag: str) -> DataFrame:
    rows = spark.read.option("lineSep", f"<{tag}").text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _splits(batches: Iterator[pa.RecordBatch], tag: str) -> Iterator[tuple[tuple[str, int], bool, str]]:
    """``(file, block), whether it is the split's first chunk, chunk``."""
    before = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("value", "file", "block"))
        for value, file, block in zip(*columns, strict=True):
            first = (file, block) != before
            before = (file, block)
            # what stands before the first tag of a file is the only chunk without one
            yield before, first, value if first and block == 0 else f"<{tag}{value}"


def transitions(chunks: DataFrame, tag: str) -> dict[tuple[str, int], list[tuple[int, int, int]]]:
    """Per split and beginning mode: the mode at its end, the change of the number
    of open row elements, and the lowest that number gets."""

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lexers = None, []

        def out() -> pa.RecordBatch:
            columns = [pa.array([x], t) for x, t in ((own[0], pa.string()), (own[1], pa.int64()))]
            columns += [pa.array([[getattr(x, c) for x in lexers]], pa.list_(pa.int64())) for c in ("mode", "depth", "least")]
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "mode", "depth", "least"])

        for split, first, chunk in _splits(batches, tag):
            if first:
                if own:
                    yield out()
                own, lexers = split, [Lexer(tag, mode) for mode in range(4)]
            for lexer in lexers:
                for _ in lexer.scan(chunk):
                    pass
        if own:
            yield out()

    schema = "file string, block long, mode array<long>, depth array<long>, least array<long>"
    rows = chunks.mapInArrow(table, schema).collect()  # a row a split
    return {(r.file, r.block): list(zip(r.mode, r.depth, r.least, strict=True)) for r in rows}


def beginnings(tables: dict[tuple[str, int], list[tuple[int, int, int]]]) -> dict[tuple[str, int], tuple[int, int, int]]:
    """The mode and open row elements with which each split begins, and the split
    (its block) in which the open record began."""
    out: dict[tuple[str, int], tuple[int, int, int]] = {}
    mode = depth = begun = 0
    last = None
    for file, block in sorted(tables):
        if file != last:
            _finished(last, mode, depth)
            mode, depth, begun, last = TEXT, 0, block, file
        out[file, block] = (mode, depth, begun)
        mode, change, least = tables[file, block][mode]
        if depth == 0 or depth + least <= 0:
            begun = block  # what is open at the end began here
        depth += change
    _finished(last, mode, depth)
    return out


def _finished(file: str | None, mode: int, depth: int) -> None:
    if mode != TEXT or depth:
        raise ValueError(f"{file} ends inside a record, comment, CDATA section or instruction")


def lexed_records(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    """One ``record`` string per row element, whatever stands around or in it.

    Row elements in comments, CDATA sections and instructions are none, those inside
    a record are part of it.  A file that ends inside one of these, or closes
    a row that is not open, fails.  An empty file has no record."""
    chunks = _chunks(spark, path, row_tag)
    states = beginnings(transitions(chunks, row_tag))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, lexer, held, owner = None, None, [], 0

        def rows(out: list) -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * 4
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "begun", "block", "text"])

        def left() -> list:
            return [(split[0], owner, split[1], "".join(held))] if held else []

        out = []
        for now, first, chunk in _splits(batches, row_tag):
            if first:
                out += left()
                split, held = now, []
                mode, depth, owner = states[split]
                lexer = Lexer(row_tag, mode, depth)
            at, depth = 0, lexer.depth
            for place, change in lexer.scan(chunk):
                if change > 0:
                    if depth == 0:
                        at, owner = place, split[1]
                    depth += 1
                    continue
                depth -= 1
                if depth < 0:
                    raise ValueError(f"{split[0]}: </{row_tag}> without a row")
                if depth == 0:
                    # whole records have no owner; the end of an older one does
                    piece = "".join([*held, chunk[at:place]])
                    whole = owner == split[1]
                    out.append((None if whole else split[0], owner, split[1], piece))
                    held, owner = [], split[1]
            if depth > 0:
                held.append(chunk[at:])
            if len(out) >= 1000:
                yield rows(out)
                out = []
        yield rows(out + (left() if split else []))

    # a record left open by its own split is a piece as well
    pieces = chunks.mapInArrow(cut, "file string, begun long, block long, text string")
    return _joined(pieces)


def _joined(pieces: DataFrame) -> DataFrame:
    whole = pieces.filter("file IS NULL").select(F.col("text").alias("record"))
    parts = pieces.filter("file IS NOT NULL").groupBy("file", "begun").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p"))
    return whole.union(parts.select(F.array_join(F.col("p.text"), "").alias("record")))


def read_xml_lexed(spark: SparkSession, path: str | list[str], row_tag: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """Splittable scan of any well-formed XML; columns and failures as those of
    ``read_xml_records``.  It reads the input twice, for the states and the records,
    so use that one where no record has the row tag in a comment, CDATA section or
    nested element."""
    parsed = lexed_records(spark, path, row_tag).select(F.from_xml("record", schema, {"mode": "FAILFAST"} | options).alias("r"))
    return parsed.select("r.*")
