"""Exact top-k search by block-at-a-time pruning.

Vectors are integers (floor of 1024 times each component).  Rows are put in an
order in which neighbours are alike (by the nearest of ``PIVOTS`` sample rows,
then by id; any order gives the same result) and cut into blocks, ranges of
``BLOCK`` rows.  A block carries a forward index (its vectors as one matrix, in
the narrowest integers that hold the table) and, per dimension, the largest and
the smallest value.  For a query the summed term maxima, sum of max(q * largest,
q * smallest), bound every score in the block.  So does q * centre + |q| * radius
of the ball around the block's mean; the lesser of both is the bound.

Queries, in chunks of layout neighbours, first meet the blocks' bounds alone.
Only blocks whose bound reaches the k-th score that some query of a chunk has from
its own block send their matrices to that chunk.  There queries and blocks meet in
groups of bounded size, some hundred queries by about ``GROUP`` blocks, each a
task's work.  In a group every query takes its blocks from the highest bound down,
scores them through the forward index, and stops when the bound falls below its
k-th score so far; a bound equal to it is still scored, for ties go to the smaller
id.  The groups' results are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlematch.llm.base import staged

SCALE, TOP, EVERY = 1024, 10, 100
#: Rows of a block, blocks of a group, and queries of a group on average.
BLOCK, GROUP, QUERIES = 128, 32, 512
#: Sample rows by which the order is laid out.
PIVOTS = 64
_LOWEST = -(1 << 62)
#: Integers from here on are refused.
HIGHEST = 1 << 53


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, vector, most``: 64-bit integers and the largest absolute one."""
    for batch in batches:
        batch = batch.filter(pc.and_(pc.is_valid(batch.column("vec_id")), pc.is_valid(batch.column("embedding"))))
        vectors = batch.column("embedding")
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        x = pc.fill_null(vectors.flatten(), np.nan).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        good = np.bincount(owner[~np.isfinite(x)], minlength=len(sizes)) == 0
        with np.errstate(over="ignore"):
            x = np.floor(np.where(good[owner], x, 0.0) * SCALE)
        if (np.abs(x) >= HIGHEST).any():
            raise ValueError(f"a component times {SCALE} is {HIGHEST} or more: its scores would not be exact")
        most = np.zeros(len(sizes), dtype=np.int64)
        np.maximum.at(most, owner, np.abs(x).astype(np.int64))
        ends = np.append(0, np.cumsum(sizes) * 8).astype(np.int32)
        data = [None, pa.py_buffer(ends), pa.py_buffer(x.astype("<i8"))]
        out = [batch.column("vec_id"), pa.Array.from_buffers(pa.binary(), len(sizes), data), pa.array(most)]
        yield pa.RecordBatch.from_arrays(out, names=["vec_id", "vector", "most"]).filter(pa.array(good))


def _narrowest(most: int) -> str:
    """The narrowest integers that hold values up to ``most``."""
    return next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)


def _matrix(vectors: list[bytes], width: int, kind: str = "<i8") -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        own = np.frombuffer(v, kind)
        out[i, : len(own)] = own
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can reach 2^53.  Sums that 64
    bits may not hold are refused."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most >= 2.0**62:
        raise ValueError("inner products beyond 64 bits")
    return a @ b.T


def bounds(q: np.ndarray, largest: np.ndarray, smallest: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each query (row) and block (column) what no score in it exceeds."""
    terms = products(np.maximum(q, 0), largest) + products(np.minimum(q, 0), smallest)
    x = q.astype(np.float64)
    at, reach = x @ centre.T.astype(np.float64), np.sqrt((x * x).sum(axis=1))[:, None] * radius.astype(np.float64)
    ball = at + reach + 1e-9 * (np.abs(at) + reach) + 1  # above what rounding may take away
    ball += 1e-9 * np.abs(x) @ np.abs(centre.T).astype(np.float64)
    return np.minimum(terms, np.where(ball < 2.0**62, ball, 2.0**62).astype(np.int64))


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id, then row."""
    return np.lexsort((rows, ids, -scores))[:k]


def blocks(vectors: DataFrame, width: int, kind: str, every: int, k: int) -> DataFrame:
    """Blocks of rows in layout order, and the k-th score of each query in its
    own block (``_LOWEST`` where the block has fewer than k others)."""
    pivots = vectors.orderBy(F.xxhash64("vec_id"), "_row").limit(PIVOTS).select("vector").collect()  # a fixed number
    centre = _matrix([r.vector for r in pivots], width).astype(np.float64)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist(), width).astype(np.float64)
            place = (x @ centre.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []

        def block(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            x, ids, keys = _matrix([r[2] for r in rows], width), np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            asked = np.flatnonzero(ids % every == 0)
            scores = products(x[asked], x)
            scores[np.arange(len(asked)), asked] = _LOWEST
            kth = np.sort(scores, axis=1)[:, -k] if len(rows) > k else np.full(len(asked), _LOWEST)
            centre = np.rint(x.mean(axis=0)) if len(x) else np.zeros(width)
            radius = math.ceil(math.sqrt(((x - centre) ** 2).sum(axis=1).max(initial=0)) * (1 + 1e-9))
            data = (ids, "<i8"), (keys, "<i8"), (x, kind), (x.max(axis=0), kind), (x.min(axis=0), kind), (centre, kind), (asked, "<i8"), (kth, "<i8")
            arrays = [pa.array([d.astype(t).tobytes()], pa.binary()) for d, t in data]
            return pa.RecordBatch.from_arrays([pa.array([int(keys[0])], pa.int64()), pa.array([radius], pa.int64()), *arrays], names=_BLOCK_NAMES)

        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("vec_id", "_row", "vector")), strict=True)
            while len(held) >= BLOCK:
                yield block(held[:BLOCK])
                held = held[BLOCK:]
        if held:
            yield block(held)

    laid = vectors.mapInArrow(nearest, "vec_id long, vector binary, _row long, place long")
    laid = laid.repartitionByRange("place", "vec_id", "_row").sortWithinPartitions("place", "vec_id", "_row")
    return laid.mapInArrow(cut, _BLOCK_SCHEMA)


_SUMMARY = ["radius", "largest", "smallest", "centre"]
_BLOCK_NAMES = ["block", "radius", "ids", "keys", "matrix", "largest", "smallest", "centre", "asked", "kth"]
_BLOCK_SCHEMA = "block long, radius long, " + ", ".join(f"{c} binary" for c in _BLOCK_NAMES[2:])
_FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def _asked(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """The queries of each block: the block, row, id, vector and starting k-th score."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ids, keys, asked, kth = (np.frombuffer(r[c], "<i8") for c in ("ids", "keys", "asked", "kth"))
            x = np.frombuffer(r["matrix"], kind).reshape(len(ids), -1)
            out += [(int(keys[i]), int(ids[i]), x[i].tobytes(), int(t)) for i, t in zip(asked, kth, strict=True)]
        columns = zip(*out, strict=True) if out else [()] * 4
        types = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_row", "query_id", "vector", "kth"]
        )


def _bounds_of(q: np.ndarray, group: pd.DataFrame, kind: str) -> np.ndarray:
    largest, smallest, centre = (np.stack([np.frombuffer(b, kind) for b in group[c]]).astype(np.int64) for c in _SUMMARY[1:])
    return bounds(q, largest, smallest, centre, group["radius"].to_numpy())


def needed(queries: pd.DataFrame, group: pd.DataFrame, width: int, kind: str) -> np.ndarray:
    """The blocks of the group whose bound reaches some query's k-th score."""
    reach = _bounds_of(_matrix(queries["vector"].tolist(), width, kind), group, kind) >= queries["kth"].to_numpy()[:, None]
    return group["block"].to_numpy()[reach.any(axis=0)]


def pruned(queries: pd.DataFrame, group: pd.DataFrame, width: int, kind: str, k: int) -> pd.DataFrame:
    """Each query's best ``k`` rows of the group's blocks."""
    q = _matrix(queries["vector"].tolist(), width, kind)
    own, query_ids, kth = (queries[c].to_numpy() for c in ("query_row", "query_id", "kth"))
    kth = kth.copy()
    read = [{"ids": np.frombuffer(b["ids"], "<i8"), "keys": np.frombuffer(b["keys"], "<i8"), "matrix": np.frombuffer(b["matrix"], kind)} for b in group.to_dict("records")]
    most = _bounds_of(q, group, kind)
    order = np.argsort(-most, axis=1, kind="stable")
    have = [np.zeros((0, 3), dtype=np.int64) for _ in own]  # score, id, row
    alive = np.ones(len(own), dtype=bool)
    for step in range(len(read)):
        block_of = order[:, step]
        alive &= most[np.arange(len(own)), block_of] >= kth
        if not alive.any():
            break
        for b in np.unique(block_of[alive]):
            ask = np.flatnonzero(alive & (block_of == b))
            ids, keys = read[b]["ids"], read[b]["keys"]
            scores = products(q[ask], read[b]["matrix"].reshape(len(ids), -1).astype(np.int64))
            for i, s in zip(ask.tolist(), scores, strict=True):
                keep = np.flatnonzero((s >= kth[i]) & (keys != own[i]))
                if len(keep):
                    rows = np.concatenate([have[i], np.column_stack([s[keep], ids[keep], keys[keep]])])
                    have[i] = rows = rows[best(rows[:, 0], rows[:, 1], rows[:, 2], k)]
                    if len(rows) == k:
                        kth[i] = max(kth[i], rows[-1, 0])
    n = [len(h) for h in have]
    rows = np.concatenate(have) if have else np.zeros((0, 3), dtype=np.int64)
    return pd.DataFrame(
        {"query_row": np.repeat(own, n), "query_id": np.repeat(query_ids, n), "vec_id": rows[:, 1], "row": rows[:, 2], "score": rows[:, 0]}
    )


def top_scores(embeddings: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest integer
    inner product for each query, a row whose id is divisible by ``every``.

    Candidates are all rows but the query's own; ties go to the smaller id.  Null
    ids, null vectors and vectors with null or non-finite components take no
    part.  A shorter vector counts as ending in zeros.  A repeated row is a
    candidate, and a query, of its own.  An empty table gives an empty result.
    Components of 2^43 or more, and scores beyond 64 bits, raise.  Only ``vec_id``
    and ``embedding`` are read.
    """
    narrow = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    vectors = staged(narrow.mapInArrow(_quantised, "vec_id long, vector binary, most long").withColumn("_row", F.monotonically_increasing_id()), "search-vectors")
    longest, most = vectors.agg(F.max(F.octet_length("vector")), F.max("most")).first()
    width, kind = (longest or 0) // 8, _narrowest(most or 0)
    built = staged(blocks(vectors.drop("most"), width, kind, every, k), "search-blocks")
    asked = built.select("ids", "keys", "matrix", "asked", "kth").mapInArrow(
        lambda batches: _asked(batches, kind), "query_row long, query_id long, vector binary, kth long"
    )
    # within a file blocks are in layout order, so runs of these numbers are of like queries
    queries = staged(asked.withColumn("_order", F.monotonically_increasing_id()), "search-queries")
    groups, chunks = max(1, -(-built.count() // GROUP)), max(1, -(-queries.count() // QUERIES))

    def place(col: str, n: int) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(n))

    def every_one(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    queries = queries.withColumn("_run", F.floor(F.col("_order") / QUERIES)).withColumn("_chunk", place("_run", chunks))
    left = queries.select("*", every_one(groups).alias("_group"))
    placed = built.withColumn("_group", place("block", groups))
    summaries = placed.select("block", "_group", *_SUMMARY, every_one(chunks).alias("_chunk"))

    def screen(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        some = needed(a, b, width, kind) if len(a) and len(b) else np.zeros(0, np.int64)
        return pd.DataFrame({"block": some, "_chunk": np.full(len(some), key[0], np.int64)})

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return pruned(a, b, width, kind, k) if len(a) and len(b) else pd.DataFrame(np.zeros((0, 5), np.int64), columns=["query_row", "query_id", "vec_id", "row", "score"])

    both = ["_chunk", "_group"]
    sent = staged(left.groupBy(*both).cogroup(summaries.groupBy(*both)).applyInPandas(screen, "block long, _chunk long"), "search-needed")
    right = placed.drop("asked", "kth").join(sent, "block")
    found = left.groupBy(*both).cogroup(right.groupBy(*both)).applyInPandas(search, _FOUND)
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
