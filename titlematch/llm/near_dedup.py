"""MinHash near-dedup with b-bit signatures.

A document is the set of its distinct word shingles.  ``BANDS * ROWS`` hash
functions take minima over the set.  Full minima make the band keys; of each
minimum only ``BITS`` low bits are kept and packed into ``SIG_LONGS`` longs.

1. Documents with one and the same set are one node (named by the smallest id).
2. Nodes that share a band key are candidates.  A bucket emits a star, every
   member with one pivot, not its pairs.  A pair passes on when the sizes allow
   the similarity at all and the collision-corrected estimate, from bit counts of
   the packed signatures, is not hopeless (``SLACK`` below the threshold, almost
   six standard errors).
3. What passes is confirmed on the full sets, and confirmed links are joined
   into components.
4. Where a bucket still holds several components, what stands outside its
   largest one is compared with all its members, block by block inside tasks:
   screened on signatures and band keys alone, then confirmed.  Only documents
   that the screen lets meet another one in a block bring their texts there, and
   only confirmed links leave a task.  So no pair of a bucket is left untested
   unless its ends are already connected, and no list of a bucket's pairs is ever
   made.

A pair at exactly the threshold 0.8 shares none of 36 bands of 5 rows with
probability (1 - 0.8^5)^36, below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import few, staged, text_of
from titlematch.llm.components import smallest_reachable
from titlematch.llm.shingles import mixed, shingle_sets

BANDS, ROWS, BITS = 36, 5, 4
HASHES = BANDS * ROWS
SIG_LONGS = -(-HASHES * BITS // 64)
SLACK = 0.18
#: Documents on each side of a block.
BLOCK = 512
#: Shingles whose hashes are minimised at a time (fits a core's cache).
SLICE = 1 << 15

_RNG = np.random.default_rng(7)
_XOR = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SIG = [f"s{i}" for i in range(SIG_LONGS)]


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``HASHES`` 32-bit minima per non-empty set."""
    out = np.full((HASHES, len(sets)), 0xFFFFFFFF, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    a = 0
    while a < len(sets):
        b, n = a + 1, sizes[a]
        while b < len(sets) and n + sizes[b] <= SLICE:
            n += sizes[b]
            b += 1
        x = np.concatenate(sets[a:b])
        starts = np.cumsum(sizes[a:b]) - sizes[a:b]
        x = (x >> np.uint64(32)).astype(np.uint32) ^ x.astype(np.uint32)
        for i in range(HASHES):
            out[i, a:b] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], starts)
        a = b
    return out.T


def packed(minimum: np.ndarray) -> np.ndarray:
    """``BITS`` bits of each minimum, packed into longs."""
    low = ((minimum >> np.uint32(11)) & np.uint32((1 << BITS) - 1)).astype(np.uint64)
    per = 64 // BITS
    low = np.pad(low, ((0, 0), (0, SIG_LONGS * per - HASHES))).reshape(len(low), SIG_LONGS, per)
    return np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def band_keys(minimum: np.ndarray) -> np.ndarray:
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(minimum), BANDS)) + np.uint64(1)
    rows = minimum.reshape(len(minimum), BANDS, ROWS).astype(np.uint64)
    for j in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
    return key


_SCHEMA = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, " + ", ".join(f"{s} long" for s in _SIG)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per document: size and two digests of its set, band keys, signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sets = shingle_sets(part.column("text"), words)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                k1, k2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                for i in full:
                    k1[i] = mixed(sets[i]).sum()
                    k2[i] = mixed(sets[i] ^ np.uint64(0xD6E8FEB86659FD93)).sum()
                low = minima([sets[i] for i in full]) if len(full) else np.zeros((0, HASHES), np.uint32)
                sig = np.zeros((len(n), SIG_LONGS), np.uint64)
                sig[full] = packed(low)
                ends = np.cumsum(np.append(0, (n > 0) * BANDS)).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(band_keys(low).reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), bands]
                    + [pa.array(sig[:, i].copy().view(np.int64)) for i in range(SIG_LONGS)],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", *_SIG],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, _SCHEMA)


def estimate(left: str, right: str) -> Column:
    """Collision-corrected similarity from the packed signatures of two sides."""
    lanes = int(("0" * (BITS - 1) + "1") * (64 // BITS), 2)  # the low bit of every value
    differ = F.lit(0)
    for s in _SIG:
        x = F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))
        spread = x
        for k in range(1, BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(x, k))
        differ = differ + F.bit_count(spread.bitwiseAND(F.lit(lanes)))
    chance = 2.0**-BITS
    return (1.0 - differ / F.lit(float(HASHES)) - chance) / (1.0 - chance)


def _screened(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and signatures allow the similarity."""
    sig = nodes.select("node", "n_shingles", *_SIG)
    low, high = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
    return (
        pairs.alias("p")
        .join(sig.alias("x"), F.col("p.a") == F.col("x.node"))
        .join(sig.alias("y"), F.col("p.b") == F.col("y.node"))
        .filter((100 * low >= percent * high) & (estimate("x", "y") >= percent / 100 - SLACK))
        .select("p.a", "p.b")
    )


def alike(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    small, large = (s, t) if len(s) <= len(t) else (t, s)
    if not len(small):
        return False
    place = np.searchsorted(large, small)
    both = int((large[np.minimum(place, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(s) + len(t) - both)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that are alike on their full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (None, None)  # rows come sorted by b: its set is made once
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                b, right, keep = part.column("b").to_pylist(), part.column("_tb"), []
                for i, s in enumerate(shingle_sets(part.column("_ta"), words)):
                    if b[i] != held[0]:
                        held = (b[i], shingle_sets(right.slice(i, 1), words)[0])
                    keep.append(alike(s, held[1], percent))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ta = texts.select(F.col("node").alias("a"), F.col("_text").alias("_ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("_text").alias("_tb"))
    both = pairs.join(ta, "a").join(tb, "b").select("a", "b", "_ta", "_tb")
    return both.mapInArrow(confirm, "a long, b long")


def _candidates(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places in ``left`` and, for each, those in ``right`` that have another label
    and a band key in common and whose sizes and signatures allow the similarity.
    ``marks`` holds a document's signature, then its band keys."""
    own, marks = (np.stack(side["marks"].to_numpy()).astype(np.int64) for side in (left, right))
    bands, sigs = marks[:, SIG_LONGS:], marks[:, :SIG_LONGS].view(np.uint64)
    own_bands, own_sigs = own[:, SIG_LONGS:], own[:, :SIG_LONGS].view(np.uint64)
    lanes, per = np.uint64(int(("0" * (BITS - 1) + "1") * (64 // BITS), 2)), right["n_shingles"].to_numpy()
    nodes, labels = right["node"].to_numpy(), right["label"].to_numpy()
    outside = labels != right["_main"].to_numpy()
    asking = zip(left["node"].tolist(), left["label"].tolist(), left["n_shingles"].tolist(), strict=True)
    for i, (node, label, size) in enumerate(asking):
        x = sigs ^ own_sigs[i]
        spread = x.copy()
        for k in range(1, BITS):
            spread |= x >> np.uint64(k)
        differ = np.bitwise_count(spread & lanes).sum(axis=1)
        near = (1 - differ / HASHES - 2.0**-BITS) / (1 - 2.0**-BITS) >= percent / 100 - SLACK
        near &= 100 * np.minimum(per, size) >= percent * np.maximum(per, size)
        near &= (labels != label) & (~outside | (nodes > node))
        found = np.flatnonzero(near)
        found = found[(bands[found] == own_bands[i]).any(axis=1)]
        if len(found):
            yield i, found


def _pairings(left: pd.DataFrame, right: pd.DataFrame, words: int, percent: int) -> list[tuple[int, int]]:
    """Confirmed links between candidates of ``left`` and of ``right``.  A link
    joins its labels, and pairs of joined labels are not looked at again."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    sets: dict[int, np.ndarray] = {}

    def set_of(node: int, text: str) -> np.ndarray:
        if node not in sets:
            sets[node] = shingle_sets(pa.array([text]), words)[0]
        return sets[node]

    own, nodes = left["node"].tolist(), right["node"].tolist()
    own_label, labels = left["label"].tolist(), right["label"].tolist()
    own_text, texts = left["text"].tolist(), right["text"].tolist()
    links = []
    for i, found in _candidates(left, right, percent):
        for j in found.tolist():
            if root(own_label[i]) != root(labels[j]) and alike(set_of(own[i], own_text[i]), set_of(nodes[j], texts[j]), percent):
                links.append((own[i], nodes[j]))
                parent[root(own_label[i])] = root(labels[j])
    return links


def _between(members: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between different components whose members share a bucket.

    ``members``: ``key, node, label``.  The buckets that hold several components
    are gathered by their main (largest) component.  What stands outside of it is
    compared with all members, in blocks of ``BLOCK`` by ``BLOCK`` documents, each
    a group of its own.  A block first screens signatures and tells which of its
    documents have a candidate in it (no pairs); those come again with their texts,
    and only confirmed links leave the block."""
    parts = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("_n"))
    main = parts.groupBy("key").agg(F.max(F.struct("_n", "label")).alias("_m"), F.count(F.lit(1)).alias("_parts"))
    main = staged(main.filter("_parts > 1").select("key", F.col("_m.label").alias("_main")), "near-mixed")
    gathered = staged(members.join(main, "key").select("_main", "node", "label").distinct(), "near-gathered")
    sizes = gathered.groupBy("_main").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("_right"), F.ceil(F.count(F.when(F.col("label") != F.col("_main"), 1)) / BLOCK).alias("_left")
    )
    marks = F.concat(F.array(*_SIG), "bands")  # one column: blocks are many, and their cost is by column
    rows = gathered.join(staged(sizes, "near-sizes"), "_main").join(nodes.select("node", "n_shingles", marks.alias("marks")), "node")
    rows = staged(rows, "near-block-rows")
    place = F.xxhash64("node")
    left = rows.filter("label <> _main").select(
        "*", F.pmod(place, "_left").alias("_i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_right") - 1)).alias("_j")
    )
    right = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_left") - 1)).alias("_i"), F.pmod(place, "_right").alias("_j"))
    keys = ["_main", "_i", "_j"]

    def screen(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = list(_candidates(a, b, percent)) if len(a) and len(b) else []
        asking = a["node"].to_numpy()[[i for i, _ in found]] if found else []
        asked = b["node"].to_numpy()[np.unique(np.concatenate([j for _, j in found]))] if found else []
        out = pd.DataFrame({"node": np.concatenate([asking, asked]).astype(np.int64), "_asks": np.arange(len(asking) + len(asked)) < len(asking)})
        return out.assign(**dict(zip(keys, key, strict=True)))[[*keys, "node", "_asks"]]

    def compare(both: pd.DataFrame) -> pd.DataFrame:
        links = _pairings(both[both["_asks"]], both[~both["_asks"]], words, percent)
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    wanted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(screen, "_main long, _i long, _j long, node long, _asks boolean")
    wanted = staged(wanted, "near-wanted").join(rows.drop("_left", "_right"), ["_main", "node"])
    return wanted.join(texts.withColumnRenamed("_text", "text"), "node").groupBy(*keys).applyInPandas(compare, "a long, b long")


def near_links(docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """``node, label`` of the nodes that are linked with another one."""
    keys = nodes.select(F.explode("bands").alias("key"), "node")
    # written, so that the join below shuffles both sides anew and a hot key can be split
    shared = keys.groupBy("key").agg(F.min("node").alias("_pivot"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    members = staged(keys.join(staged(shared, "near-keys"), "key"), "near-buckets")
    involved = members.select("node").distinct()
    nodes = staged(nodes.drop("k1", "k2").join(involved, "node", "left_semi"), "near-nodes")
    texts = staged(
        docs.select(F.col("doc_id").cast("long").alias("node"), text_of().alias("_text")).join(few(nodes.select("node")), "node", "left_semi"),
        "near-texts",
    )
    stars = members.filter("node <> _pivot").select(F.col("_pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = staged(_screened(stars, nodes, percent), "near-pairs")
    links = staged(_confirmed(stars, texts, words, percent), "near-links")
    labels = smallest_reachable(links)
    members = members.filter("_n > 2").select("key", "node")  # with two members the star was all
    members = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    more = staged(_between(staged(members, "near-members"), nodes, texts, words, percent), "near-links")
    return labels if more.isEmpty() else smallest_reachable(links.union(more))


def near_classes(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents with ``100 * |intersection| >= percent * |union|`` of their sets of
    ``words``-word shingles are linked; ``component_id`` is the smallest id
    reachable and ``kept`` says that it is the document's own.  A text with fewer
    words is one shingle; null, empty and blank texts have none, are linked with
    nothing and stay.  Rows with a null id take no part, have a null class and
    stay.  Repeated rows of one id are one document.  An empty table gives an
    empty result.  Only ``doc_id`` and ``text`` are read.
    """
    signed = staged(signatures(docs, words), "near-signatures")
    nodes = staged(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("k1", "k2", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), *[F.first(s).alias(s) for s in _SIG]),
        "near-sets",
    )
    labels = near_links(docs, nodes, words, percent)
    classes = nodes.select("k1", "k2", "n_shingles", "node").join(labels, "node", "left")
    classes = classes.select("k1", "k2", "n_shingles", F.coalesce("label", "node").alias("_class"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_class", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "k1", "k2")
        .join(classes, ["k1", "k2", "n_shingles"], "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
    )


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each class stays (the one with the smallest id), all its
    columns."""
    dropped = staged(near_classes(docs, words, percent).filter("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct(), "near-dropped")
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"))
    return rows.join(few(dropped), F.col("_doc") == F.col("_dropped"), "left_anti").select("_row.*")
