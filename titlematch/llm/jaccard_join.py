"""N-gram Jaccard join by prefix trees.

A document is the set of its distinct word shingles (as 64-bit hashes); documents
with one and the same set are one node.  Two sets of n and m shingles link at
``percent`` per cent Jaccard similarity, so they share at least ``percent * n`` and
``percent * m`` hundredths of their own shingles.

1. *Screen.*  Under any order of all shingles, two linked sets share k elements of
   their first ``n - least + k`` (``least``: the overlap that n needs at least).
   Each node gives that many of its smallest hashes, with k chosen so that half of
   them must be shared.  Hashes are only counted (a partial aggregate, so frequent
   ones collapse before the shuffle); those that occur once are handed to their
   only node.  A node with too few that occur elsewhere has no partner.
2. *Global order.*  What is left is ordered by document frequency, rarest first.
   Two linked sets share one of their first ``n - least + 1`` shingles, their
   prefixes; nodes that share one are candidates.
3. *Trees.*  A prefix shingle's nodes are grouped with its smallest node, the
   pivot.  A pivot's nodes come in blocks of bounded size, the pivot in each.  In a
   block the sets, most frequent shingle first, are stored in a prefix tree whose
   edges are runs of shingles.  A probing set walks down the tree, adds up its
   overlap with the shared runs, and leaves a subtree once the shingles remaining
   in it and in the subtree cannot reach the overlap that its lengths require.
   Sets already connected in the block are not looked for again.
4. Links are joined into components.  Where a prefix shingle still has nodes of
   several components, those outside its largest one are probed against the trees
   of all of them, block by block.

No pair list is made: a task gives at most one connection a node and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import FEW_KEYS, few, looked_up, staged, text_of
from titlematch.llm.components import smallest_reachable
from titlematch.llm.shingles import mixed, shingle_sets

WORDS, PERCENT = 3, 90
#: Nodes, and shingles, that a block of nodes holds on average.
BLOCK, BLOCK_SHINGLES = 128, 1 << 19


def least_overlap(n: Column, percent: int) -> Column:
    """Shingles that a set of ``n`` shares with any set it links with, at least."""
    return F.ceil(F.lit(percent) * n / F.lit(100.0)).cast("int")


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, head``: size and digests of a document's set,
    and its smallest hashes: twice as many as linked sets may miss, one, and one
    for what the rounding of both sizes may cost."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                sets = shingle_sets(part.column("text"), words)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                k1, k2 = _digests(sets)
                heads = [s[: 2 * (len(s) - -(-percent * len(s) // 100)) + 2] for s in sets]
                ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
                flat = np.concatenate(heads).view(np.int64) if len(heads) else np.zeros(0, np.int64)
                head = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), k1, k2, head], names=["doc_id", "n_shingles", "k1", "k2", "head"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, k1 long, k2 long, head array<long>")


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    k1 = np.array([mixed(s).sum() if len(s) else 0 for s in sets], np.uint64)
    k2 = np.array([mixed(s ^ np.uint64(0xD6E8FEB86659FD93)).sum() if len(s) else 0 for s in sets], np.uint64)
    return pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))


def screened(nodes: DataFrame, percent: int) -> DataFrame:
    """The nodes with enough shingles in their head that others have too."""
    counts = nodes.select("node", F.explode("head").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("node"))
    alone = counts.filter("_n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("_alone"))
    least = least_overlap(F.col("n_shingles"), percent)
    # of 2 * missed + 2 in the head, missed + 1 are shared with any linked set; a
    # head that is the whole set shares the least overlap
    needed = F.least(F.col("n_shingles") - least + 1, least)
    rows = nodes.withColumn("_head", F.size("head")).drop("head").join(alone, "node", "left")
    return rows.filter(F.col("_head") - F.coalesce("_alone", F.lit(0)) >= needed).drop("_alone", "_head")


def full_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` of the nodes, from whole texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = shingle_sets(part.column("text"), words)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if len(sets) else np.zeros(0, np.int64)
                shingles = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_digests(sets), shingles], names=["_doc", "k1", "k2", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    own = nodes.select("node", "least", "k1", "k2")
    if nodes.count() <= FEW_KEYS:
        own = F.broadcast(own)
    rows = rows.join(own.select(F.col("least").alias("doc_id")), "doc_id", "left_semi")
    sets = rows.mapInArrow(read, "_doc long, k1 long, k2 long, shingles array<long>")
    # a document's id alone may be that of several rows
    same = (sets["k1"] == own["k1"]) & (sets["k2"] == own["k2"]) & (F.col("_doc") == F.col("least"))
    return sets.join(own, same).select("node", "shingles").dropDuplicates(["node"])


def ordered(sets: DataFrame, percent: int) -> DataFrame:
    """``node, n, shingles, counts, prefix``: the sets in global order (rarest
    first, then by hash), the frequencies, and the prefix shared with others."""
    pairs = sets.select("node", F.explode("shingles").alias("shingle"))
    counts = staged(pairs.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "jaccard-counts")
    both = looked_up(pairs, ["shingle"], counts.withColumn("rows", F.col("n")), "rows", "n", F.col("node"))
    n = F.coalesce("n", F.lit(1)).cast("int")
    rows = both.groupBy("node").agg(F.sort_array(F.collect_list(F.struct(n.alias("n"), "shingle"))).alias("s"))
    size = F.size("s")
    prefix = F.filter(F.slice("s", 1, size - least_overlap(size, percent) + 1), lambda x: x["n"] > 1)
    return rows.select(
        "node", size.alias("n"), F.col("s.shingle").alias("shingles"), F.col("s.n").alias("counts"), F.transform(prefix, lambda x: x["shingle"]).alias("prefix")
    )


# ------------------------------------------------------------------ prefix tree


class PrefixTree:
    """Sorted sequences of ranks as a tree whose edges are runs of ranks."""

    def __init__(self, sequences: list[np.ndarray]):
        self.sequences = sequences
        self.order = order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.common = [0] * len(order)  # ranks shared with the sequence before
        for i in range(1, len(order)):
            a, b = sequences[order[i - 1]], sequences[order[i]]
            k = min(len(a), len(b))
            other = np.flatnonzero(a[:k] != b[:k])
            self.common[i] = int(other[0]) if len(other) else k
        # a node: first and last sequence, where its edge starts and ends, the
        # shortest and longest sequence below, its children
        self.nodes: list[tuple[int, int, int, int, int, int, list[int]]] = []
        todo = [(0, len(order), 0, None)] if order else []
        while todo:
            lo, hi, start, parent = todo.pop()
            sizes = [len(sequences[order[i]]) for i in range(lo, hi)]
            end = min(self.common[lo + 1 : hi], default=sizes[0])
            me = len(self.nodes)
            self.nodes.append((lo, hi, start, end, min(sizes), max(sizes), []))
            if parent is not None:
                self.nodes[parent][6].append(me)
            if hi - lo > 1:
                cuts = [lo, *(i for i in range(lo + 1, hi) if self.common[i] == end), hi]
                todo += [(a, b, end, me) for a, b in zip(cuts, cuts[1:], strict=False)]


def required(n: int, m: int, percent: int) -> int:
    """The overlap at which sets of ``n`` and ``m`` link."""
    return -(-percent * (n + m) // (100 + percent))


class _Labels:
    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[self.root(x)] = self.root(y)


def ranked(sets: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """The sets as sorted ranks, the most frequent shingle first."""
    hashes, first, place = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
    rank = np.empty(len(hashes), np.int64)
    rank[np.lexsort((hashes, -np.concatenate(counts)[first]))] = np.arange(len(hashes))
    ends = np.cumsum([0, *map(len, sets)])
    flat = rank[place.reshape(-1)]
    return [np.sort(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def tree_links(
    sequences: list[np.ndarray], labels: list[int], stored: list[int], probes: list[int], percent: int
) -> list[tuple[int, int]]:
    """Links between ``probes`` and ``stored`` (places in ``sequences``) that
    connect different labels, no two of them the same labels."""
    joined, links = _Labels(), []
    tree = PrefixTree([sequences[i] for i in stored])
    order = [stored[i] for i in tree.order]
    probing = set(probes)

    def link(i: int, j: int) -> None:
        links.append((i, j))
        joined.join(labels[i], labels[j])

    # neighbours in the tree share the most: they are linked first
    for at in range(1, len(order)):
        i, j = order[at - 1], order[at]
        if (i in probing or j in probing) and joined.root(labels[i]) != joined.root(labels[j]):
            n, m = len(sequences[i]), len(sequences[j])
            if len(np.intersect1d(sequences[i], sequences[j], assume_unique=True)) >= required(n, m, percent):
                link(i, j)
    # below a node all may be connected by now
    roots = [joined.root(labels[i]) for i in order]
    change = np.cumsum([0, *(a != b for a, b in zip(roots, roots[1:], strict=False))])
    has = np.zeros(1 + max((int(s[-1]) for s in sequences if len(s)), default=0), dtype=bool)
    for i in probes:
        own = sequences[i]
        n, shortest, longest = len(own), -(-percent * len(own) // 100), 100 * len(own) // percent
        has[own] = True
        todo = [(0, 0)] if tree.nodes else []
        while todo:
            at, overlap = todo.pop()
            lo, hi, start, end, least, most, below = tree.nodes[at]
            if most < shortest or least > longest:
                continue
            if change[hi - 1] == change[lo] and joined.root(roots[lo]) == joined.root(labels[i]):
                continue
            if end > start:
                run = sequences[order[lo]][start:end]
                overlap += int(has[run].sum())
                left = n - int(np.searchsorted(own, run[-1], side="right"))
            else:
                left = n
            if overlap + min(left, most - end) < required(n, max(least, shortest), percent):
                continue
            if hi - lo > 1:
                todo += [(child, overlap) for child in below]
            elif joined.root(labels[i]) != joined.root(labels[order[lo]]) and overlap >= required(n, most, percent):
                link(i, order[lo])
        has[own] = False
    return links


# --------------------------------------------------------------------- blocks


def _arrays(df: pd.DataFrame) -> list[np.ndarray]:
    sets = [np.asarray(s, dtype=np.int64) for s in df["shingles"]]
    return ranked(sets, [np.asarray(c, dtype=np.int64) for c in df["counts"]])


def _pairs(labels: list[int], links: list[tuple[int, int]]) -> pd.DataFrame:
    """What the links connect, as stars: each label with the smallest one of its
    component, so that no chain of links has to be followed later."""
    joined, least, seen = _Labels(), {}, set()
    for i, j in links:
        joined.join(labels[i], labels[j])
        seen |= {labels[i], labels[j]}
    for x in seen:
        least[joined.root(x)] = min(x, least.get(joined.root(x), x))
    stars = [(least[joined.root(x)], x) for x in seen if least[joined.root(x)] != x]
    return pd.DataFrame(stars, columns=["a", "b"], dtype=np.int64)


def _blocks(rows: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES)).cast("long")


def _stars(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``_pivot, node, n`` and, per pivot, the number ``_of`` of its blocks."""
    stars = staged(members.select("_pivot", "node", "n").distinct(), "jaccard-stars")
    sizes = stars.groupBy("_pivot").agg(_blocks(F.count(F.lit(1)), F.sum("n")).alias("_of"), F.count(F.lit(1)).alias("_rows"))
    return stars, staged(sizes, "jaccard-sizes")


def _star_links(stars: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What is connected within each pivot's blocks."""
    asked = looked_up(stars.filter("node <> _pivot"), ["_pivot"], sizes, "_rows", "_of", F.col("node"))
    own = asked.select("_pivot", "node", F.pmod(F.xxhash64("node"), "_of").alias("_block"))
    pivots = sizes.select("_pivot", F.col("_pivot").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_of") - 1)).alias("_block"))
    rows = own.union(pivots).join(sets.select("node", "shingles", "counts"), "node")

    def link(block: pd.DataFrame) -> pd.DataFrame:
        nodes, every = block["node"].tolist(), list(range(len(block)))
        return _pairs(nodes, tree_links(_arrays(block), nodes, every, every, percent))

    return rows.groupBy("_pivot", "_block").applyInPandas(link, "a long, b long")


def _cross_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Connections between components whose nodes still share a prefix shingle."""
    members = members.join(labels, "node", "left").select("shingle", "node", "n", F.coalesce("label", "node").alias("label"))
    members = staged(members, "jaccard-labelled")
    parts = members.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("_n"))
    main = parts.groupBy("shingle").agg(F.max(F.struct("_n", "label")).alias("_m"), F.count(F.lit(1)).alias("_parts"))
    main = staged(main.filter("_parts > 1").select("shingle", F.col("_m.label").alias("_main")), "jaccard-mixed")
    gathered = staged(members.join(main, "shingle").select("_main", "node", "n", "label").distinct(), "jaccard-gathered")
    outer = F.col("label") != F.col("_main")
    sizes = gathered.groupBy("_main").agg(
        _blocks(F.count(F.lit(1)), F.sum("n")).alias("_right"),
        _blocks(F.count(F.when(outer, 1)), F.coalesce(F.sum(F.when(outer, F.col("n"))), F.lit(0))).alias("_left"),
    )
    rows = gathered.drop("n").join(staged(sizes, "jaccard-sizes"), "_main").join(sets.select("node", "shingles", "counts"), "node")
    rows = staged(rows, "jaccard-rows")
    place = F.xxhash64("node")

    def upto(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    left = rows.filter(outer).select("*", F.pmod(place, "_left").alias("_i"), upto("_right").alias("_j"))
    right = rows.select("*", upto("_left").alias("_i"), F.pmod(place, "_right").alias("_j"))
    keys = ["_main", "_i", "_j"]

    def link(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return _pairs([], [])
        both = pd.concat([a, b], ignore_index=True)
        probes, stored = list(range(len(a))), list(range(len(a), len(both)))
        labels = both["label"].tolist()
        return _pairs(labels, tree_links(_arrays(both), labels, stored, probes, percent))

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(link, "a long, b long")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """``node, label`` of the linked nodes; ``sets`` as ``ordered`` gives them."""
    keys = sets.select("node", "n", F.explode("prefix").alias("shingle"))
    shared = keys.groupBy("shingle").agg(F.min("node").alias("_pivot"), F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    shared = staged(shared, "jaccard-keys")
    members = staged(looked_up(keys, ["shingle"], shared, "_rows", "_pivot", F.col("node")).filter("_pivot IS NOT NULL"), "jaccard-members")
    stars, sizes = _stars(members)
    found = staged(_star_links(stars, sizes, sets, percent), "jaccard-links")
    labels = smallest_reachable(found, repeated=False)
    # the nodes of a pivot with one block have met there already
    split = sizes.filter("_of > 1")
    if split.isEmpty():
        return labels
    apart = members.join(few(split.select("_pivot")), "_pivot", "left_semi").select("shingle", "node", "n")
    more = staged(_cross_links(apart, labels, sets, percent), "jaccard-links")
    return labels if more.isEmpty() else smallest_reachable(found.union(more), repeated=False)


def jaccard_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Documents with ``100 * |intersection| >= percent * |union|`` of their sets of
    ``words``-word shingles are linked, and ``component_id`` is the smallest id
    reachable.  A text with fewer words is one shingle; null, empty and blank texts
    have none and are linked with nothing.  Rows with a null id take no part and
    have a null component.  Rows that repeat an id are documents of their own with
    the same id.  An empty table gives an empty result.  Only ``doc_id`` and
    ``text`` are read.
    """
    signed = staged(signatures(docs, words, percent).withColumn("_at", F.monotonically_increasing_id()), "jaccard-signed")
    some = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # the row that stands for a set, the smallest id that has it, and how many have
    own = some.groupBy("k1", "k2", "n_shingles").agg(F.min("_at").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("_rows"))
    nodes = staged(own, "jaccard-nodes")
    heads = some.select(F.col("_at").alias("node"), "head").join(nodes.drop("_rows"), "node")
    left = staged(screened(staged(heads, "jaccard-heads"), percent), "jaccard-screened")
    sets = staged(full_sets(docs, left, words), "jaccard-sets")
    labels = links(staged(ordered(sets, percent), "jaccard-ordered"), percent)
    classes = nodes.join(labels, "node", "left").withColumn("_label", F.coalesce("label", "node"))
    classes = staged(classes.select("k1", "k2", "n_shingles", "least", "_label", "_rows", "node"), "jaccard-classes")
    ids = classes.groupBy("_label").agg(F.min("least").alias("_class"), F.count(F.lit(1)).alias("_sets"))
    classes = looked_up(classes, ["_label"], ids, "_sets", "_class", F.col("node"))
    # rows without shingles ask for nothing
    signed = signed.withColumn("k1", F.when(F.col("n_shingles") > 0, F.col("k1")))
    out = looked_up(signed, ["k1", "k2", "n_shingles"], classes, "_rows", "_class", F.col("_at"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_class", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
