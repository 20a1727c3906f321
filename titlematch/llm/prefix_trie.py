"""Conversation prefix trie by truncation peeling.

Every conversation is rebuilt as a branch of the first of its hundred (it starts
with that one's first turns), and the trie of all rebuilt conversations is
aggregated while it is taken apart from the bottom.

* *Turns.*  A turn is a token: 128 bits of the SHA-256 of its role and text, and the
  text's length.  Texts are read once and not shuffled.  Turns are numbered by
  ranges of (conversation, turn) with the counts of the ranges before, so a
  conversation of very many turns is spread over tasks.
* *Paths.*  A rebuilt conversation is cut into segments of ``SEGMENT`` turns; a row
  holds a segment as the string of its tokens, and 128 bits (``h1, h2``) that stand
  for all segments before it.  Conversations with equal turns are merged to one
  sequence with a count at once.
* *Peeling.*  From the maximum depth on, sequences that end at a depth are merged
  with the nodes that survived from the depth below (one aggregate by path, so
  a hot prefix collapses before the shuffle); the groups are the nodes of that
  depth, with members, children, leaves and saved tokens complete.  They lose their
  last turn and go on as survivors of the next depth.  At the top of a segment the
  survivors take up the segment before it.
* *Solitary tails.*  From the first segment on whose beginning no other sequence has,
  all nodes of a sequence have one child each and the same members.  They are
  written at once from the segments, so the number of rounds is the depth to which
  different sequences agree, not that of the longest one.

A node's parent is found by the 128 bits that stand for its path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlematch.llm.base import few, looked_up, new_folder, staged

#: Conversations of a family, and most turns taken from its first one, plus one.
FAMILY, HEADS = 100, 6
#: Turns of a segment; characters of a token: digest and length.
SEGMENT = 8
_DIGEST, _LENGTH = 32, 8
TOKEN = _DIGEST + _LENGTH
#: Segments of a conversation that one window orders.
BLOCK = 1024
#: Ids in a piece of a node's list of ended conversations.
PIECE = 4096
_NONE = hashlib.sha256(b"").hexdigest()


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, token``: each conversation's turns, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, _DIGEST)
    token = F.concat(digest, F.lpad(F.lower(F.hex(F.length(text).cast("long"))), _LENGTH, "0"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", token.alias("token"))
    # equal turns of one conversation may stand in any order; the row's place spreads them
    order = ["conv_id", "turn", "token", "_at"]
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()).drop("_at"), "trie-turns")
    counts = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("_n"))
    # a conversation in several ranges has the rows of the ranges before
    before = F.coalesce(F.sum("_n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("conv_id", "part", before.alias("_before"))
    local = F.row_number().over(W.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "token"))
    numbered = dealt.withColumn("_local", local).join(offsets, ["conv_id", "part"])
    return numbered.select("conv_id", "part", (F.col("_before") + F.col("_local")).alias("pos"), "token")


def _taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, token`` of the rebuilt conversations, and all ids."""
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = staged(own.select("conv_id", "part").distinct(), "trie-parts")
    every = ids.select("conv_id").distinct().select("conv_id", family.alias("_first"), _taken(F.col("conv_id")).alias("_h"))
    # a family is at most 2 * FAMILY ids, its first conversation's head HEADS - 1 turns
    heads = own.filter((F.col("pos") < HEADS) & (family == F.col("conv_id"))).select(F.col("conv_id").alias("_first"), "pos", "token")
    every, heads = staged(every, "trie-conversations"), staged(heads, "trie-heads")
    found = every.join(heads, "_first").filter("pos <= _h")
    begun = found.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_begun"))
    # the own rows of a long conversation lie in many ranges, and ask by range
    asked = ids.join(every, "conv_id").join(begun, "conv_id", "left").select("conv_id", "part", "_h", F.coalesce("_begun", F.lit(0)).alias("_begun"))
    rest = own.join(asked, ["conv_id", "part"]).filter("pos > _h")
    rows = found.select("conv_id", F.col("pos").alias("depth"), "token").union(
        rest.select("conv_id", (F.col("pos") - F.col("_h") + F.col("_begun")).alias("depth"), "token")
    )
    return rows, every.select("conv_id")


def _last_length(path: Column) -> Column:
    """Code points of the last turn's text."""
    return F.conv(F.substring(path, -_LENGTH, _LENGTH), 16, 10).cast("long")


def _lanes(level: Column, path: Column) -> list[Column]:
    """128 bits that stand for a segment at its place."""
    return [F.xxhash64(level, path), F.xxhash64(path, F.lit("path"), level)]


def _xor(h: Column, lane: Column) -> Column:
    return h.bitwiseXOR(lane)


def _part(depth: Column) -> Column:
    return F.floor((depth - 1) / SEGMENT).cast("long")


def segments(rows: DataFrame) -> DataFrame:
    """``conv_id, level, block, path, n, chars, x1, x2``: the segments."""
    gathered = rows.groupBy("conv_id", _part(F.col("depth")).alias("level")).agg(F.sort_array(F.collect_list(F.struct("depth", "token"))).alias("s"))
    path = F.array_join(F.col("s.token"), "")
    lengths = F.transform("s", lambda t: F.conv(F.substring(t["token"], -_LENGTH, _LENGTH), 16, 10).cast("long"))
    chars = F.aggregate(lengths, _long(0), lambda a, x: a + x)
    out = gathered.select("conv_id", "level", path.alias("path"), F.size("s").alias("n"), chars.alias("chars"))
    x1, x2 = _lanes(F.col("level"), F.col("path"))
    return out.select("*", F.floor(F.col("level") / BLOCK).alias("block"), x1.alias("x1"), x2.alias("x2"))


def _blocks(df: DataFrame, levels: Column) -> DataFrame:
    """A row a block of a sequence's segments, so that long ones are split."""
    last = F.floor(F.greatest(levels - 1, _long(0)) / BLOCK)
    return df.withColumn("block", F.explode(F.sequence(_long(0), last)))


def sequences(pieces: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sequences (``conv_id``: the smallest with it, ``n_convs``,
    ``levels, depth, chars``) and each conversation's digests."""
    whole = pieces.groupBy("conv_id").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("n").alias("depth"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("levels")
    )
    zero = [F.coalesce(c, _long(0)).alias(c) for c in ("x1", "x2", "depth", "chars", "levels")]
    whole = staged(ids.join(whole, "conv_id", "left").select("conv_id", *zero), "trie-wholes")
    distinct = whole.groupBy("x1", "x2", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("chars").alias("chars"), F.first("levels").alias("levels")
    )
    return staged(distinct, "trie-sequences"), whole


def placed(pieces: DataFrame, distinct: DataFrame) -> DataFrame:
    """The segments of the distinct sequences, with what stands before each:
    ``h1, h2`` and ``before``, the text of the turns above it."""
    kept = _blocks(distinct.select("conv_id", "levels", "n_convs", F.col("depth").alias("all_depth"), F.col("chars").alias("all_chars")), F.col("levels"))
    rows = pieces.join(kept, ["conv_id", "block"])
    inside = W.partitionBy("conv_id", "block").orderBy("level").rowsBetween(W.unboundedPreceding, -1)
    xors = [F.coalesce(F.bit_xor(x).over(inside), _long(0)) for x in ("x1", "x2")]
    rows = rows.withColumns({"h1": xors[0], "h2": xors[1], "before": F.coalesce(F.sum("chars").over(inside), _long(0))})
    sums = pieces.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("_b1"), F.bit_xor("x2").alias("_b2"), F.sum("chars").alias("_b"))
    above = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", *[f.over(above).alias(c) for c, f in (("_o1", F.bit_xor("_b1")), ("_o2", F.bit_xor("_b2")), ("_o", F.sum("_b")))])
    rows = rows.join(few(sums.filter("block > 0")), ["conv_id", "block"], "left")
    here = {c: f(F.col(c), F.coalesce(o, _long(0))) for c, o, f in (("h1", "_o1", _xor), ("h2", "_o2", _xor), ("before", "_o", lambda a, b: a + b))}
    return rows.withColumns(here).drop("_o1", "_o2", "_o", "x1", "x2")


_NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ended long, k1 long, k2 long, u1 long, u2 long, parent long"


def _nodes(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.select(*[columns.get(f.split()[0], F.col(f.split()[0])).cast("long").alias(f.split()[0]) for f in _NODE.split(", ")])


def solitary(tails: DataFrame) -> DataFrame:
    """The nodes of solitary tails: one a turn, from the segments."""
    place = F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("_i", "_j")
    rows = tails.select("*", place).withColumn("depth", F.col("level") * SEGMENT + F.col("_j"))
    head = F.substring("path", F.lit(1), F.col("_j") * TOKEN)
    up = F.substring("path", F.lit(1), (F.col("_j") - 1) * TOKEN)
    lengths = F.transform(F.sequence(F.lit(0), F.col("_j") - 2), lambda i: F.conv(F.substring(F.col("path"), i * TOKEN + _DIGEST + 1, F.lit(_LENGTH)), 16, 10).cast("long"))
    above = F.when(F.col("_j") > 1, F.aggregate(lengths, _long(0), lambda a, x: a + x)).otherwise(0)
    after = F.col("all_chars") - F.col("before") - above  # its own text and all below
    last, first = F.col("depth") == F.col("all_depth"), F.col("depth") == F.col("_from") * SEGMENT + 1
    keys = [_xor(F.col(h), lane) for h, lane in zip(("h1", "h2"), _lanes(F.col("level"), head), strict=True)]
    ups = [F.when(F.col("_j") > 1, _xor(F.col(h), lane)).otherwise(F.col(h)) for h, lane in zip(("h1", "h2"), _lanes(F.col("level"), up), strict=True)]
    return _nodes(
        rows, n_children=F.when(last, 0).otherwise(1), n_leaves=F.lit(1), saved_tokens=(F.col("n_convs") - 1) * after, ended=F.when(last, F.col("conv_id")),
        k1=keys[0], k2=keys[1], u1=F.when(first, ups[0]), u2=F.when(first, ups[1]), parent=F.when(~first, F.col("conv_id")),
    )


_STATE = ["h1", "h2", "path", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended"]


def peeled(segs: DataFrame, entries: DataFrame, tops: dict[int, int], folder: str) -> None:
    """Writes the nodes of all levels in ``tops`` (level -> deepest place in it)
    under ``folder``.  ``entries``: sequences and stubs of solitary tails, by the
    level and place at which they come in."""
    spark = segs.sparkSession
    survivors = None
    for level in sorted(tops, reverse=True):
        if survivors is not None:  # at the top of the segment below: take up this one
            own = segs.filter(F.col("level") == level).select("conv_id", "h1", "h2", "path")
            survivors = staged(survivors.drop("h1", "h2", "path").join(own, "conv_id").select(*_STATE), "trie-survivors")
        for place in range(SEGMENT if survivors is not None else tops[level], -1, -1):
            coming = entries.filter((F.col("level") == level) & (F.col("place") == place)).select(*_STATE)
            rows = coming if survivors is None else coming.union(survivors)
            sums = {c: F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
            met = rows.groupBy("h1", "h2", "path").agg(F.min("conv_id").alias("conv_id"), *sums.values(), F.min("ended").alias("ended"))
            if place == 0 and level > 0:
                survivors = staged(met.select(*_STATE), "trie-survivors")
                break
            leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))
            saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * (_last_length(F.col("path")) if place else _long(0))
            nodes = _written(met.withColumns({"n_leaves": leaves, "saved_tokens": saved}), level, place, folder)
            if place == 0:
                return
            stripped = F.substring("path", 1, TOKEN * (place - 1))
            survivors = nodes.withColumns({"path": stripped, "n_children": _long(1), "ended": F.lit(None).cast("long")}).select(*_STATE)


def _written(nodes: DataFrame, level: int, place: int, folder: str) -> DataFrame:
    """Writes the nodes of one depth in a folder of their own and reads them back."""
    h, up = [F.col("h1"), F.col("h2")], F.substring("path", 1, TOKEN * max(place - 1, 0))
    here, above = _lanes(_long(level), F.col("path")), _lanes(_long(level), up)
    keys = [_xor(a, b) for a, b in zip(h, here, strict=True)] if place else [_long(0)] * 2
    ups = [_xor(a, b) for a, b in zip(h, above, strict=True)] if place > 1 else h if place else [F.lit(None)] * 2
    added = {"depth": _long(level * SEGMENT + place), "k1": keys[0], "k2": keys[1], "u1": ups[0], "u2": ups[1], "parent": F.lit(None)}
    out = nodes.withColumns({c: v.cast("long") for c, v in added.items()})
    path = f"{folder}/nodes-{level}-{place}"
    out.write.option("compression", "zstd").parquet(path)
    return nodes.sparkSession.read.schema(out.schema).parquet(path)


def ended_lists(whole: DataFrame) -> DataFrame:
    """``ended, ends_sha256``: for each sequence (named by its smallest id) the
    digest of the ids of all conversations with it, in order.

    A digest is made front to back by nature.  The ids are sorted by range and
    joined to pieces of ``PIECE`` first, so a sequence that very many have meets
    as few rows, which are streamed through the digest one at a time."""
    keys = ["x1", "x2", "depth"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, []

        def out(rows: list) -> pa.RecordBatch:
            data = [(*k, ids[0], ",".join(map(str, ids))) for k, ids in rows]
            columns = zip(*data, strict=True) if data else [()] * 5
            types = (*[pa.int64()] * 4, pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*keys, "first", "ids"])

        for batch in batches:
            rows = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*keys, "conv_id")), strict=True):
                if key != own or len(held) == PIECE:
                    if held:
                        rows.append((own, held))
                    own, held = key, []
                held.append(conv)
            yield out(rows)
        if held:
            yield out([(own, held)])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, digest = None, None, None

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["ended", "ends_sha256"])

        for batch in batches:
            rows = []
            for *key, begin, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "first", "ids")), strict=True):
                if key != own:
                    if digest:
                        rows.append((first, digest.hexdigest()))
                    own, first, digest = key, begin, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield out(rows)
        if digest:
            yield out([(first, digest.hexdigest())])

    order = [*keys, "conv_id"]
    rows = whole.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = staged(rows.mapInArrow(runs, "x1 long, x2 long, depth long, first long, ids string"), "trie-ends")
    grouped = pieces.repartition(*keys).sortWithinPartitions(*keys, "first")
    return grouped.mapInArrow(digests, "ended long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    A null role or text counts as empty.  Turns that tie (or are all null) stand in
    the order of the SHA-256 of ``<length of role>:<role><text>``; repeated rows
    are turns of their own.  Rows without ``conv_id`` take no part.  Remainders
    have the sign of the id, so ids from -99 to 99 are one family.  An empty table
    has no root and gives an empty result.  Other columns are not read.
    """
    spark = conversations.sparkSession
    rows, ids = rebuilt(staged(turns(conversations), "trie-numbered"))
    pieces = staged(segments(rows), "trie-segments")
    distinct, whole = sequences(pieces, ids)
    segs = staged(placed(pieces, distinct), "trie-placed")

    # where a sequence's solitary tail begins: the first level whose beginning it alone has
    heads = segs.filter("level > 0").groupBy("level", "h1", "h2").agg(F.count(F.lit(1)).alias("_n"), F.min("conv_id").alias("conv_id"))
    alone = staged(heads.filter("_n = 1").groupBy("conv_id").agg(F.min("level").alias("_from")), "trie-alone")
    tails = _blocks(alone.join(distinct.select("conv_id", "levels"), "conv_id"), F.col("levels")).drop("levels")
    segs = staged(segs.join(tails, ["conv_id", "block"], "left"), "trie-marked")
    shared = segs.filter("_from IS NULL OR level < _from")
    folder = new_folder(spark, "trie-nodes")
    solitary(segs.filter("level >= _from")).write.option("compression", "zstd").parquet(f"{folder}/nodes-solitary")

    # a sequence comes in where it ends, or where its solitary tail begins
    nothing = [_long(0).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    ends = (F.col("_from").isNull()) & (F.col("level") * SEGMENT + F.col("n") == F.col("all_depth"))
    ending = shared.filter(ends).select("level", F.col("n").cast("long").alias("place"), "h1", "h2", "path", "conv_id", "n_convs", *nothing, F.col("conv_id").alias("ended"))
    below = (F.col("n_convs") - 1) * (F.col("all_chars") - F.col("before") - F.col("chars"))
    stubs = shared.filter("level = _from - 1").select(
        "level", _long(SEGMENT).alias("place"), "h1", "h2", "path", "conv_id", "n_convs",
        _long(1).alias("n_children"), _long(1).alias("n_leaves"), below.alias("saved_tokens"), F.lit(None).cast("long").alias("ended"),
    )
    zero = [_long(0).alias(c) for c in ("level", "place", "h1", "h2")]
    turnless = distinct.filter("depth = 0").select(*zero, F.lit("").alias("path"), "conv_id", "n_convs", *nothing, F.col("conv_id").alias("ended"))
    entries = staged(ending.union(stubs).union(turnless), "trie-entries", ("level", "place"))
    # one row a level; there are as many as different sequences agree on
    tops = {int(level): int(top) for level, top in entries.groupBy("level").agg(F.max("place")).collect()}
    if tops:
        peeled(shared, entries, {level: tops.get(level, 0) for level in range(max(tops) + 1)}, folder)

    nodes = spark.read.schema(_NODE).parquet(f"{folder}/nodes-*")
    known = nodes.filter("n_children > 0").select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), "n_children", F.col("conv_id").alias("_up"))
    found = looked_up(nodes, ["u1", "u2"], known, "n_children", "_up", F.col("k1"))
    lists = ended_lists(whole).withColumnRenamed("ended", "_ended")
    out = found.join(lists, F.col("ended") == F.col("_ended"), "left")
    # the root has the key 0 and no parent
    return out.select(
        "conv_id", "depth", F.coalesce("parent", "_up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"),
    )
