"""Prioritised tiered match of a left table (movies) to a right table (articles).

Semantics (the contract both forms below implement):

* Tiers are tried in order.  Tier ``i`` pairs a left row with every right row
  that passes the tier's ``right_filter`` and equals it on the tier's keys
  (plain ``=``: a NULL key never matches).
* A left row takes **all** right rows of the first tier that has any, and no
  rows from later tiers.
* Left rows matched in the first tier keep their multiplicity; every later
  tier, and the unmatched remainder, sees each distinct left row once.  This
  is what "first join, then EXCEPT DISTINCT the matched rows, then join the
  rest" produces.
* With ``unmatched="keep"`` left rows that match no tier appear once with
  NULL right-side columns.

Two physical forms:

``tiered_match``
    The scalable form.  The best tier depends only on the left row's key
    values, so it is decided on the *distinct* left keys against the
    *distinct* right keys of each tier (both partial aggregates, so hot keys
    collapse map-side).  Right rows are semi-joined to the keys some left
    row needs, then one equi-join on ``(tier, keys)`` emits exactly the
    output pairs - no candidate pair from a losing tier is ever built.
    First-tier rows are never aggregated, so a hot duplicated movie stays
    spread over the input partitions and AQE can split its join partition.

``tiered_match_except``
    The literal join / EXCEPT / union form, kept as an executable
    specification for tests.  Each EXCEPT re-plans its whole lineage, so the
    optimised plan scans each input several times.  EXCEPT works on rows and
    keys, never on pairs, and the joins are dealt by their number of pairs
    (``deal_pairs``, ``dealt_join``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlematch import columns as C

_TIER = "__tier"
_BEST = "__best"
_ROW = "__row"


@dataclass(frozen=True)
class Tier:
    """One match tier.

    name          label only
    keys          equality keys, same column name on both sides
    right_filter  SQL predicate over the right table selecting the rows
                  eligible for this tier
    scan_filter   optional superset of ``right_filter`` written with plain
                  column comparisons, so a file source can apply it in the
                  scan (pushed filters); the exact test still follows
    """

    name: str
    keys: tuple[str, ...]
    right_filter: str
    scan_filter: str | None = None


# The three tiers of the movie/article match.
# ``year > ''`` is ``year != ''`` for strings (NULL stays NULL); written this
# way the tiers' combined predicate stays a plain comparison the Parquet
# scan accepts as a pushed filter.
FILM_TIERS: tuple[Tier, ...] = (
    Tier("title_year_type", (C.CLEANED_TITLE, C.YEAR), "year > '' AND type = 'film'", "type = 'film'"),
    Tier("title_type", (C.CLEANED_TITLE,), "year = '' AND type = 'film'", "type = 'film'"),
    Tier("title", (C.CLEANED_TITLE,), "year = '' AND type = ''", "year = '' AND type = ''"),
)


def _all_keys(tiers: Sequence[Tier]) -> list[str]:
    out: list[str] = []
    for t in tiers:
        for k in t.keys:
            if k not in out:
                out.append(k)
    return out


def _kname(j: int) -> str:
    return f"__k{j}"


def _tiers_using(key: str, tiers: Sequence[Tier]) -> list[int]:
    return [i for i, t in enumerate(tiers, 1) if key in t.keys]


def _tier_key(tier: Column, value: Column, key: str, tiers: Sequence[Tier]) -> Column:
    """The key value when the tier uses the key, else NULL (matched null-safely).
    A key that all tiers use stays as it is, so a layout by it is kept."""
    if len(_tiers_using(key, tiers)) == len(tiers):
        return value
    return F.when(tier.isin(_tiers_using(key, tiers)), value)


def _valid(tier: Column, keys: Sequence[str], tiers: Sequence[Tier]) -> Column:
    """Every key the tier uses is non-NULL (a NULL key can never ``=``-match)."""
    conds = [F.col(_kname(j)).isNotNull() | ~tier.isin(_tiers_using(k, tiers)) for j, k in enumerate(keys)]
    return reduce(lambda a, b: a & b, conds)


def _null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[lc].eqNullSafe(right[rc]) for lc, rc in pairs])


def _payload_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in right.columns if c not in left.columns]


def _check(left: DataFrame, right: DataFrame, tiers: Sequence[Tier], unmatched: str) -> None:
    if not tiers:
        raise ValueError("at least one tier is required")
    if unmatched not in ("keep", "drop"):
        raise ValueError("unmatched must be 'keep' or 'drop'")
    for k in _all_keys(tiers):
        if k not in left.columns or k not in right.columns:
            raise ValueError(f"key {k!r} must exist on both sides")


def tag_right(right: DataFrame, tiers: Sequence[Tier], keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per (right row, tier it is eligible for); keys outside the tier are NULL."""
    ids = F.array(*[F.when(F.expr(t.right_filter), F.lit(i)) for i, t in enumerate(tiers, 1)])
    # Rows eligible for no tier are dropped first.  The scan filters are
    # plain column comparisons, so their OR reaches a file scan as pushed
    # filters; the exact per-tier test follows.
    eligible = reduce(lambda a, b: a | b, [F.expr(f"({t.right_filter})") for t in tiers])
    if all(t.scan_filter for t in tiers):
        eligible = reduce(lambda a, b: a | b, [F.expr(f"({t.scan_filter})") for t in tiers]) & eligible
    tagged = right.filter(eligible).select(
        *[F.col(k) for k in keys],
        *[F.col(p) for p in payload],
        F.explode(F.filter(ids, lambda x: x.isNotNull())).alias(_TIER),
    )
    tier = F.col(_TIER)
    return tagged.select(
        tier,
        *[_tier_key(tier, F.col(k), k, tiers).alias(_kname(j)) for j, k in enumerate(keys)],
        *payload,
    ).filter(_valid(tier, keys, tiers))


def semi_reduce(
    tagged: DataFrame, left: DataFrame, tiers: Sequence[Tier], keys: Sequence[str], broadcast: bool = False
) -> DataFrame:
    """Keep tagged right rows whose shared-key values occur on the left.

    ``broadcast`` ships the distinct left values to every task (a map-side
    filter); pass it only when the left side's size has been checked.
    """
    common = [k for k in keys if all(k in t.keys for t in tiers)]
    if not common:
        return tagged
    idx = {k: j for j, k in enumerate(keys)}
    wanted = left.select(*[F.col(k).alias(f"__s{idx[k]}") for k in common]).distinct()
    if broadcast:
        wanted = F.broadcast(wanted)
    cond = reduce(lambda a, b: a & b, [F.col(_kname(idx[k])) == F.col(f"__s{idx[k]}") for k in common])
    return tagged.join(wanted, cond, "left_semi")


def best_tier_by_key(left: DataFrame, tagged: DataFrame, tiers: Sequence[Tier], keys: Sequence[str]) -> DataFrame:
    """``(keys..., __best)`` for every distinct left key that matches some tier.

    No join: the left keys and the tagged right keys are unioned and grouped
    by all keys with one "has" flag per tier (a partial aggregate, so hot keys
    collapse map-side).  A tier that uses fewer keys gets its flag spread over
    those keys with a window - over already-aggregated keys, so even a hot
    title holds only its distinct key values there.  Size estimates of a
    union/aggregate add up rather than multiply, so the planner can broadcast
    the result statically when the inputs are small.

    NULL-safe grouping cannot create false hits: a right row only carries
    flags for tiers whose keys are all non-NULL on it.
    """
    n = len(tiers)
    flags = [f"__h{i}" for i in range(1, n + 1)]
    lk = left.select(
        *[F.col(k) for k in keys], F.lit(True).alias("__m"), *[F.lit(False).alias(f) for f in flags]
    )
    rk = tagged.select(
        *[F.col(_kname(j)).alias(k) for j, k in enumerate(keys)],
        F.lit(False).alias("__m"),
        *[(F.col(_TIER) == i).alias(f"__h{i}") for i in range(1, n + 1)],
    )
    agg = lk.unionByName(rk).groupBy(*keys).agg(F.max("__m").alias("__m"), *[F.max(f).alias(f) for f in flags])
    hit = {}
    for i, t in enumerate(tiers, 1):
        if set(t.keys) == set(keys):
            hit[i] = F.col(f"__h{i}")
        else:
            hit[i] = F.max(f"__h{i}").over(Window.partitionBy(*t.keys))
    spread = agg.select(*keys, "__m", *[hit[i].alias(f"__s{i}") for i in range(1, n + 1)])
    best = F.coalesce(*[F.when(F.col(f"__s{i}"), F.lit(i)) for i in range(1, n + 1)])
    any_hit = reduce(lambda a, b: a | b, [F.col(f"__s{i}") for i in range(1, n + 1)])
    return spread.filter(F.col("__m") & any_hit).select(*keys, best.alias(_BEST))


def tiered_match(
    left: DataFrame,
    right: DataFrame,
    tiers: Sequence[Tier] = FILM_TIERS,
    output_columns: Sequence[str] | None = C.OUTPUT_COLUMNS,
    unmatched: str = "keep",
    broadcast_keys: bool = False,
    prefilter_right: bool = False,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Link every left row to the right rows of its best tier (see module doc).

    ``heavy`` (of ``heavy_keys``) names key values with very many right rows.
    Their right rows are dealt to salts, their left rows meet every salt, and
    neither goes through the other joins; left rows without a tier stay out of it.

    ``broadcast_keys`` broadcasts the per-key best-tier table (one row per
    distinct left key).  Pass it only after checking that table's size - the
    job bounds it by the measured size of the left side.  Otherwise AQE
    picks the strategy from runtime statistics.

    ``prefilter_right`` first drops right rows whose value of a key shared
    by all tiers (the title) no left row has.  Together with
    ``broadcast_keys`` that is a broadcast semi-join, i.e. a map-side
    filter, so right rows that can never match are never shuffled.  Worth
    it when the left side is much smaller than the right.

    Both inputs are referenced twice (keys, then rows); stage expensive
    inputs (parsed XML) to Parquet or ``checkpoint()`` first.  Staged
    inputs also make the first-tier row ids (taken at the left scan)
    identical when a task is recomputed.
    """
    _check(left, right, tiers, unmatched)
    keys = _all_keys(tiers)
    payload = _payload_columns(left, right)
    tagged = tag_right(right, tiers, keys, payload)
    if prefilter_right:
        tagged = semi_reduce(tagged, left, tiers, keys, broadcast=broadcast_keys)

    # 1. best tier per distinct left key (small: one row per distinct key)
    best = best_tier_by_key(left, tagged, tiers, keys).toDF(*[f"__b_{k}" for k in keys], _BEST)
    if broadcast_keys:
        best = F.broadcast(best)
    # The row id is taken at the scan, before any exchange, so a recomputed
    # task (lost executor) assigns the same ids to the same rows.
    with_id = left.withColumn(_ROW, F.monotonically_increasing_id())
    with_best = with_id.join(best, _null_safe_on(with_id, best, [(k, f"__b_{k}") for k in keys]), "left")

    salted = None
    if heavy is not None:
        common = _common_key(tiers)
        marks = F.broadcast(heavy.select(F.col(common).alias("__heavy"), F.col("salts").alias("__salts")))
        dealt = tagged.join(marks, F.col(_kname(keys.index(common))) == F.col("__heavy"), "left")
        salted = dealt.filter(F.col("__heavy").isNotNull()).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), "__salts"))
        tagged = dealt.filter(F.col("__heavy").isNull()).drop("__heavy", "__salts")

    # 1b. keep only right rows some left key needs (its best tier and keys).
    #     A left semi join: AQE can split a hot right key here (the right
    #     rows are its streamed side), and a right key no left row needs -
    #     however hot - never reaches the final join.
    needed = best.filter(F.col(_BEST).isNotNull()).select(
        F.col(_BEST).alias("__n_tier"),
        *[_tier_key(F.col(_BEST), F.col(f"__b_{k}"), k, tiers).alias(f"__n{j}") for j, k in enumerate(keys)],
    )  # no distinct: a semi join never fans out
    if broadcast_keys:
        needed = F.broadcast(needed)
    need_cond = F.xxhash64(_TIER, *[_kname(j) for j in range(len(keys))]) == F.xxhash64(
        "__n_tier", *[f"__n{j}" for j in range(len(keys))]
    )
    # The join is on one hash of tier and keys: a collision lets a row through
    # that the final join drops.  Joined on the keys themselves, the rows would
    # reach the final join already partitioned for it, without an exchange there,
    # and AQE could not split a hot key in it.
    tagged = tagged.join(needed, need_cond, "left_semi")

    # 2. first-tier rows keep their multiplicity (their row id keeps them
    #    apart); every other row is seen once per distinct value.  One
    #    aggregate, partial per map task, so a hot duplicated row collapses
    #    before the shuffle.
    #
    # 3. one left join on (tier, keys) emits exactly the output pairs; rows
    #    without a tier (NULL __best) never satisfy the join and come out once
    #    with NULL right-side columns.  They carry all their own key values
    #    there, so they spread over the partitions instead of sharing one NULL key.
    rows = _left_rows(with_best, left.columns, tiers, keys).distinct()
    how = "left" if unmatched == "keep" else "inner"
    if salted is None:
        out = _matched(rows, tagged, tiers, keys, payload, how)
    else:
        marked = rows.join(marks, F.col(common) == F.col("__heavy"), "left")
        several = F.col("__heavy").isNotNull() & F.col(_TIER).isNotNull()
        plain = marked.filter(~several).drop("__heavy", "__salts")
        repeated = marked.filter(several).withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1)))
        out = _matched(plain, tagged, tiers, keys, payload, how).select(*left.columns, *payload).union(
            _matched(repeated, salted, tiers, keys, payload, "inner", salt=True).select(*left.columns, *payload)
        )
    out = out.select(*left.columns, *payload)
    return out.select(*output_columns) if output_columns else out


def _left_rows(with_best: DataFrame, columns: Sequence[str], tiers: Sequence[Tier], keys: Sequence[str]) -> DataFrame:
    """Left rows with their best tier, its keys, and a row id in the first tier."""
    values = []
    for j, k in enumerate(keys):
        used = _tiers_using(k, tiers)
        value = F.col(k) if len(used) == len(tiers) else F.when(F.col(_BEST).isNull() | F.col(_BEST).isin(used), F.col(k))
        values.append(value.alias(f"__m{j}"))
    return with_best.select(*columns, F.col(_BEST).alias(_TIER), *values, F.when(F.col(_BEST) == 1, F.col(_ROW)).alias(_ROW))


def _matched(rows: DataFrame, tagged: DataFrame, tiers: Sequence[Tier], keys: Sequence[str], payload: Sequence[str], how: str, salt: bool = False) -> DataFrame:
    """The one join on tier and keys (and salt)."""
    salts = [F.col("__salt").alias("__r_salt")] if salt else []
    right_rows = tagged.select(
        F.col(_TIER).alias("__r_tier"), *salts, *[F.col(_kname(j)).alias(f"__r{j}") for j in range(len(keys))], *payload
    )
    conds = [F.col(_TIER) == F.col("__r_tier")] + ([F.col("__salt") == F.col("__r_salt")] if salt else [])
    # a key that all tiers use is not null on the right; plain equality keeps a layout by it
    for j, k in enumerate(keys):
        mine, other = F.col(f"__m{j}"), F.col(f"__r{j}")
        conds.append(mine == other if len(_tiers_using(k, tiers)) == len(tiers) else mine.eqNullSafe(other))
    return rows.join(right_rows, reduce(lambda a, b: a & b, conds), how)


def _common_key(tiers: Sequence[Tier]) -> str:
    """The first key that all tiers use."""
    common = [k for k in _all_keys(tiers) if all(k in t.keys for t in tiers)]
    if not common:
        raise ValueError("no key is used by all tiers")
    return common[0]


def heavy_keys(right: DataFrame, tiers: Sequence[Tier] = FILM_TIERS, partitions: int | None = None) -> DataFrame:
    """``<key>, rows, salts``: values of the key that all tiers use which have more
    rows than a mean partition, and over how many salts to deal their rows.

    A sketch of frequent values names candidates, whose rows are then counted
    exactly.  At most one value a partition can pass, so the result is small by
    its rule; it is collected and returned as a local table.  ``right`` is read
    twice, by that column and those of the tiers.  NULL never matches and is left out.
    """
    spark, key = right.sparkSession, _common_key(tiers)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    able = right.filter(reduce(lambda a, b: a | b, [F.expr(f"({t.right_filter})") for t in tiers])).select(key).filter(F.col(key).isNotNull())
    # the sketch errs by less than a fourth of a mean partition's rows
    tracked = min(16 * parts, 1_000_000)
    found = able.agg(F.expr(f"approx_top_k({key}, {min(4 * parts, tracked)}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n"))
    names, n = found.select(F.col("top.item"), "n").first()
    counted = spark.createDataFrame([(x,) for x in names or []], f"{key} string")
    rows = able.join(F.broadcast(counted), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    heavy = rows.filter(F.col("rows") * parts > n).collect()
    # a salt holds half a mean partition
    local = [(r[key], r["rows"], -(-2 * r["rows"] * parts // n)) for r in heavy]
    return spark.createDataFrame(local, f"{key} string, rows long, salts long")


def tiered_match_colocated(
    left: DataFrame,
    right: DataFrame,
    tiers: Sequence[Tier] = FILM_TIERS,
    output_columns: Sequence[str] | None = C.OUTPUT_COLUMNS,
    unmatched: str = "keep",
    salted_buckets: int | None = None,
) -> DataFrame:
    """``tiered_match`` of tables that are laid out by the key all tiers use
    (bucketed by it, with as many buckets on both sides).

    Nothing here is grouped or joined without that key, so no exchange is needed
    where the session lets a layout by some of the join keys serve
    (``spark.sql.requireAllClusterKeysForCoPartition`` false).  What tiers a key
    value has is one right row a value: flags, and the distinct other keys of
    tiers that use more.  With ``salted_buckets`` the right table has a ``__salt``
    and is laid out by key and salt in that many buckets, the right rows of a value
    dealt to its ``salts``; the left rows (with a column ``salts``) are repeated for
    each of them and brought to that layout here.
    """
    _check(left, right, tiers, unmatched)
    keys, common = _all_keys(tiers), _common_key(tiers)
    own = ["__salt", "salts"] if salted_buckets else []
    columns = [c for c in left.columns if c not in own]
    payload = [c for c in _payload_columns(left, right) if c not in own]
    tagged = tag_right(right, tiers, keys, [*payload, *own])
    place = _kname(keys.index(common))
    marks = []
    for i, t in enumerate(tiers, 1):
        extra = [F.col(_kname(keys.index(k))) for k in t.keys if k != common]
        hit = F.col(_TIER) == i
        marks.append((F.collect_set(F.when(hit, F.struct(*extra))) if extra else F.max(hit)).alias(f"__s{i}"))
    flags = tagged.groupBy(place).agg(*marks).withColumnRenamed(place, "__key")
    best = []
    for i, t in enumerate(tiers, 1):
        extra = [F.col(k) for k in t.keys if k != common]
        if extra:
            none_null = reduce(lambda a, b: a & b, [c.isNotNull() for c in extra])
            same = [c.alias(_kname(keys.index(k))) for c, k in zip(extra, [k for k in t.keys if k != common], strict=True)]
            has = none_null & F.coalesce(F.array_contains(F.col(f"__s{i}"), F.struct(*same)), F.lit(False))
        else:
            has = F.coalesce(F.col(f"__s{i}"), F.lit(False))
        best.append(F.when(has, F.lit(i)))
    with_id = left.withColumn(_ROW, F.monotonically_increasing_id())
    with_best = with_id.join(flags, F.col(common) == F.col("__key"), "left").withColumn(_BEST, F.coalesce(*best))
    rows = _left_rows(with_best, [*columns, *(["salts"] if salted_buckets else [])], tiers, keys).distinct()
    if salted_buckets:
        none = rows.filter(F.col(_TIER).isNull()).select(*columns, *[F.lit(None).cast(right.schema[p].dataType).alias(p) for p in payload])
        rows = rows.filter(F.col(_TIER).isNotNull()).withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        rows = rows.repartition(salted_buckets, f"__m{keys.index(common)}", "__salt")
        out = _matched(rows, tagged, tiers, keys, payload, "inner", salt=True).select(*columns, *payload)
        out = out.union(none) if unmatched == "keep" else out
    else:
        out = _matched(rows, tagged, tiers, keys, payload, "left" if unmatched == "keep" else "inner").select(*columns, *payload)
    return out.select(*output_columns) if output_columns else out


# Pairs a task of a dealt join gives out, about; inputs with fewer pairs are joined plainly.
PAIRS_PER_TASK = 4_000_000
MOST_TASKS = 20_000  # with more pairs than that takes, tasks get larger


@dataclass(frozen=True)
class Dealing:
    """How many tasks a join is dealt to, and the key values with more pairs than a
    fourth of a task's: ``(key values.., left pieces, right pieces)``."""

    tasks: int
    heavy: tuple[tuple, ...] = ()


def deal_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs_per_task: int = PAIRS_PER_TASK) -> Dealing:
    """Counts the pairs of an equi-join on ``keys`` from both sides' rows a key value.

    Reads only the keys, twice if there is more than a task's work.  At most four
    key values a task can be heavy, so what is collected is small by its rule.
    ``left`` may have more rows than the join will see (an upper bound).
    """
    sides = [
        left.select(*keys, F.lit(1).alias("__l"), F.lit(0).alias("__r")),
        right.dropna(subset=list(keys)).select(*keys, F.lit(0).alias("__l"), F.lit(1).alias("__r")),
    ]
    counts = sides[0].union(sides[1]).groupBy(*keys).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
    # as double: the pairs of one key value can pass a long
    work = F.col("__l").cast("double") * F.col("__r") + F.col("__l") + F.col("__r")
    total = counts.agg(F.sum(work)).first()[0] or 0.0
    tasks = min(math.ceil(total / pairs_per_task), MOST_TASKS)
    if tasks <= 1:
        return Dealing(1)
    cell = total / tasks / 4
    heavy = counts.filter(work > cell).dropna(subset=list(keys)).select(*keys, "__l", "__r", work.alias("__work"))
    return Dealing(tasks, tuple((*r[: len(keys)], *_pieces(r["__l"], r["__r"], math.ceil(r["__work"] / cell))) for r in heavy.collect()))


def _pieces(n_left: int, n_right: int, cells: int) -> tuple[int, int]:
    """Into how many pieces each side of a key value is cut: about ``cells`` cells as
    square as they can be, which repeats the fewest rows; no more pieces than rows."""
    if not n_left or not n_right:
        return (cells, 1) if n_left else (1, cells)
    a = min(n_left, max(1, round(math.sqrt(cells * n_left / n_right))))
    b = min(n_right, math.ceil(cells / a))
    return min(n_left, math.ceil(cells / b)), b


def dealt_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, dealing: Dealing, row: Column | None = None
) -> DataFrame:
    """``left.join(right, keys, how)`` (inner or left), dealt to tasks by pairs.

    A plain equi-join has as many tasks as its input has files or megabytes; where
    few rows make very many pairs, one task gives out most of them.  Here key values
    with many pairs are cut into cells (a piece of the left rows with a piece of the
    right rows, each pair in one cell) and both sides are laid out by key and cell in
    ``dealing.tasks`` partitions, which AQE leaves as they are.

    ``row`` deals the left rows; a row id taken at the scan unless given.  Give a hash
    of the columns when the rows are distinct and come out of a shuffle, so that a
    recomputed task deals them alike.
    """
    if dealing.tasks <= 1:
        return left.join(right, list(keys), how)
    columns = [*keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys]]
    types = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)
    marks = F.broadcast(left.sparkSession.createDataFrame(list(dealing.heavy), f"{types}, __a int, __b int"))
    scan_row = F.xxhash64(F.monotonically_increasing_id())
    one = F.lit(1)

    def side(df: DataFrame, number: Column) -> DataFrame:
        df = df.withColumn("__row", number).join(marks, list(keys), "left")
        return df.withColumns({"__a": F.coalesce("__a", one), "__b": F.coalesce("__b", one)})

    def piece(pieces: Column) -> Column:
        return F.pmod(F.col("__row"), pieces).cast("int")

    def each(pieces: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))

    # left rows with a NULL key meet nothing and are spread over all tasks
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    mine = side(left, scan_row if row is None else row)
    mine = mine.withColumn("__i", piece(F.when(null_key, F.lit(dealing.tasks)).otherwise(F.col("__a")))).withColumn("__j", each("__b"))
    theirs = side(right.dropna(subset=list(keys)), scan_row)
    theirs = theirs.withColumn("__j", piece(F.col("__b"))).withColumn("__i", each("__a"))
    on = [*keys, "__i", "__j"]
    theirs = theirs.drop("__row", "__a", "__b").withColumn("__hit", F.lit(True))
    out = mine.drop("__row", "__a").repartition(dealing.tasks, *on).join(theirs.repartition(dealing.tasks, *on), on, how)
    if how == "left":
        # a key value with several right pieces has matches; a copy that met an empty piece is none
        out = out.filter((F.col("__b") == 1) | F.col("__hit").isNotNull())
    return out.select(*columns)


def except_matched(pool: DataFrame, eligible: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``pool`` EXCEPT DISTINCT its rows that some row of ``eligible`` matches on ``keys``.

    Equal rows have equal keys, so a row is among the matched ones exactly if its
    keys are; the pairs need not be built for that.
    """
    wanted = eligible.select(*keys).distinct()
    return pool.join(wanted, list(keys), "left_anti").select(*pool.columns).distinct()


def tiered_match_except(
    left: DataFrame,
    right: DataFrame,
    tiers: Sequence[Tier] = FILM_TIERS,
    output_columns: Sequence[str] | None = C.OUTPUT_COLUMNS,
    unmatched: str = "keep",
) -> DataFrame:
    """Join / EXCEPT DISTINCT / UNION ALL form of ``tiered_match``.

    Same result multiset; used as the executable specification in tests.
    """
    _check(left, right, tiers, unmatched)
    payload = _payload_columns(left, right)
    cols = list(output_columns) if output_columns else [*left.columns, *payload]
    pool, row = left, None
    pool_keys = left.select(*_all_keys(tiers))  # of at least the pool's rows; what pairs are counted on
    parts = []
    for i, t in enumerate(tiers, 1):
        eligible = right.filter(F.expr(t.right_filter)).select(*t.keys, *payload)
        last = i == len(tiers)
        how = "left" if (last and unmatched == "keep") else "inner"
        hit = dealt_join(pool, eligible, t.keys, how, deal_pairs(pool_keys, eligible, t.keys), row)
        parts.append(hit.select(*cols))
        if not last:
            pool, row = except_matched(pool, eligible, t.keys), F.xxhash64(*left.columns)
            pool_keys = pool_keys.join(eligible.select(*t.keys).distinct(), list(t.keys), "left_anti")
    return reduce(lambda a, b: a.unionByName(b), parts)
