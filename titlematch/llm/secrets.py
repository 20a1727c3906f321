"""Secret scans: single patterns, and multipart credentials linked by scope.

Every text is scanned by built-in functions.  The spans of a pattern come from
splitting the text at its matches: the lengths of what stands between the
matches and of the matches themselves add up to offsets in code points.

*Base* kinds are reported wherever they occur: ``assign`` (a password, token or
key given a value), ``access`` (an access identifier), ``hex`` (a long run of
hex digits).  *Weak* candidates, which by themselves are nothing unusual, are
``secret`` (40 characters of base-64 with a capital, a small letter and a digit)
and ``endpoint`` (a web address).  A weak candidate is reported only where its
complement stands within ``SCOPE`` code points of it: a secret with an access
identifier, an endpoint with an access identifier that has a secret (a weak one,
or an ``assign``) in its own scope.  The links are found by an interval join: the
parts become rows that carry the scope cells they reach, and are joined on text
and cell, so only parts close to one another ever meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import staged, text_of

#: The base patterns (letters of the key words in either case).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ASSIGN_LEAST = 8
#: Runs that are too short never match these, as they would be dropped anyway.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Weak candidates.
#: ('=' is left out of the run, so that the name in ``name=value`` is not part of it)
SECRET = r"[A-Za-z0-9+/]{40,}"
SECRET_WHOLE = r"^[A-Za-z0-9+/]{40}$"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+"""
#: Kinds in the order in which spans that start together are listed.
KINDS = ["assign", "access", "hex", "secret", "endpoint"]
SCOPE = 256

_SPANS = "array<struct<start:long,end:long>>"
#: Matches that one fold goes over.
RUN = 128


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _running(sizes: Column, start: Column) -> Column:
    """The matches of one run with their offsets, from ``start`` on."""
    none = F.array().cast("array<struct<start:long,end:long,text:string>>")

    def add(a: Column, s: Column) -> Column:
        begin, end = a["at"] + s["gap"], a["at"] + s["gap"] + s["own"]
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"), s["text"].alias("text")))).alias("spans"))

    return F.aggregate(sizes, F.struct(start.alias("at"), none.alias("spans")), add, lambda a: a["spans"])


def _offsets(sizes: Column) -> Column:
    """The matches with their offsets.  A fold that appends copies what it has, so
    matches are folded in runs of ``RUN``; where each run starts is a fold over runs."""
    zero = F.lit(0).cast("long")
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / RUN).cast("int")), lambda i: F.slice(sizes, i * RUN + 1, F.lit(RUN)))

    def begins(runs: Column) -> Column:
        totals = F.transform(runs, lambda r: F.aggregate(r, zero, lambda a, s: a + s["gap"] + s["own"]))
        return F.aggregate(totals, F.array(zero), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t)))

    spans = _bound(runs, lambda r: F.flatten(F.zip_with(r, F.slice(begins(r), 1, F.size(r)), _running)))
    return F.when(F.size(sizes) > 0, spans).otherwise(F.array().cast("array<struct<start:long,end:long,text:string>>"))


def _spans(text: Column, pattern: str, keep=None) -> Column:
    """Spans of the matches of ``pattern``, of those whose text passes ``keep``."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    size = F.zip_with(matches, between, lambda m, b: F.struct(F.length(b).cast("long").alias("gap"), F.length(m).cast("long").alias("own"), m.alias("text")))
    size = F.filter(size, lambda s: s["text"].isNotNull())
    start = _bound(size, _offsets)
    kept = F.filter(start, lambda s: keep(s["text"])) if keep else start
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def _where(may: Column, spans: Column) -> Column:
    """The spans, looked for only in texts that may have them."""
    return F.when(may, spans).otherwise(F.array().cast(_SPANS))


def _named(kind: str) -> Column:
    """The spans of a kind, with its name."""
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key`` and the spans of every kind."""
    text = text_of()

    def long_value(match: Column) -> Column:
        return F.length(F.regexp_extract(match, ASSIGN_VALUE, 1)) >= ASSIGN_LEAST

    def mixed(match: Column) -> Column:
        return match.rlike(SECRET_WHOLE) & match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")

    access = text.contains("AKIA")
    return docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("text_key"),  # staged, so it holds
        _where(text.rlike(ASSIGN), _spans(text, ASSIGN, long_value)).alias("assign"),
        _where(access, _spans(text, ACCESS)).alias("access"),
        _where(text.rlike(HEX), _spans(text, HEX)).alias("hex"),
        # weak parts matter only beside an access identifier
        _where(access, _spans(text, SECRET, mixed)).alias("secret"),
        _where(access, _spans(text, ENDPOINT)).alias("endpoint"),
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``text_key, links``: the weak spans that are reported, per text."""
    rows = found.filter((F.size("access") > 0) & (F.size("secret") + F.size("endpoint") > 0))

    def parts(*kinds: str) -> DataFrame:
        return rows.select("text_key", F.explode(F.concat(*map(_named, kinds))).alias("p")).select("text_key", "p.kind", "p.start", "p.end")

    def within(own: DataFrame, other: DataFrame) -> DataFrame:
        """``own`` parts with one of ``other`` at most ``scope`` apart."""
        cells = F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))
        reach = own.withColumn("cell", F.explode(cells))
        place = other.select(
            F.col("text_key").alias("o_key"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
            F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("o_cell"),
        )
        near = (F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope)
        same = (F.col("text_key") == F.col("o_key")) & (F.col("cell") == F.col("o_cell"))
        return reach.join(place, same & near, "left_semi").select("text_key", "kind", "start", "end").distinct()

    access = parts("access")
    secrets = within(parts("secret"), access)
    complete = within(access, parts("secret", "assign"))
    endpoints = within(parts("endpoint"), complete)
    return secrets.union(endpoints).groupBy("text_key").agg(F.collect_list(F.struct("start", "end", "kind")).alias("links"))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    rank = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    text = F.transform(F.array_sort(rank), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256,
    spans``.

    A null text counts as empty and has no spans.  Rows are scanned one by one, so
    repeated rows and null ids do no harm.  An empty table gives an
    empty result.  Only ``doc_id`` and ``text`` are read.
    """
    found = staged(scanned(docs), "secret-parts")
    links = linked(found, scope).withColumnRenamed("text_key", "_key")

    base = F.concat(*map(_named, KINDS[:3]))
    added = F.coalesce("links", F.array().cast("array<struct<start:long,end:long,kind:string>>"))
    return found.join(links, F.col("text_key") == F.col("_key"), "left").select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, added)).alias("spans"),
    )
