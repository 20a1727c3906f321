"""Title and article-URL expressions.

An article URL such as ``.../wiki/King_Kong_(1933_film)`` carries the title
stem, a year and a type.  The three parts come from one regular expression;
when neither a year nor a type is present the whole last path segment is the
title.  Underscores become spaces, then the title is trimmed and lower-cased.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from titlematch.functions._col import as_col

# Fixed value: must equal the reference's pattern for identical parses.
# Group 1 = title stem, group 2 = year digits, group 3 = type word.
ARTICLE_URL_PATTERN = r"([^\/]*)\((\d+)?_?(\w+)?\)"


# The same groups for a whole-string replacement: a match of the pattern above
# that is leftmost starts at the string start or after a "/" (any other start
# has a character before it that group 1 would take as well).  Without a match
# the last branch takes the string and leaves the groups empty.
_SPLIT_PATTERN = r"(?s)^(?:(?:.*?/)??" + ARTICLE_URL_PATTERN + r".*|.*)$"
_MARK = "\u0001"


class UrlParts(NamedTuple):
    cleaned_title: Column
    year: Column
    type: Column


def clean_title(title: Column | str) -> Column:
    """Movie-side title key: trim spaces, then lower-case (no ``_`` handling)."""
    return F.lower(F.trim(as_col(title)))


def url_last_segment(url: Column | str) -> Column:
    """Everything after the last ``/`` (the whole string if there is none)."""
    return F.substring_index(as_col(url), "/", -1)


def url_split(url: Column | str) -> Column:
    """``stem, year, type`` of an article URL joined by U+0001, by one regular
    expression; all empty where the pattern has no match (which a URL without
    "(" cannot have)."""
    u = as_col(url)
    split = F.regexp_replace(u, _SPLIT_PATTERN, f"$1{_MARK}$2{_MARK}$3")
    return F.when(F.instr(u, "(") > 0, split).when(u.isNotNull(), F.lit(_MARK + _MARK))


def split_parts(url: Column | str, split: Column | str) -> UrlParts:
    """The parts of ``url`` from a column that holds its ``url_split``."""
    u, s = as_col(url), as_col(split)
    tail = F.substring_index(s, _MARK, -2)
    # the stem may hold the mark itself: it is what stands before the last two
    stem = F.substring(s, F.lit(1), F.length(s) - F.length(tail) - 1)
    raw_title = F.when(F.endswith(s, F.lit(_MARK + _MARK)), url_last_segment(u)).otherwise(stem)
    return UrlParts(_title_key(raw_title), F.substring_index(tail, _MARK, 1), F.substring_index(s, _MARK, -1))


def _title_key(raw: Column) -> Column:
    return F.lower(F.trim(F.translate(raw, "_", " ")))


def url_parts(url: Column | str, pattern: str = ARTICLE_URL_PATTERN) -> UrlParts:
    """Split an article URL into (cleaned_title, year, type) string columns.

    * no match / unset group -> ``""``; NULL url -> NULL in all three;
    * first match in the string wins, it is not anchored to the end;
    * the title is the regex stem unless year and type are both empty, in
      which case it is the last path segment.

    Any other ``pattern`` with three groups is taken as it is.  As single
    Column expressions the parts repeat the match; ``parse_article_url`` keeps
    it in a projection of its own.
    """
    u = as_col(url)
    if pattern == ARTICLE_URL_PATTERN:
        return split_parts(u, url_split(u))
    stem, year, kind = (F.regexp_extract(u, pattern, i) for i in (1, 2, 3))
    raw_title = F.when((year == "") & (kind == ""), url_last_segment(u)).otherwise(stem)
    return UrlParts(_title_key(raw_title), year, kind)
