"""Article URL -> (cleaned_title, year, type) as a DataFrame operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from titlematch import columns as C
from titlematch.functions.text import ARTICLE_URL_PATTERN, split_parts, url_parts, url_split

_SPLIT = "__url_split"


def parse_article_url(
    df: DataFrame,
    url_column: str = C.URL,
    title_out: str = C.CLEANED_TITLE,
    year_out: str = C.YEAR,
    type_out: str = C.TYPE,
    pattern: str = ARTICLE_URL_PATTERN,
) -> DataFrame:
    """Add cleaned_title, year and type columns parsed from ``url_column``.

    With the default pattern one regular expression a URL, evaluated in a
    projection of its own; the parts are cut from its result.  The given
    ``url_column`` is used for every part, including the fallback to the last
    path segment.
    """
    if pattern != ARTICLE_URL_PATTERN:
        parts = url_parts(url_column, pattern)
        return df.withColumns({title_out: parts.cleaned_title, year_out: parts.year, type_out: parts.type})
    parts = split_parts(url_column, _SPLIT)
    split = df.withColumn(_SPLIT, url_split(url_column))
    return split.withColumns({title_out: parts.cleaned_title, year_out: parts.year, type_out: parts.type}).drop(_SPLIT)
