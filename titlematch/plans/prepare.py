"""Prepared movie and article tables (the inputs of the match)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch import columns as C
from titlematch.functions.json import NAME_LIST_SCHEMA
from titlematch.operators.transforms import (
    add_cleaned_title,
    add_ratio,
    add_year,
    cast_columns,
    filter_all,
    pluck,
    rename,
    repartition_by,
    subset,
)
from titlematch.operators.urls import parse_article_url

# Target types of the raw (all-string) movie columns.
MOVIE_TYPES = {
    C.BUDGET: "long",
    C.RELEASE_DATE: "date",
    C.REVENUE: "long",
    C.PRODUCTION_COMPANIES: NAME_LIST_SCHEMA,
    C.GENRES: NAME_LIST_SCHEMA,
}

MOVIE_RENAMES = {C.VOTE_AVERAGE: C.RATING}
JSON_LIST_COLUMNS = [C.GENRES, C.PRODUCTION_COMPANIES]


# The movie rows kept (built as Columns at call time, because
# Columns need an active session).
def movie_filters() -> dict[str, Column]:
    """Rows kept: a non-empty title and positive revenue and budget.

    NULL fails every predicate, so unparseable numbers are dropped too and
    the ratio never divides by zero.  The title is not trimmed here.
    """
    return {
        "title_not_empty": F.col(C.TITLE) != "",
        "revenue_positive": F.col(C.REVENUE) > 0,
        "budget_positive": F.col(C.BUDGET) > 0,
    }


def prepare_movies(raw: DataFrame, repartition: bool = False) -> DataFrame:
    """Raw movie rows (strings) -> the 9-column prepared movie table.

    subset -> rename -> typed cast -> filter -> list names -> year ->
    ratio -> cleaned title.  Catalyst collapses the chain into one scan
    projection with the filter pushed under it; only the seven used CSV
    columns are parsed.
    """
    df = subset(raw, C.MOVIE_KEY_COLUMNS)
    df = rename(df, MOVIE_RENAMES)
    df = cast_columns(df, MOVIE_TYPES)
    df = filter_all(df, movie_filters())
    df = pluck(df, JSON_LIST_COLUMNS, "name")
    df = add_year(df, C.RELEASE_DATE, C.YEAR)
    df = add_ratio(df, C.REVENUE, C.BUDGET, C.REVENUE_TO_BUDGET, 2)
    df = add_cleaned_title(df, C.TITLE, C.CLEANED_TITLE)
    df = repartition_by(df, C.CLEANED_TITLE, enabled=repartition)
    df = df.withColumn(C.YEAR, F.col(C.YEAR).cast("string"))
    return df.select(*C.MOVIE_COLUMNS)


def prepare_articles(raw: DataFrame, url_column: str = C.URL, repartition: bool = False) -> DataFrame:
    """Raw article rows -> abstract, url, cleaned_title, year, type."""
    df = parse_article_url(raw, url_column)
    df = repartition_by(df, C.CLEANED_TITLE, enabled=repartition)
    return df.drop(C.TITLE, "links")
