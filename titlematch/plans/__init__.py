"""Prepared tables, the batch job, SQL helpers and the query catalogue."""

from titlematch.plans.job import JobResult, run, stage
from titlematch.plans.prepare import MOVIE_TYPES, movie_filters, prepare_articles, prepare_movies
from titlematch.plans.sql import run_sql, table_schema

__all__ = [
    "JobResult",
    "MOVIE_TYPES",
    "movie_filters",
    "prepare_articles",
    "prepare_movies",
    "run",
    "run_sql",
    "stage",
    "table_schema",
]
