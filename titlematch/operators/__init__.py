"""DataFrame operators."""

from titlematch.operators.match import FILM_TIERS, Tier, heavy_keys, tiered_match, tiered_match_colocated, tiered_match_except
from titlematch.operators.rank import distinct_values, explode_column, numbered, sort_by, top_exploded, top_k, top_k_wide
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

__all__ = [
    "FILM_TIERS",
    "Tier",
    "add_cleaned_title",
    "add_ratio",
    "add_year",
    "cast_columns",
    "distinct_values",
    "explode_column",
    "filter_all",
    "heavy_keys",
    "numbered",
    "parse_article_url",
    "pluck",
    "rename",
    "repartition_by",
    "sort_by",
    "subset",
    "tiered_match",
    "tiered_match_colocated",
    "tiered_match_except",
    "top_exploded",
    "top_k",
    "top_k_wide",
]
