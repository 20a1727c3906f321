"""Column-level expressions (all JVM-side built-ins, no Python UDFs)."""

from titlematch.functions.dates import year_string, year_of
from titlematch.functions.json import NAME_LIST_SCHEMA, names_of, parse_json
from titlematch.functions.numeric import ratio, to_long
from titlematch.functions.text import (
    ARTICLE_URL_PATTERN,
    clean_title,
    url_last_segment,
    url_parts,
)

__all__ = [
    "ARTICLE_URL_PATTERN",
    "NAME_LIST_SCHEMA",
    "clean_title",
    "names_of",
    "parse_json",
    "ratio",
    "to_long",
    "url_last_segment",
    "url_parts",
    "year_of",
    "year_string",
]
