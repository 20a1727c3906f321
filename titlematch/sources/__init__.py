"""Readers for delimited text, XML and JDBC tables."""

from titlematch.sources.delimited import APOSTROPHE_ESCAPE, RFC4180, CsvDialect, read_delimited, read_movies
from titlematch.sources.jdbc import JdbcTarget, read_table
from titlematch.sources.xml import (
    ARTICLE_SCHEMA,
    ARTICLE_SCHEMA_PRUNED,
    infer_xml_schema,
    read_articles,
    read_xml_records,
    read_xml_rows,
    xml_records,
)
from titlematch.sources.xml_lex import lexed_records, read_xml_lexed

__all__ = [
    "APOSTROPHE_ESCAPE",
    "ARTICLE_SCHEMA",
    "ARTICLE_SCHEMA_PRUNED",
    "CsvDialect",
    "JdbcTarget",
    "RFC4180",
    "infer_xml_schema",
    "lexed_records",
    "read_articles",
    "read_delimited",
    "read_movies",
    "read_table",
    "read_xml_lexed",
    "read_xml_records",
    "read_xml_rows",
    "xml_records",
]
