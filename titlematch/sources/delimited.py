"""Delimited-text (CSV) sources.

Every column is read as a string (no schema inference): typing is an
explicit, NULL-on-failure step later (``operators.cast_columns``), so a bad
value never fails the scan and no extra pass over the data is spent on
inference.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class CsvDialect:
    """Options for ``spark.read.csv``.

    ``multi_line`` lets quoted fields hold newlines, at the price that a file
    is no longer split across tasks.
    """

    sep: str = ","
    quote: str = '"'
    escape: str = "'"
    header: bool = True
    multi_line: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {
            "sep": self.sep,
            "quote": self.quote,
            "escape": self.escape,
            "header": str(self.header).lower(),
            "multiLine": str(self.multi_line).lower(),
            "inferSchema": "false",
        }
        opts.update(self.extra)
        return opts


# Fixed value: the movie catalogue's dialect - the apostrophe is the escape
# character, so a doubled '' inside a quoted field reads as one apostrophe.
APOSTROPHE_ESCAPE = CsvDialect(sep=",", quote='"', escape="'", header=True)

# Standard CSV: a doubled quote escapes a quote; fields may span lines.
RFC4180 = CsvDialect(sep=",", quote='"', escape='"', header=True, multi_line=True)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    dialect: CsvDialect = APOSTROPHE_ESCAPE,
    schema: str | None = None,
) -> DataFrame:
    """Read delimited text; all columns are strings unless ``schema`` is given."""
    reader = spark.read.options(**dialect.options())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_movies(spark: SparkSession, path: str | list[str], dialect: CsvDialect = APOSTROPHE_ESCAPE) -> DataFrame:
    """Raw movie catalogue (header CSV, every column a string)."""
    return read_delimited(spark, path, dialect)
