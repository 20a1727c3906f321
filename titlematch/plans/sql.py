"""Ad-hoc SQL over DataFrames and schema lookup."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run a SQL query whose ``{name}`` placeholders are the given DataFrames.

    Only the names passed in are placeholders; any other brace is plain text.
    Nothing is registered globally and nothing is fetched: the result is a
    lazy DataFrame like any other.
    """
    return spark.sql(escape_braces(query, tables), **tables)


def escape_braces(query: str, names: Iterable[str]) -> str:
    """``query`` with every brace doubled but those around one of ``names``."""
    query = query.replace("{", "{{").replace("}", "}}")
    for name in names:
        query = query.replace(f"{{{{{name}}}}}", f"{{{name}}}")
    return query


def table_schema(df: DataFrame) -> DataFrame:
    """One row per column: ``column_name``, ``data_type`` (Spark SQL type names)."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    schema = T.StructType(
        [T.StructField("column_name", T.StringType(), False), T.StructField("data_type", T.StringType(), False)]
    )
    return spark.createDataFrame(rows, schema)
