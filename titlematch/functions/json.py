"""JSON-encoded list columns (``[{'id': 18, 'name': 'Drama'}, ...]``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlematch.functions._col import as_col

# Element shape of the genres / production_companies lists.
NAME_LIST_SCHEMA = T.ArrayType(
    T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
)


def parse_json(c: Column | str, schema: T.DataType | str = NAME_LIST_SCHEMA, **options: str) -> Column:
    """``from_json`` in permissive mode: malformed text becomes NULL.

    Single-quoted (Python-repr) documents parse because Spark's JSON reader
    allows single quotes by default.
    """
    return F.from_json(as_col(c), schema, options or None)


def names_of(c: Column | str, field: str = "name") -> Column:
    """Array of structs -> array of one field, order kept; NULL stays NULL."""
    return as_col(c).getField(field)
