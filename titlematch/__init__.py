"""titlematch: link a movie catalogue to encyclopedia articles on Spark.

Every operator is ``DataFrame -> DataFrame`` (or ``Column -> Column``),
built from Spark's own expressions so Catalyst can prune, push down and
code-generate the whole plan.  Nothing here collects data to the driver.

Sub-packages
------------
functions  Column-level expressions (title cleaning, URL parsing, JSON lists,
           number/date parsing, ratios).
operators  DataFrame operators (projections, filters, tiered match, top-k,
           explode).
sources    Readers: delimited text, XML (native and splittable), JDBC.
sinks      Writers: Parquet, managed table, JDBC; with optional top-k.
plans      Prepared-table builders, the batch job, SQL helpers and the
           query catalogue used by ``__spark_entry__``.
streaming  Incremental article ingestion with the same stateless operators.
"""

from titlematch import columns

__all__ = ["columns"]
