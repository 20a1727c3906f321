"""Article records from a directory of dump files, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlematch.plans.prepare import prepare_articles
from titlematch.sources.xml import ARTICLE_SCHEMA_PRUNED, xml_records


def article_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = ARTICLE_SCHEMA_PRUNED,
    row_tag: str = "doc",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Prepared article rows (abstract, url, cleaned_title, year, type) from
    every new file in ``directory``, parsed with the same record scan and
    URL rules as the batch job."""
    reader = spark.readStream.option("lineSep", f"<{row_tag}")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    chunks = reader.text(directory)
    records = xml_records(chunks, row_tag)
    raw = records.select(F.from_xml("record", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return prepare_articles(raw)
