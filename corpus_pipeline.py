"""The corpus pipeline: quality filter, exact dedup, near dedup, mixing, packing.

Each stage reads what its predecessor kept; ``run`` writes every stage's result
as Parquet in the session's shared folder and reads it back for the next one.
All stages but the last return documents with all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlematch.llm.base import staged, table
from titlematch.llm.exact_dedup import without_copies
from titlematch.llm.mixing import mixed_documents
from titlematch.llm.near_dedup import without_near_copies
from titlematch.llm.packing import packed
from titlematch.llm.quality import accepted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score below 0.5 go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, 0.8) stays."""
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in packed sequences."""
    return packed(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The classifier's trained weights have no SQL form.  The tests compare the stages
#: after it with brute-force versions, and its decisions with its own scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
