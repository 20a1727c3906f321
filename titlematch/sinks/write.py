"""Write a result, optionally its top rows only, to Parquet, a table or JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from titlematch.operators.rank import top_k
from titlematch.sources.jdbc import JdbcTarget
from titlematch.staging import remove_path


@dataclass(frozen=True)
class ParquetTarget:
    path: str
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableTarget:
    """A catalog table (``saveAsTable``)."""

    name: str
    format: str = "parquet"


def _rename(spark: SparkSession, old: str, new: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(old)
    files = source.getFileSystem(conf)
    if not files.exists(source):
        return False
    if not files.rename(source, jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")
    return True


def _swap_parquet(out: DataFrame, target: ParquetTarget) -> None:
    """Overwrites all or nothing: the new files are written beside the target and
    change places with it by two renames.  A failure before the first leaves the
    target as it was, one between them leaves it beside (``.old-``)."""
    spark, path, mark = out.sparkSession, target.path.rstrip("/"), uuid.uuid4().hex
    new, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    try:
        out.write.partitionBy(*target.partition_by).parquet(new)
        had = _rename(spark, path, old)
        _rename(spark, new, path)
    except Exception:
        remove_path(spark, new)
        raise
    spark.catalog.refreshByPath(path)
    if had:
        remove_path(spark, old)


def _swap_table(out: DataFrame, target: TableTarget) -> None:
    """As ``_swap_parquet``, for a catalog table."""
    spark, mark = out.sparkSession, uuid.uuid4().hex
    new, old = f"{target.name}_new_{mark}", f"{target.name}_old_{mark}"
    try:
        out.write.format(target.format).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    had = spark.catalog.tableExists(target.name)
    if had:
        spark.sql(f"ALTER TABLE {target.name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {target.name}")
    if had:
        spark.sql(f"DROP TABLE {old}")


def write_table(
    df: DataFrame,
    target: ParquetTarget | TableTarget | JdbcTarget | str,
    table: str | None = None,
    mode: str = "overwrite",
    order_by: str | Column | None = None,
    rows: int | None = None,
    tie_breakers: Sequence[str | Column] = (),
    jdbc_num_partitions: int | None = None,
) -> None:
    """Write ``df``; with ``order_by``/``rows`` only the top rows are written.

    ``order_by`` sorts descending (NULLS LAST) on the given column;
    ``rows=0`` writes an empty table, ``rows=None`` everything.  A plain
    string target is a Parquet path.  For JDBC, ``table`` names the
    database table and ``jdbc_num_partitions`` caps concurrent connections.
    Overwriting a Parquet or catalog target is all or nothing: readers have the
    old result until the new one is complete.
    """
    if mode not in ("overwrite", "append", "error", "errorifexists", "ignore"):
        raise ValueError(f"unsupported mode {mode!r}")
    out = top_k(df, order_by, rows, tie_breakers=tie_breakers)
    if isinstance(target, str):
        target = ParquetTarget(target)
    if mode == "overwrite" and isinstance(target, ParquetTarget):
        _swap_parquet(out, target)
    elif mode == "overwrite" and isinstance(target, TableTarget):
        _swap_table(out, target)
    elif isinstance(target, ParquetTarget):
        w = out.write.mode(mode)
        if target.partition_by:
            w = w.partitionBy(*target.partition_by)
        w.parquet(target.path)
    elif isinstance(target, TableTarget):
        out.write.mode(mode).format(target.format).saveAsTable(target.name)
    elif isinstance(target, JdbcTarget):
        if not table:
            raise ValueError("a JDBC write needs a table name")
        props = dict(target.properties)
        if jdbc_num_partitions:
            props["numPartitions"] = str(jdbc_num_partitions)
        out.write.jdbc(target.url, table, mode=mode, properties=props)
    else:
        raise TypeError(f"unknown target {target!r}")
