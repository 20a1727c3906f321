"""Intermediate tables in the folder that all executors share.

A staged table is Parquet under ``spark.checkpoint.dir``: it cuts lineage, so a
lost executor re-reads files instead of recomputing.  A ``scope`` removes what
was staged inside it when it closes, also after a failure.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_OPEN: ContextVar[list[str] | None] = ContextVar("titlematch_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Required, except that one
    machine alone gets a temporary folder of its own; off one machine a folder of
    one machine (``file:``) is refused unless the session says that it is shared
    (``spark.titlematch.sharedFiles``, for a mounted network drive)."""
    one_machine = spark.conf.get("spark.master", "local").split("[")[0] == "local"
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - sessions without a local SparkContext
            path = None
    if not path and one_machine:
        path = tempfile.mkdtemp(prefix="titlematch-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    mounted = spark.conf.get("spark.titlematch.sharedFiles", "false") == "true"
    if not spark.conf.get("spark.master", "local").startswith("local") and path.startswith("file:") and not mounted:
        raise ValueError(f"{path} is a folder of one machine; set spark.checkpoint.dir to one that every executor reaches")
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder, removed with the open scope if there is one."""
    path = f"{shared_dir(spark)}/titlematch-{name}-{uuid.uuid4().hex}"
    owned = _OPEN.get()
    if owned is not None:
        owned.append(path)
    return path


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet (with the writer's ``options``) in a new folder and read back."""
    path = new_folder(df.sparkSession, name)
    df.write.options(compression="zstd", **(options or {})).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` on whatever file system it names.

    Best effort: a failure (or a session without a local JVM) only logs.
    """
    try:
        sc = spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001
        log.warning("could not remove staged tables at %s", path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the folders staged inside when it closes, also after a failure.
    Results that read them must be written or collected before that."""
    owned: list[str] = []
    token = _OPEN.set(owned)
    try:
        yield owned
    finally:
        _OPEN.reset(token)
        for path in owned:
            remove_path(spark, path)
