"""JDBC connection settings and table reads."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """A JDBC database: URL plus connection properties (user, password, driver)."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    @classmethod
    def postgres(cls, host: str, port: str | int, database: str, user: str, password: str) -> JdbcTarget:
        return cls(
            url=f"jdbc:postgresql://{host}:{port}/{database}",
            properties={"user": user, "password": password, "driver": "org.postgresql.Driver"},
        )

    @classmethod
    def from_env(cls, prefix: str = "POSTGRES_", env: Mapping[str, str] | None = None) -> JdbcTarget:
        """PostgreSQL settings from ``<prefix>HOST/PORT/DATABASE/USER/PASSWORD``.

        A missing variable raises ``KeyError``.
        """
        e = os.environ if env is None else env
        return cls.postgres(
            e[f"{prefix}HOST"], e[f"{prefix}PORT"], e[f"{prefix}DATABASE"], e[f"{prefix}USER"], e[f"{prefix}PASSWORD"]
        )


def read_table(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a whole table.

    Without a partition column the read is one query in one task; with
    ``partition_column``/bounds/``num_partitions`` Spark issues one range
    query per partition in parallel.  Filters and projections on the result
    are pushed into the queries.
    """
    if partition_column is None:
        return spark.read.jdbc(target.url, table, properties=target.properties)
    if None in (lower_bound, upper_bound, num_partitions):
        raise ValueError("partitioned reads need lower_bound, upper_bound and num_partitions")
    return spark.read.jdbc(
        target.url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=target.properties,
    )
