"""Reading staged and served tables (S3).

The original aggregation stage read each staging table with one SQL query
through a single connection. Here a table is a catalog name, a Parquet
folder, or a JDBC table; JDBC reads are split into ``num_partitions``
parallel range queries on a numeric or date column, so no single task or
connection carries the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    properties: dict = field(default_factory=dict)
    partition_column: str | None = None
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int = 64
    fetch_size: int = 10_000


def read_table(spark: SparkSession, source: str | JdbcTable) -> DataFrame:
    """A catalog table (``db.table``), a Parquet folder (a path), or a
    ``JdbcTable``."""
    if isinstance(source, JdbcTable):
        props = dict(source.properties)
        props.setdefault("fetchsize", str(source.fetch_size))
        if source.partition_column is None:
            return spark.read.jdbc(source.url, source.table, properties=props)
        return spark.read.jdbc(
            source.url,
            source.table,
            column=source.partition_column,
            lowerBound=source.lower_bound,
            upperBound=source.upper_bound,
            numPartitions=source.num_partitions,
            properties=props,
        )
    if "/" in source or ":" in source:
        return spark.read.parquet(source)
    return spark.table(source)
