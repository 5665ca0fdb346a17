"""JDBC source for dimension and ledger tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10_000) -> DataFrame:
    """Read a table over JDBC.

    Without a partition column Spark reads through one connection in one
    task; give ``partition_column`` (numeric/date) with bounds and
    ``num_partitions`` to split the read into range queries in parallel.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetchsize))
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs bounds and num_partitions")
        return spark.read.jdbc(url=url, table=table, column=partition_column,
                               lowerBound=lower_bound, upperBound=upper_bound,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url=url, table=table, properties=props)
