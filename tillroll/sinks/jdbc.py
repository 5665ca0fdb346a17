"""JDBC sink: append a mart to a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batchsize: int = 10_000,
               num_partitions: int | None = None) -> None:
    """Append ``df`` to ``table``; each task writes its rows in batches.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it).
    Errors propagate: a failed write is a failed job, never a silent success.
    Credentials belong in ``properties`` supplied by the caller's secret
    store, never in code.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    if num_partitions:
        props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)
