"""JDBC wrappers: argument handling only (no database is started here)."""

import pytest

from tillroll.sources.jdbc import read_jdbc


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", "t", partition_column="id", num_partitions=4)
