"""Line files of any accepted layout up to the fixed sales contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.contracts import (
    ADDITIONAL_COLUMN,
    CORRUPT_COLUMN,
    REQUIRED_COLUMNS,
    SALES_SCHEMA,
    SOURCE_FILE_COLUMN,
)
from tillroll.functions.columns import fold_columns, null_string


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold_extras(df: DataFrame, extras: list[str]) -> DataFrame:
    """Set ``additional_column`` to the extras joined by ',' (header order).

    Null extras are skipped and all-null extras give ''. With no extras the
    column is a null string. A source column already called
    additional_column is one of the extras and is replaced.
    """
    if extras:
        value = fold_columns([quoted(c).cast("string") for c in extras])
    else:
        value = null_string()
    return df.withColumn(ADDITIONAL_COLUMN, value)


def conform(df: DataFrame, header: list[str],
            required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Fold the extras of one layout and select the contract columns by name."""
    extras = [c for c in header if c not in required]
    folded = fold_extras(df, extras)
    # The two bookkeeping columns (source file, corrupt-record text) ride along.
    keep = [c for c in (CORRUPT_COLUMN, SOURCE_FILE_COLUMN) if c in df.columns]
    return folded.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in SALES_SCHEMA.fields],
        *keep,
    )


def reconcile_layouts(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of conformed layouts, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
