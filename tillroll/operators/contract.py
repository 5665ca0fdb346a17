"""Header contract: which files carry every required column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.contracts import CORRUPT_COLUMN, REQUIRED_COLUMNS, SOURCE_FILE_COLUMN
from tillroll.functions.columns import header_fields

# Names the reader uses for its own bookkeeping columns.
RESERVED_COLUMNS = (CORRUPT_COLUMN, SOURCE_FILE_COLUMN)


def header_contract(
    headers: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS
) -> DataFrame:
    """Check each file's header against the required columns.

    Names are compared case-sensitively and order-free; extra columns are
    allowed. Adds:
      header   array of column names in file order
      missing  required names absent from the header (sorted)
      extra    header names that are not required (header order)
      ok       no column missing, no duplicate name (ignoring case), no
               reserved name, no unbalanced quote
      reason   null when ok, else why the file is set aside
    """
    req = F.array(*[F.lit(c) for c in required])
    h = headers.withColumn("header", header_fields("header_line"))
    if "no_line_end" not in h.columns:  # the bounded reader tells
        h = h.withColumn("no_line_end", F.lit(False))
    quotes = F.length("header_line") - F.length(F.regexp_replace("header_line", '"', ""))
    missing = F.array_sort(F.array_except(req, F.col("header")))
    # Spark resolves column names case-insensitively by default, so names
    # that differ only in case would collide in the reader: set them aside.
    dup = F.size(F.array_distinct(F.transform("header", F.lower))) != F.size("header")
    reason = (
        F.when(F.col("no_line_end"), F.lit("no_line_end"))
        .when(F.col("header_line").isNull(), F.lit("empty"))
        .when(quotes % 2 != 0, F.lit("unbalanced_quotes"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))
        .when(dup, F.lit("duplicate_columns"))
        .when(F.arrays_overlap(F.transform("header", F.lower),
                               F.array(*[F.lit(c) for c in RESERVED_COLUMNS])),
              F.lit("reserved_column_name"))
    )
    return (
        h.withColumn("missing", missing)
        .withColumn("extra", F.array_except(F.col("header"), req))
        .withColumn("reason", reason)
        .withColumn("ok", F.col("reason").isNull())
        .drop("no_line_end")
    )


def route_files(manifest: DataFrame, headers: DataFrame,
                required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Manifest + header contract: one row per listed file with its route.

    Non-CSV files get reason 'not_csv', names that Spark's readers skip
    (leading '_' or '.') get 'hidden', CSV files with no line get 'empty',
    those whose header has no end within the reader's bound 'no_line_end'.
    n_lines is null where lines were not counted.
    The manifest is one short row per file, so this join is between two
    file-level tables, never data rows.
    """
    m = manifest.alias("m")
    if "no_line_end" not in headers.columns:
        headers = headers.withColumn("no_line_end", F.lit(False))
    joined = m.join(headers.alias("h"), F.col("m.file_path") == F.col("h.file_path"), "left")
    base = joined.select(
        F.col("m.file_path").alias("file_path"), "file_name", "length", F.col("m.modification_time"), "is_csv",
        F.when(F.col("is_csv"), F.col("h.header_line")).alias("header_line"),
        F.col("h.n_lines").alias("n_lines"),
        F.coalesce("h.no_line_end", F.lit(False)).alias("no_line_end"),
        # Listed, not empty, but no reader saw a line of it: Spark skips such names.
        (F.col("file_name").rlike("^[_.]") | (F.col("length") > 0) & F.col("h.file_path").isNull()
         & F.col("m.file_path").rlike("/[_.]")).alias("hidden"),
    )
    checked = header_contract(base, required)
    return checked.withColumn(
        "reason",
        F.when(~F.col("is_csv"), F.lit("not_csv"))
        .when(F.col("hidden"), F.lit("hidden"))
        .otherwise(F.col("reason")),
    ).withColumn("ok", F.col("reason").isNull()).drop("hidden")
