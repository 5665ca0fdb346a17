"""Read accepted sales files: one scan per header layout, and one for folders that mix layouts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.contracts import (
    ADDITIONAL_COLUMN,
    CONTRACT_TYPES,
    CORRUPT_COLUMN,
    REQUIRED_COLUMNS,
    SALES_SCHEMA,
    SOURCE_FILE_COLUMN,
)
from tillroll.functions.columns import fold_columns, source_path
from tillroll.operators.conform import conform, reconcile_layouts
from tillroll.session import fresh_dir
from tillroll.sources.files import literal_paths

CORRUPT = CORRUPT_COLUMN
SOURCE_FILE = SOURCE_FILE_COLUMN


@dataclass
class SalesRead:
    """Result of reading a batch of sales files.

    parsed    every data row of every accepted file, contract columns plus
              the source file and the raw text of malformed rows
    accepted  rows that parsed cleanly, in the contract schema (+ source file)
    rejects   malformed rows: source file, reason, raw line
    layouts   number of distinct header layouts read
    """

    parsed: DataFrame
    layouts: int

    @property
    def accepted(self) -> DataFrame:
        return self.parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)

    @property
    def rejects(self) -> DataFrame:
        return reject_rows(self.parsed)


def layout_schema(header: list[str]) -> T.StructType:
    """Schema in the file's own column order: contract types for known names,
    string for extras, plus the corrupt-record column.

    Spark's CSV reader maps a given schema by position, so building it in
    header order is what makes a reordered file read correctly.
    """
    fields = [T.StructField(c, CONTRACT_TYPES.get(c, T.StringType()), True) for c in header]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_options(header: list[str]) -> dict[str, str]:
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "dateFormat": "yyyy-MM-dd",
        "escape": '"',  # a doubled quote inside a quoted value is one quote
        "maxColumns": str(max(20_480, len(header) + 1)),
    }


def read_layout(spark: SparkSession, header: list[str], paths: list[str]) -> DataFrame:
    """Read all files of one layout with an explicit schema, PERMISSIVE."""
    raw = (
        spark.read.schema(layout_schema(header))
        .options(**parse_options(header))
        .option("header", "true")
        .option("pathGlobFilter", "*.csv")
        .csv(literal_paths(paths))
        .withColumn(SOURCE_FILE, source_path())
    )
    return conform(raw, header)


def folder_of(path: str) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def layout_folders(routed: DataFrame, listed: DataFrame | None = None) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """(header layout -> folders whose CSV files are all accepted with that layout and
    have nothing below them, the other folders with an accepted file).

    ``listed`` is the manifest where it has files that are not routed (column
    ``known`` not null); they lie in the folders too.
    Only layouts and folders reach the driver, never files.
    """
    files = routed.filter("is_csv").select(
        folder_of("file_path").alias("folder"), "ok", "header",
        F.when(F.col("ok"), F.array_join("header", "\u0001")).alias("layout"))
    paths = routed.select("file_path")
    if listed is not None:
        others = listed.filter("known IS NOT NULL")
        files = files.union(others.filter("is_csv").select(
            folder_of("file_path"), F.lit(False), F.lit(None).cast("array<string>"), F.lit(None).cast("string")))
        paths = paths.union(others.select("file_path"))
    per = files.groupBy("folder").agg(
        F.bool_and("ok").alias("all_ok"), F.bool_or("ok").alias("any_ok"), F.count_distinct("layout").alias("n"),
        F.first("header", ignorenulls=True).alias("header"))
    # Folders that have listed files somewhere below them: Spark would read those too.
    above = (paths.select(F.split(folder_of("file_path"), "/").alias("p")).distinct()
             .select(F.explode(F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.array_join(F.slice("p", 1, i), "/"))).alias("folder"))
             .distinct().withColumn("has_below", F.lit(True)))
    rows = per.filter("any_ok").join(above, "folder", "left").select(
        "folder", "header", (F.col("all_ok") & (F.col("n") == 1) & F.col("has_below").isNull()).alias("whole")).collect()
    whole: dict[tuple[str, ...], list[str]] = {}
    for r in rows:
        if r["whole"]:
            whole.setdefault(tuple(r["header"]), []).append(r["folder"])
    return {k: sorted(v) for k, v in sorted(whole.items())}, sorted(r["folder"] for r in rows if not r["whole"])


def file_lines(spark: SparkSession, files: DataFrame, folders: list[str], skip: list[str], header: bool) -> DataFrame:
    """The columns of ``files`` and ``line``: the lines of those files, which lie in ``folders``.

    The folders are listed by Spark. Files elsewhere, files that are smaller or
    larger, older or newer than all of ``files``, and those whose paths are in ``skip`` are left
    out by a filter on the file's metadata, which Spark applies to the listing, so
    they are not opened; a join on the path decides about the rest. Where a folder
    keeps its earlier files, these are the older ones. Lines are split as Spark's CSV reader does, blank ones
    left out; without ``header``, so is each file's first.
    """
    slack = F.expr("INTERVAL 2 SECONDS")  # two listings of a store may round a time differently
    least, most, old, new = files.agg(F.min("length"), F.max("length"), F.min("modification_time") - slack, F.max("modification_time") + slack).first()
    raw, names = "_raw", sorted(set(folders))
    top = [f for f in names if not any(f.startswith(g + "/") for g in names)]
    lines = (spark.read.schema(f"line string, {raw} string")
             .option("header", str(not header).lower()).option("sep", "\u0001").option("quote", "")
             .option("columnNameOfCorruptRecord", raw)
             .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
             .csv(literal_paths(top)))
    inside = F.regexp_extract(source_path(), r"^(.*)/[^/]*$", 1).isin(names)
    if skip:
        inside = inside & ~source_path().isin(skip)
    inside = inside & F.col("_metadata.file_size").between(least, most) & F.col("_metadata.file_modification_time").between(F.lit(old), F.lit(new))
    # A line that holds the separator comes whole in the second column.
    found = lines.where(inside).select(F.coalesce(raw, "line").alias("line"), source_path().alias("file_path"))
    return found.join(files.drop("length", "modification_time"), "file_path")


def endless(routed: DataFrame, folders: list[str], listed: DataFrame | None = None) -> list[str]:
    """Files set aside for want of a line end, now or by an earlier run, which no reader of ``folders`` should open."""
    found = routed.filter("reason = 'no_line_end'").select("file_path")
    if listed is not None:
        found = found.union(listed.filter("known = 'no_line_end'").select("file_path"))
    return [r[0] for r in found.where(folder_of("file_path").isin(folders)).collect()]


def read_mixed(spark: SparkSession, routed: DataFrame, folders: list[str], listed: DataFrame | None = None) -> DataFrame:
    """The accepted files of folders that mix layouts, in one scan: each line meets its
    file's layout by a join with the routed files and is parsed under it. Only the
    layouts reach the driver."""
    ok = routed.filter("ok").where(folder_of("file_path").isin(folders))
    layouts = sorted(tuple(r[0]) for r in ok.select("header").distinct().collect())
    which = F.lit(None).cast("int")
    for i, header in enumerate(layouts):
        which = F.when(F.array_join("header", "\u0001") == "\u0001".join(header), i).otherwise(which)
    files = ok.select("file_path", "length", "modification_time", which.alias("_layout"))
    lines = file_lines(spark, files, folders, endless(routed, folders, listed), header=False)
    row = F.lit(None)
    for i, header in enumerate(layouts):
        # The lambda holds the parsed row, so it is parsed once for all its fields.
        one = F.transform(F.array(F.from_csv("line", _ddl(header), parse_options(list(header)))), _as_contract(header))
        row = F.when(F.col("_layout") == i, F.get(one, F.lit(0))).otherwise(row)
    return lines.select(row.alias("r"), F.col("file_path").alias(SOURCE_FILE))


def _as_contract(header: tuple[str, ...]):
    extras = [c for c in header if c not in REQUIRED_COLUMNS]

    def conformed(r: Column) -> Column:
        fold = fold_columns([r.getField(c) for c in extras]) if extras else F.lit(None).cast("string")
        return F.struct(*[r.getField(c).alias(c) for c in REQUIRED_COLUMNS], fold.alias(ADDITIONAL_COLUMN), r.getField(CORRUPT).alias(CORRUPT))
    return conformed


def _ddl(header: tuple[str, ...]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in layout_schema(list(header)).fields)


def read_sales(spark: SparkSession, routed: DataFrame, stage: str | None = None, listed: DataFrame | None = None) -> SalesRead:
    """Read every file with ``ok`` in a routed manifest (see route_files; ``listed``: see layout_folders).

    The parsed rows are written once as Parquet to ``stage`` (a fresh shared
    folder by default), and everything downstream reads that table. This is
    what makes the accept/reject split exact: Spark's CSV parser only converts
    the columns a query needs, so a bad value in an unused column could go
    unnoticed; the write needs every column (they are written as one struct),
    so every field of every row is
    checked, once, and no cache decides a result. A lost executor costs a
    Parquet re-read, not a CSV re-parse.

    Folders of one layout take one scan a layout; all folders that mix layouts
    or accepted and other files take one scan together (``read_mixed``).
    """
    whole, mixed = layout_folders(routed, listed)
    n = routed.filter("ok").select(F.array_join("header", "\u0001")).distinct().count()
    frames = [read_layout(spark, list(header), folders) for header, folders in whole.items()]
    columns = [*SALES_SCHEMA.names, CORRUPT]
    rows = [f.select(F.struct(*columns).alias("r"), SOURCE_FILE) for f in ([reconcile_layouts(frames)] if frames else [])]
    if mixed:
        rows.append(read_mixed(spark, routed, mixed, listed))
    if not rows:
        empty = spark.createDataFrame([], SALES_SCHEMA)
        empty = empty.withColumn(SOURCE_FILE, F.lit(None).cast("string"))
        return SalesRead(empty.withColumn(CORRUPT, F.lit(None).cast("string")), 0)
    stage = stage or fresh_dir(spark, "parsed")
    parsed = reduce(DataFrame.unionByName, rows)
    parsed.write.mode("overwrite").parquet(stage)
    return SalesRead(spark.read.schema(parsed.schema).parquet(stage).select("r.*", SOURCE_FILE), n)


def reject_rows(parsed: DataFrame) -> DataFrame:
    """Rows whose text did not parse under the contract types."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(SOURCE_FILE).alias("file_path"),
        F.lit("malformed_row").alias("reason"),
        F.col(CORRUPT).alias("raw_line"),
    )


def read_dim(spark: SparkSession, path: str, schema: T.StructType,
             fmt: str = "parquet", **options) -> DataFrame:
    """Read a dimension table with an explicit schema (never inferred)."""
    reader = spark.read.schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


__all__ = ["SalesRead", "read_sales", "read_layout", "reject_rows", "read_dim",
           "layout_schema", "REQUIRED_COLUMNS"]
