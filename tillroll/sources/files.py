"""File listing and header discovery, both as single Spark jobs."""

from __future__ import annotations

import re
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import source_path
from tillroll.session import fresh_dir
from tillroll.sources import fs


def _as_list(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


_GLOB_CHARS = re.compile(r"([\\\[\]{}*?])")


def literal_paths(paths: list[str]) -> list[str]:
    """Escape glob characters so Spark reads each listed file as named.

    Spark expands glob patterns in reader paths; a listed file called
    ``sales[1].csv`` would otherwise be read as a pattern.
    """
    return [_GLOB_CHARS.sub(r"\\\1", p) for p in paths]


LISTING = "file_path string, length bigint, mtime bigint, is_dir boolean"
#: Folders that a task lists before it hands the rest back.
FOLDERS_PER_TASK = 200
#: Statuses that the driver writes at once where tasks cannot list.
BLOCK = 20_000


def _lister(most: int):
    """mapInArrow body: the files of each folder and of those below it; folders left over come back as such."""
    def work(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        kind = pa.schema([("file_path", pa.string()), ("length", pa.int64()), ("mtime", pa.int64()), ("is_dir", pa.bool_())])
        for batch in batches:
            todo, done = batch.column(0).to_pylist(), 0
            while todo and done < most:
                uri = todo.pop()
                done += 1
                store, path = _arrow_fs_path(uri)
                here = store.get_file_info([path])[0]
                if here.type == pafs.FileType.NotFound:
                    raise FileNotFoundError(uri)
                whole = here.type == pafs.FileType.File
                found = [here] if whole else store.get_file_info(pafs.FileSelector(path))
                name = (lambda i: uri) if whole else (lambda i: f"{uri.rstrip('/')}/{i.base_name}")
                todo += [name(i) for i in found if i.type == pafs.FileType.Directory]
                files = [i for i in found if i.type == pafs.FileType.File]
                for k in range(0, len(files), BLOCK):
                    part = files[k:k + BLOCK]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name(i) for i in part], pa.string()), pa.array([i.size for i in part], pa.int64()),
                        pa.array([i.mtime_ns // 1_000_000 for i in part], pa.int64()), pa.array([False] * len(part))], schema=kind)
            if todo:
                n = len(todo)
                yield pa.RecordBatch.from_arrays([pa.array(todo, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([True] * n)], schema=kind)
    return work


def _listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Every file below ``roots`` as a written table (file_path, length, mtime)."""
    out, parts = fresh_dir(spark, "listing"), []
    roots = sorted({fs.qualified(spark, r).rstrip("/") for r in roots})
    roots = [r for r in roots if not any(r.startswith(q + "/") for q in roots)]  # each file once
    if reachable(roots):
        todo = [(r,) for r in roots]
        while todo:
            rows = spark.createDataFrame(todo, "path string").mapInArrow(_lister(FOLDERS_PER_TASK), LISTING)
            parts.append(f"{out}/{len(parts)}")
            rows.write.parquet(parts[-1])
            todo = [(r[0],) for r in spark.read.schema(LISTING).parquet(parts[-1]).where("is_dir").select("file_path").collect()]
    else:
        found = (x for r in roots for x in fs.files(spark, r))
        while block := list(islice(found, BLOCK)):
            parts.append(f"{out}/{len(parts)}")
            spark.createDataFrame([(path, length, mtime, False) for path, _, length, mtime in block], LISTING).write.parquet(parts[-1])
    if not parts:
        return spark.createDataFrame([], LISTING)
    return spark.read.schema(LISTING).parquet(*parts).where("not is_dir")


def file_manifest(
    spark: SparkSession, paths: str | list[str], extension: str = ".csv"
) -> DataFrame:
    """Every file under ``paths`` (recursive), with size, mtime and its route.

    Tasks list: each takes a folder and what lies below it, and hands folders
    beyond FOLDERS_PER_TASK back for the next round, so the driver only ever
    sees folders; the files go to a table. Where Python workers cannot open the
    store (see ``reachable``), the driver walks it and writes the statuses in
    blocks. Empty files and hidden names, which Spark's readers leave out, are
    listed; Spark's own markers and checksums of its writes (_SUCCESS, .crc)
    are not landing files. The extension is compared with its case. No
    contents are read; listings have no page limit.

    Columns: file_path, file_name, length, modification_time, is_csv.
    """
    name = F.element_at(F.split("file_path", "/"), -1)
    return _listing(spark, _as_list(paths)).withColumn("file_name", name) \
        .where("NOT (file_name = '_SUCCESS' OR endswith(file_name, '.crc'))").select(
            "file_path", "file_name", "length", F.timestamp_millis("mtime").alias("modification_time"),
            F.col("file_name").endswith(extension).alias("is_csv"))


def file_headers(spark: SparkSession, paths: str | list[str],
                 path_glob: str | None = None, recursive: bool = False) -> DataFrame:
    """First line and line count of every file, in one text scan.

    The first line of a file is the line with the smallest
    (file_block_start, row position) among that file's lines that are not
    blank (Spark's CSV reader skips blank lines before a header too); the row
    position comes from monotonically_increasing_id, which grows with the
    line order inside each split. Both aggregates are partial (map-side), so
    a file split into many blocks still reduces to one row before the
    shuffle. Empty files produce no row (left-join a manifest to find them). A
    line is read whole, however long (``file_headers_first_bytes`` is bounded).

    Columns: file_path, header_line, n_lines.
    """
    reader = spark.read
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.text(_as_list(paths)).select(
        "value",
        source_path().alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
    )
    return lines.groupBy("file_path").agg(
        F.min_by("value", F.when(F.trim("value") != "", F.struct("block_start", "pos"))).alias("header_line"),
        F.count(F.lit(1)).alias("n_lines"),
    )


HEAD_BYTES = 64 * 1024
#: A header must end within so many bytes; a file without a line end there is set aside whole.
MOST_HEADER_BYTES = 16 * 1024 * 1024


def _arrow_fs_path(uri: str):
    """Spark/Hadoop file URI -> (pyarrow filesystem, path)."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        # Manifest paths are raw (not URL-encoded): use them as they are.
        local = uri[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("s3a://") or uri.startswith("s3n://"):
        uri = "s3://" + uri.split("://", 1)[1]
    return pafs.FileSystem.from_uri(uri)


def _first_lines(most: int):
    """mapInPandas body: read each file's first line that is not blank from its first bytes."""
    def work(batches):
        import pandas as pd

        for pdf in batches:
            heads, endless = [], []
            for uri in pdf["file_path"]:
                store, path = _arrow_fs_path(uri)
                line, rest, size, end = b"", b"", 0, b"\n"
                with store.open_input_stream(path) as fh:
                    while not line.strip() and end and size <= most:
                        parts = [rest]
                        while b"\n" not in parts[-1]:
                            chunk = fh.read(HEAD_BYTES) if size <= most else b""
                            if not chunk:
                                break
                            parts.append(chunk)
                            size += len(chunk)
                        line, end, rest = b"".join(parts).partition(b"\n")
                endless.append(size > most and (not end or not line.strip()))
                text = line.rstrip(b"\r").decode("utf-8", errors="replace").lstrip("\ufeff")
                heads.append(text if text.strip() and not endless[-1] else None)
            yield pd.DataFrame({"file_path": pdf["file_path"], "header_line": heads,
                                "n_lines": pd.Series([None] * len(heads), dtype="Int64"), "no_line_end": endless})
    return work


def reachable(paths: str | list[str]) -> bool:
    """Whether Python workers can be expected to open these paths: local or
    mounted files, and stores that Arrow has a client for."""
    schemes = {p.split(":", 1)[0] if ":" in p.split("/", 1)[0] else "file" for p in _as_list(paths)}
    return schemes <= {"file", "s3", "s3a", "s3n", "gs"}


def file_headers_first_bytes(manifest: DataFrame, files_per_task: int = 1000, most: int = MOST_HEADER_BYTES) -> DataFrame:
    """First line of every CSV file in a manifest, reading only its first bytes.

    Same output as ``file_headers`` except ``n_lines`` is null (lines are not
    counted) and ``no_line_end`` marks files without a header line within
    ``most`` bytes; a task holds no more of a file than that. Work is
    O(files), not O(bytes): each Spark task opens its share of the files
    through Arrow's filesystem layer and reads until the
    end of the first line that is not blank. The Python workers must be able
    to reach the storage themselves (Arrow does not use Hadoop's
    credentials); ``reachable`` says for which paths that is expected.
    """
    csv = manifest.filter("is_csv AND length > 0 AND NOT file_name RLIKE '^[_.]'").select("file_path")
    n = max(1, int(csv.count() // files_per_task) + 1)
    return csv.repartition(n, "file_path").mapInPandas(
        _first_lines(most), "file_path string, header_line string, n_lines bigint, no_line_end boolean")
