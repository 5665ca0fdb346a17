"""The session's Hadoop file system: names, sizes, and small texts such as commit records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p = _path(spark, path)
    return _fs(spark, p).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it; nothing if it isn't there."""
    p = _path(spark, path)
    _fs(spark, p).delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    p = _path(spark, path)
    return _fs(spark, p).getContentSummary(p).getLength()


def glob_names(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names under ``folder`` that match a glob pattern (of one or more levels), first level only."""
    root = _path(spark, folder)
    depth = pattern.count("/")
    found = _fs(spark, root).globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern)) or []
    out = []
    for status in found:
        p = status.getPath()
        for _ in range(depth):
            p = p.getParent()
        out.append(p.getName())
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark's readers name it, with its store."""
    p = _path(spark, path)
    return _fs(spark, p).makeQualified(p).toString()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; FileExistsError where there is one already (the store decides)."""
    p = _path(spark, path)
    try:
        out = _fs(spark, p).create(p, False)
    except Exception as e:
        if exists(spark, path):
            raise FileExistsError(path) from e
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p = _path(spark, path)
    stream = _fs(spark, p).open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def files(spark: SparkSession, folder: str) -> Iterator[tuple[str, str, int, int]]:
    """(path, path below the folder, length, modification time in ms) of every file under ``folder`` (or of the file itself)."""
    root = _path(spark, folder)
    store = _fs(spark, root)
    top = store.makeQualified(root).toString()
    found = store.listFiles(root, True)
    while found.hasNext():
        s = found.next()
        path = s.getPath().toString()
        yield path, path[len(top):].lstrip("/") or path.rsplit("/", 1)[-1], s.getLen(), s.getModificationTime()
