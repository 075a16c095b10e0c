"""Small file operations through Hadoop's file systems, so any storage Spark
can reach works: listing, existence, deletes and create-if-absent text files."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is directory, bytes) of the entries of a directory, by name; empty if absent."""
    fs = _fs(spark, path)
    target = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted((s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(target))


def tree_bytes(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def make_dirs(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not rename {source} to {target}")


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a text file; fails if it exists already."""
    stream = _fs(spark, path).create(_path(spark, path), False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
