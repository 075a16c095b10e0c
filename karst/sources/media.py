"""Media as bytes: files become rows with their content in a binary column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_media(spark: SparkSession, path: str | list[str], pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, length, content) of files, optionally those matching a glob pattern.

    Spark's file reader leaves out files of zero bytes; an empty value can
    still be stored in a binary column.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content")


def media_facts(df: DataFrame, key: str, column: str = "content") -> DataFrame:
    """Byte length and MD5 of a binary column."""
    return df.select(key, F.octet_length(column).alias("n_bytes"), F.md5(column).alias("md5"))
