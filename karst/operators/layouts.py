"""Scalar access paths as physical layouts, and text postings.

A layout is a clustered copy of the rows (or an inverted table); Spark's own
partition pruning and Parquet statistics do the skipping.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from karst.functions.text import LANGUAGES, term_counts, tokens
from karst.operators.bounds import quoted

#: more values than these have no directory each
MAX_DIRECTORIES = 4096
TARGET_FILE_BYTES = 256 << 20


def write_range_layout(df: DataFrame, columns: Sequence[str], path: str, partitions: int | None = None) -> None:
    """Copy sorted by ``columns``: files and row groups cover narrow ranges.

    A spread column at the end of the range key splits a value that fills more
    than one file.  It follows the row order of ``df``, so read that from storage.
    """
    keys = [F.col(quoted(c)) for c in columns]
    spread = df.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    cut = [*keys, F.col("_spread")]
    ranged = spread.repartitionByRange(partitions, *cut) if partitions else spread.repartitionByRange(*cut)
    ranged.sortWithinPartitions(*keys).drop("_spread").write.parquet(path)


def write_value_layout(df: DataFrame, column: str, path: str, rows_per_task: int = 5_000_000) -> None:
    """Copy with one directory per value of a low-cardinality column.

    A column of more than ``MAX_DIRECTORIES`` values is sorted instead, without
    directories: file and row-group statistics do the skipping then.
    Each value is spread over as many tasks as its row count asks for, by the
    row order of ``df``, so read that from storage.
    """
    name = F.col(quoted(column))
    counts = df.groupBy(name.alias("_value")).agg(F.count("*").alias("_n"))
    # one row per distinct value, bounded
    values = counts.limit(MAX_DIRECTORIES + 1).collect()
    if len(values) > MAX_DIRECTORIES:
        write_range_layout(df, [column], path)
        return
    splits = df.sparkSession.createDataFrame(
        [(r["_value"], max(1, math.ceil(r["_n"] / rows_per_task))) for r in values],
        T.StructType([T.StructField("_value", df.schema[column].dataType), T.StructField("_splits", T.IntegerType())]))
    placed = (df.withColumn("_row", F.monotonically_increasing_id())
              .join(F.broadcast(splits), name.eqNullSafe(F.col("_value")), "left")
              .withColumn("_salt", F.pmod(F.xxhash64("_row"), F.coalesce(F.col("_splits"), F.lit(1))))
              .withColumn("_part", name)
              .repartition(name, F.col("_salt")).drop("_value", "_splits", "_salt", "_row"))
    # the value is kept as data as well, so its type survives the directory name
    placed.write.partitionBy("_part").parquet(path)


def label_postings(df: DataFrame, column: str, key: str) -> DataFrame:
    """Inverted table (label, key) of a list column; each pair once."""
    return (df.select(F.explode(F.array_distinct(F.col(quoted(column)))).alias("label"), F.col(quoted(key)))
            .filter("label IS NOT NULL"))


def rows_with_labels(df: DataFrame, postings: DataFrame, key: str, labels: Sequence, require: str = "any") -> DataFrame:
    """Rows whose list holds any (or all) of the labels, through the inverted table."""
    if not labels:
        raise ValueError("name at least one label")
    wanted = list(dict.fromkeys(labels))
    hits = postings.filter(F.col("label").isin(wanted))
    if require == "all":
        hits = (hits.groupBy(F.col(quoted(key))).agg(F.count_distinct("label").alias("n"))
                .filter(F.col("n") == len(wanted)))
    elif require != "any":
        raise ValueError("require must be 'any' or 'all'")
    return df.join(hits.select(F.col(quoted(key))), key, "left_semi")


def stop_words(language: str) -> list[str]:
    """Spark's stop-word list of a language."""
    from pyspark.ml.feature import StopWordsRemover
    name = language.lower()
    if name not in LANGUAGES:
        raise ValueError(f"no stop words for language {language!r}")
    return StopWordsRemover.loadDefaultStopWords(name)


def check_text_options(columns: Sequence[str], max_token_length: int, language: str, stem: bool) -> None:
    if not columns:
        raise ValueError("specify at least one text column")
    if len(set(columns)) != len(columns):
        raise ValueError("text columns must be unique")
    if any(not c for c in columns):
        raise ValueError("column names cannot be empty")
    if isinstance(max_token_length, bool) or not isinstance(max_token_length, int) or not (
            -1 <= max_token_length < 1 << 31):
        raise ValueError("max_token_length must be -1 or a non-negative 32-bit integer")
    if language.lower() not in LANGUAGES:
        raise ValueError(f"unknown language {language!r}")
    if stem and language.lower() != "english":
        raise ValueError("stemming is available for English")


def text_postings(df: DataFrame, columns: str | Sequence[str], key: str, tokenizer: str = "simple",
                  language: str = "English", lowercase: bool = True, stem: bool = False,
                  remove_stop_words: bool = False, ascii_folding: bool = False, max_token_length: int = -1,
                  words: Sequence[str] | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Postings ``(field, term, key, tf)`` of text columns.

    A row's tokens are counted, folded and stemmed where the row is read, so
    postings are shuffled only if a key is stored more than once.  ``words``
    replaces the stop words of ``language``.  Longer tokens than
    ``max_token_length`` are left out; -1 keeps all.  ``carry`` names further
    columns fixed by the key.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    check_text_options(names, max_token_length, language, stem)
    own = [F.col(quoted(key)), *[F.col(c) for c in carry]]
    schema = T.StructType([T.StructField("field", T.StringType()), T.StructField("term", T.StringType()),
                           *df.select(*own).schema.fields, T.StructField("tf", T.LongType())])
    listed = (list(words) if words is not None else stop_words(language)) if remove_stop_words else []
    found = None
    for name in names:
        if name not in df.columns or not isinstance(df.schema[name].dataType, T.StringType):
            raise ValueError(f"text column does not exist or is not a string: {name}")
        kept = tokens(F.col(quoted(name)), tokenizer, lowercase)
        if max_token_length >= 0:
            kept = F.filter(kept, lambda t: F.length(t) <= max_token_length)
        if listed:
            kept = F.filter(kept, lambda t: ~F.lower(t).isin([w.lower() for w in listed]))
        part = df.select(F.lit(name).alias("field"), *own, kept.alias("_tokens")).mapInArrow(term_counts(ascii_folding, stem), schema)
        found = part if found is None else found.unionByName(part)
    if df.groupBy(*own).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty():
        return found
    return found.groupBy(F.col("field"), F.col("term"), *own).agg(F.sum("tf").alias("tf"))


def doc_frequency(postings: DataFrame) -> DataFrame:
    """Documents and total occurrences per term; counts combine before the shuffle."""
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
