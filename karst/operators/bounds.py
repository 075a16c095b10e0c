"""Checks that come before a broadcast, and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 1_000_000
#: rows of both sides that a task of a join by key gets, or of the one that is counted
TASK_ROWS = 1_000_000
_BUCKETS = 1 << 14


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bytes_of(name: str, dtype: T.DataType) -> Column:
    value = F.col(quoted(name))
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(dtype, T.ArrayType) and not isinstance(
            dtype.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
        size = F.size(value) * 8
    elif isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        size = F.octet_length(F.to_json(F.struct(value)))
    else:
        return F.lit(16)
    return F.coalesce(size, F.lit(0)) + F.lit(16)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` and tell whether it is small enough to send to every executor.

    Looks at no more than ``max_rows + 1`` rows, so asking is cheap on any size.
    """
    width = sum((_bytes_of(f.name, f.dataType) for f in df.schema.fields), F.lit(0))
    rows, size = (df.select(width.cast("bigint").alias("w")).limit(max_rows + 1)
                  .agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first())
    return rows <= max_rows and size <= max_bytes


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in keys]), F.lit(_BUCKETS))


def key_load(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[int, list[int]]:
    """Rows of ``df``, and the buckets of keys with more than ``hot_rows`` rows.

    A task counts buckets, not keys, so its memory does not grow with the table.
    """
    counts = df.groupBy(_bucket(keys).alias("_bucket")).agg(F.count("*").alias("_n"))
    rows, crowded = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)),
                               F.collect_list(F.when(F.col("_n") > hot_rows, F.col("_bucket")))).first()
    return rows, crowded


def hot_keys(df: DataFrame, keys: Sequence[str], load: tuple[int, list[int]], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their ``_n``, or None; only rows of crowded buckets are counted by key."""
    if not load[1]:
        return None
    counts = df.filter(_bucket(keys).isin(load[1])).groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count("*").alias("_n"))
    hot = counts.filter(F.col("_n") > hot_rows).persist()
    if hot.isEmpty():
        hot.unpersist()
        return None
    return hot


def task_parts(df: DataFrame, rows: int, task_rows: int | None = None) -> int | None:
    """Number of parts by key that keep a task at ``task_rows``; None where Spark's own number does."""
    task_rows = TASK_ROWS if task_rows is None else task_rows
    return max(-(-rows // task_rows), df.sparkSession.sparkContext.defaultParallelism) if rows > task_rows else None


def dealt(df: DataFrame, parts: int | None, keys: Sequence[str]) -> DataFrame:
    return df if parts is None else df.repartition(parts, *[F.col(quoted(k)) for k in keys])


def with_salt(df: DataFrame, keys: Sequence[str], salt: Column, hot_rows: int = HOT_ROWS,
              load: tuple[int, list[int]] | None = None):
    """Split the hot keys of ``df``.

    Returns ``(salted, hot)``: ``salted`` has an extra ``_salt`` column, zero
    for ordinary keys; ``hot`` lists the hot keys with their number of splits
    ``_splits``, or is None when there are none.  There are at most
    ``rows / hot_rows`` hot keys, which bounds ``hot``.
    """
    names = [F.col(quoted(k)) for k in keys]
    hot = hot_keys(df, keys, key_load(df, keys, hot_rows) if load is None else load, hot_rows)
    if hot is None:
        return df.withColumn("_salt", F.lit(0)), None
    hot = hot.select(*names, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_splits"))
    splits = F.broadcast(hot) if fits_broadcast(hot) else hot
    unmatched = F.lit(False)
    for name in names:
        unmatched = unmatched | name.isNull()
    # rows with a null key match nothing, so they may go anywhere
    spread = F.when(unmatched, F.pmod(salt, F.lit(4096))).otherwise(F.pmod(salt, F.col("_splits")))
    salted = (df.join(splits, list(keys), "left")
              .withColumn("_salt", F.coalesce(spread, F.lit(0)).cast("int"))
              .drop("_splits"))
    return salted, hot


def left_join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], salt: Column,
                     how: str = "left", hot_rows: int = HOT_ROWS, small: bool | None = None,
                     bounded: bool = False) -> DataFrame:
    """``left JOIN right USING keys`` where ``right`` has at most one row per key.

    ``small`` tells whether the right side was measured to fit a broadcast; None
    measures it here.  Otherwise both sides shuffle on the key, and keys that
    are hot on the left are split into salted parts, with the one matching
    right row repeated once per part.  With ``bounded`` the sides are counted
    and dealt to as many tasks as keep each at ``TASK_ROWS``; Spark's own number
    follows the compressed bytes, and holds many more of short rows.
    """
    if fits_broadcast(right) if small is None else small:
        return left.join(F.broadcast(right), list(keys), how)
    load = key_load(left, keys, hot_rows)
    salted, hot = with_salt(left, keys, salt, hot_rows, load)
    parts = task_parts(left, load[0] + right.count()) if bounded else None
    if hot is None:
        return dealt(left, parts, keys).join(dealt(right, parts, keys), list(keys), how)
    splits = F.broadcast(hot) if fits_broadcast(hot) else hot
    spread = (right.join(splits, list(keys), "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1)))
              .drop("_splits"))
    both = [*keys, "_salt"]
    return dealt(salted, parts, both).join(dealt(spread, parts, both), both, how).drop("_salt")
