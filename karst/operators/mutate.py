"""Row changes expressed as new DataFrames: delete and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from karst.functions.expressions import bind
from karst.operators.bounds import HOT_ROWS, dealt, fits_broadcast, hot_keys, key_load, left_join_unique, quoted, task_parts
from karst.schema import SchemaMismatch, conform


class DuplicateKeys(ValueError):
    """A side that must be unique on its key is not."""


def as_predicate(predicate: str | Column) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def delete_rows(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Rows that remain.  A predicate that is null for a row keeps the row."""
    return df.filter(~F.coalesce(bind(as_predicate(predicate), df), F.lit(False)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys stored more than once, with their count.

    Counts are combined on the map side, so a hot key shuffles one row per task.
    """
    columns = [F.col(quoted(k)) for k in keys]
    present = df.select(*columns).dropna(subset=list(keys)) if keys else df
    return present.groupBy(*columns).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a non-null key is stored twice.  Rows are dealt by key, as unique keys do not combine before a shuffle."""
    present = df.select(*[F.col(quoted(k)) for k in keys]).dropna(subset=list(keys))
    load = key_load(present, keys)
    hot = hot_keys(present, keys, load)
    found = hot.first() if hot is not None else duplicate_keys(dealt(present, task_parts(df, load[0]), keys), keys).first()
    if found is not None:
        raise DuplicateKeys(f"{what} has duplicate keys, for example {found.asDict()}")


def merge_insert(target: DataFrame, source: DataFrame, on: str | Sequence[str], *,
                 update: bool = True, insert: bool = True, condition: str | Column | None = None,
                 check_source: bool = True, hot_rows: int = HOT_ROWS, small: bool | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` on the key columns ``on``.

    A matching row takes every column of its source row, if ``update`` is set
    and ``condition`` (over ``target.`` and ``source.`` columns) is true; a null
    condition does not update.  Source rows without a match are added if
    ``insert`` is set.  Null keys never match.  Duplicate source keys raise.

    The update is a left join from the target, and the insert an anti join
    against its distinct keys: a small source never shuffles the target, and a
    key that is hot in the target is split instead of meeting in one task.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        raise ValueError("name at least one key column")
    for key in keys:
        if key not in target.columns:
            raise SchemaMismatch(f"merge key does not exist: {key}")
    source = conform(source, target.schema)
    if check_source:
        check_unique(source, keys, "merge source")
    key_columns = [F.col(quoted(k)) for k in keys]
    if small is None:
        small = fits_broadcast(source)
    result = target
    if update:
        row = F.struct(*[F.col(quoted(c)) for c in source.columns]).alias("source")
        matches = source.dropna(subset=keys).select(*key_columns, row, F.lit(True).alias("_hit"))
        whole = F.struct(*[F.col(quoted(c)) for c in target.columns])
        packed = target.select(*key_columns, whole.alias("target"))
        joined = left_join_unique(packed, matches, keys, F.xxhash64("target"), hot_rows=hot_rows, small=small, bounded=True)
        take = F.coalesce(F.col("_hit"), F.lit(False))
        if condition is not None:
            take = take & F.coalesce(bind(as_predicate(condition), joined), F.lit(False))
        result = joined.select(*[
            F.when(take, F.col(f"source.{quoted(c)}")).otherwise(F.col(f"target.{quoted(c)}")).alias(
                c, metadata=target.schema[c].metadata or {})
            for c in target.columns])
    if insert:
        result = result.unionByName(unmatched(target, source, keys, small, hot_rows))
    return result


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str], small: bool | None = None,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Source rows whose key is not in the target.

    A source that fits a broadcast restricts the target keys to its own and
    makes them distinct, so the target is not shuffled.  Otherwise hot target
    keys are sent once, and the others as they are stored.
    """
    names = [F.col(quoted(k)) for k in keys]
    known = target.select(*names).dropna(subset=list(keys))
    if fits_broadcast(source) if small is None else small:
        known = known.join(F.broadcast(source.select(*names)), list(keys), "left_semi").distinct()
        parts = None
    else:
        load = key_load(known, keys, hot_rows)
        hot = hot_keys(known, keys, load, hot_rows)
        if hot is not None:
            hot = hot.select(*names)
            known = known.join(F.broadcast(hot) if fits_broadcast(hot) else hot, list(keys), "left_anti").unionByName(hot)
        parts = task_parts(target, load[0] + source.count())
    fresh = dealt(source, parts, keys).join(dealt(known, parts, keys), list(keys), "left_anti")
    return fresh.select(*[F.col(quoted(c)) for c in target.columns])
