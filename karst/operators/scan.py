"""Filtered, projected and paged scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from karst.functions.expressions import bind
from karst.operators.bounds import quoted
from karst.operators.numbering import ANY_N, any_rows, smallest


def check_count(value: int, what: str, minimum: int = 0) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < minimum:
        raise ValueError(f"{what} must be an integer of at least {minimum}")
    return value


def select_cols(df: DataFrame, *columns) -> DataFrame:
    """Existing columns only, by name, in the order given."""
    names = list(columns[0]) if len(columns) == 1 and not isinstance(columns[0], str) else list(columns)
    if not names:
        raise ValueError("select at least one column")
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"column does not exist: {', '.join(unknown)}")
    return df.select(*[F.col(quoted(n)) for n in names])


def where(df: DataFrame, predicate: str | Column | None) -> DataFrame:
    """Rows for which the SQL text or Column predicate is true."""
    return df if predicate is None else df.filter(bind(predicate, df))


def page(df: DataFrame, limit: int | None = None, offset: int = 0,
         key: str | Sequence[str] | None = None) -> DataFrame:
    """``limit`` rows after ``offset``.  Pages are stable only with a unique ``key``.

    With a key a deep page is cut out of a range shuffle, and without one out
    of the partitions as they are, so no task holds what comes before it.
    """
    check_count(offset, "offset")
    if limit is not None:
        check_count(limit, "limit")
    if key is not None:
        keys = [key] if isinstance(key, str) else list(key)
        if limit is not None:
            return smallest(df, keys, limit, offset)
        df = df.orderBy(*[F.col(quoted(k)) for k in keys])
    elif limit is not None and limit + offset > ANY_N:
        return any_rows(df, limit, offset)
    if offset:
        df = df.offset(offset)
    return df if limit is None else df.limit(limit)
