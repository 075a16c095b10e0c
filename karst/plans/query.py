"""Fluent queries over a stored table.

Every call returns a new object, and ``execute()`` a lazy DataFrame.  If both a
SQL filter and an expression filter are set, the expression is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame

from karst.functions.metrics import check_metric, query_vector
from karst.operators.scan import check_count, page, select_cols, where as apply_where
from karst.operators.search import knn, vector_column


def plan_text(df: DataFrame, verbose: bool = False) -> str:
    """The plan of a DataFrame as text, without running it."""
    execution = df._jdf.queryExecution()
    return execution.toString() if verbose else execution.simpleString()


def _names(columns) -> tuple[str, ...]:
    names = list(columns[0]) if len(columns) == 1 and not isinstance(columns[0], str) else list(columns)
    if not names:
        raise ValueError("select at least one column")
    return tuple(names)


@dataclass(frozen=True)
class ScanQuery:
    table: Any
    sql: str | None = None
    expression: Column | None = None
    columns: tuple[str, ...] | None = None
    count: int | None = None
    skip: int = 0
    order: tuple[str, ...] | None = None
    index: str | None = None

    def filter_where(self, sql: str) -> "ScanQuery":
        return replace(self, sql=sql)

    def filter_expr(self, expression: Column) -> "ScanQuery":
        return replace(self, expression=expression)

    def select_cols(self, *columns) -> "ScanQuery":
        return replace(self, columns=_names(columns))

    def limit(self, n: int) -> "ScanQuery":
        return replace(self, count=check_count(n, "limit"))

    def offset(self, n: int) -> "ScanQuery":
        return replace(self, skip=check_count(n, "offset"))

    def order_key(self, *columns: str) -> "ScanQuery":
        """A unique key that makes pages stable."""
        return replace(self, order=_names(columns))

    def use_index(self, name: str) -> "ScanQuery":
        """Read through the range or value layout of an index."""
        return replace(self, index=name)

    def execute(self) -> DataFrame:
        predicate = self.expression if self.expression is not None else self.sql
        if self.index is not None:
            df = self.table.indexes.scan(self.index, predicate)
        else:
            df = apply_where(self.table.to_df(), predicate)
        df = page(df, self.count, self.skip, self.order)
        return df if self.columns is None else select_cols(df, list(self.columns))

    def explain(self, verbose: bool = False) -> str:
        return plan_text(self.execute(), verbose)


@dataclass(frozen=True)
class VectorQuery:
    table: Any
    vector: Any
    column: str | None = None
    metric: str | None = None
    sql: str | None = None
    expression: Column | None = None
    pre: bool = True
    columns: tuple[str, ...] | None = None
    count: int | None = None
    skip: int = 0
    probes: int | None = 20
    refine: int | None = None
    tie: tuple[str, ...] | None = None
    exact: bool = False

    def __post_init__(self):
        if not isinstance(self.vector, (bytes, bytearray)):
            query_vector(self.vector)
        vector_column(self.table.schema, self.column)

    def distance_type(self, metric: str) -> "VectorQuery":
        return replace(self, metric=check_metric(metric))

    def nprobes(self, n: int) -> "VectorQuery":
        return replace(self, probes=check_count(n, "nprobes", 1))

    def refine_factor(self, n: int) -> "VectorQuery":
        return replace(self, refine=check_count(n, "refine_factor", 1))

    def ef(self, n: int) -> "VectorQuery":
        """Accepted for compatibility; it tunes a graph these indexes do not have."""
        check_count(n, "ef", 1)
        return self

    def filter_where(self, sql: str) -> "VectorQuery":
        return replace(self, sql=sql)

    def filter_expr(self, expression: Column) -> "VectorQuery":
        return replace(self, expression=expression)

    def prefilter(self, before: bool) -> "VectorQuery":
        return replace(self, pre=before)

    def select_cols(self, *columns) -> "VectorQuery":
        return replace(self, columns=_names(columns))

    def limit(self, n: int) -> "VectorQuery":
        return replace(self, count=check_count(n, "limit"))

    def offset(self, n: int) -> "VectorQuery":
        return replace(self, skip=check_count(n, "offset"))

    def tie_break(self, *columns: str) -> "VectorQuery":
        return replace(self, tie=_names(columns))

    def flat(self) -> "VectorQuery":
        """Ignore indexes and scan."""
        return replace(self, exact=True)

    def execute(self) -> DataFrame:
        if self.count is None:
            raise ValueError("set limit(k) on a vector query")
        predicate = self.expression if self.expression is not None else self.sql
        column = vector_column(self.table.schema, self.column)
        select: Sequence[str] | None = None if self.columns is None else list(self.columns)
        record = None if self.exact else self.table.indexes.for_column(column)
        if record is not None and self.metric in (None, record.options["metric"]):
            return self.table.indexes.search(record, self.vector, self.count, self.probes, self.refine, predicate,
                                             self.pre, select, self.tie, self.skip)
        return knn(self.table.to_df(), self.vector, self.count, column, self.metric or "l2", self.tie, predicate,
                   self.pre, select, self.skip)

    def explain(self, verbose: bool = False) -> str:
        return plan_text(self.execute(), verbose)
