"""Predicate vocabulary on top of Spark's ``Column``."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.classic.column import Column as SparkColumn

from karst.schema import is_integral

_PLAIN = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*")


class Expression(SparkColumn):
    """A Column whose ``/`` truncates between integers, once the rows it reads are known.

    Operand types are only known to the DataFrame that an expression is used
    on.  ``where`` and the other operators of this package bind it there; used
    directly on a DataFrame, or inside a function of ``pyspark.sql``, it is the
    plain Column, whose quotients have fractions.
    """

    def __init__(self, jc, bound=None):
        super().__init__(jc)
        self._bound = bound

    def bound(self, df: DataFrame) -> Column:
        return SparkColumn(self._jc) if self._bound is None else self._bound(df)

    def __truediv__(self, other) -> "Expression":
        other = other if isinstance(other, Column) else F.lit(other)
        return Expression(SparkColumn.__truediv__(self, other)._jc, lambda df: divide(bind(self, df), bind(other, df), df))

    def __rtruediv__(self, other) -> "Expression":
        other = other if isinstance(other, Column) else F.lit(other)
        return Expression(SparkColumn.__truediv__(other, self)._jc, lambda df: divide(bind(other, df), bind(self, df), df))


def bind(expr, df: DataFrame):
    """``expr`` as a plain Column over the rows of ``df``; anything that is no ``Expression`` stays as it is."""
    return expr.bound(df) if isinstance(expr, Expression) else expr


def _lift(name: str, reflected: str | None = None) -> None:
    plain = getattr(SparkColumn, name)

    def forward(self, *args):
        return Expression(plain(self, *args)._jc, lambda df: plain(bind(self, df), *[bind(a, df) for a in args]))

    def backward(self, other):
        other = other if isinstance(other, Column) else F.lit(other)
        return Expression(plain(other, self)._jc, lambda df: plain(bind(other, df), bind(self, df)))

    setattr(Expression, name, forward)
    if reflected is not None:
        setattr(Expression, reflected, backward)


for _name in ("add", "sub", "mul", "mod", "and", "or"):
    _lift(f"__{_name}__", f"__r{_name}__")
for _name in ("__eq__", "__ne__", "__lt__", "__le__", "__gt__", "__ge__", "__neg__", "__invert__", "eqNullSafe", "between", "isin",
              "isNull", "isNotNull", "isNaN", "cast", "astype", "alias", "like", "rlike", "contains", "startswith", "endswith"):
    _lift(_name)


def col(name: str, quote: bool = False) -> Column:
    """Column by name.  Dotted plain names stay qualified (``target.value``);
    anything else, such as a name with a space, is quoted as one identifier."""
    plain = name if not quote and _PLAIN.fullmatch(name) else "`" + name.replace("`", "``") + "`"
    return Expression(F.col(plain)._jc)


def lit(value) -> Column:
    """Literal of the widths the predicates use: string, 64-bit integer, double, boolean.

    A ``numpy.float32`` is widened exactly, so comparing it with a stored float
    of the same value is an equality.  Nothing is narrowed to the column type.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, (bool, np.bool_)):
        typed = F.lit(bool(value))
    elif isinstance(value, (int, np.integer)):
        typed = F.lit(int(value)).cast(T.LongType())
    elif isinstance(value, (float, np.floating)):
        typed = F.lit(float(value)).cast(T.DoubleType())
    elif isinstance(value, str):
        typed = F.lit(value)
    else:
        raise TypeError(f"unsupported literal type {type(value).__name__}")
    return Expression(typed._jc)


def isnull(expr: Column) -> Column:
    return expr.isNull()


def isnotnull(expr: Column) -> Column:
    return expr.isNotNull()


def isin(expr: Column, *values) -> Column:
    """``expr IN (values)`` for a list written in the query.  Long lists of ids
    belong in a DataFrame and a semi join instead."""
    if not values:
        raise ValueError("isin needs at least one value")
    return expr.isin(*[lit(v) for v in values])


def notiin(expr: Column, *values) -> Column:
    if not values:
        raise ValueError("notiin needs at least one value")
    return ~expr.isin(*[lit(v) for v in values])


def divide(left: Column, right: Column, on: DataFrame) -> Column:
    """Quotient that truncates when both sides are integral, as in SQL engines
    without implicit fractions.  ``on`` supplies the operand types."""
    left, right = bind(lit(left), on), bind(lit(right), on)
    schema = on.select(left.alias("l"), right.alias("r")).schema
    if is_integral(schema["l"].dataType) and is_integral(schema["r"].dataType):
        return F.call_function("div", left, right)
    return left / right
