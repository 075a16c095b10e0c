"""The four distance metrics as Spark expressions.

These run inside the JVM and are the readable definition of each metric.
``kernels`` holds the vectorised form used on large scans; a test keeps both
equal.  Sums are taken in double precision and cast to float at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, functions as F, types as T

METRICS = ("l2", "cosine", "dot", "hamming")


def check_metric(metric: str) -> str:
    name = str(metric).lower()
    if name not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {', '.join(METRICS)}")
    return name


def query_vector(values: Sequence[float]) -> np.ndarray:
    """The search input as float32; it must be non-empty and finite at that width."""
    array = np.asarray(values)
    if array.ndim != 1 or array.size == 0:
        raise ValueError("the query vector must be a non-empty list of numbers")
    if array.dtype.kind not in "iuf":
        raise ValueError("the query vector must contain numbers")
    with np.errstate(over="ignore"):
        narrow = array.astype(np.float32)
    if not np.isfinite(narrow).all():
        raise ValueError("the query vector must be finite in single precision")
    return narrow


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def _products(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def distance(vector: Column, query: Column, metric: str = "l2") -> Column:
    """Distance between two array columns as a float column.

    l2 is the Euclidean distance, cosine ``1 - cos`` (null for a zero vector),
    dot ``1 - a.b`` and hamming the number of differing bits of integer codes.
    """
    metric = check_metric(metric)
    if metric == "l2":
        value = F.sqrt(_total(F.zip_with(
            vector, query, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))))
    elif metric == "dot":
        value = F.lit(1.0) - _products(vector, query)
    elif metric == "cosine":
        norms = F.sqrt(_products(vector, vector)) * F.sqrt(_products(query, query))
        value = F.when(norms > 0, F.lit(1.0) - _products(vector, query) / norms)
    else:
        value = F.aggregate(
            F.zip_with(vector, query, lambda x, y: F.bit_count(
                x.cast("bigint").bitwiseXOR(y.cast("bigint")).bitwiseAND(_width_mask(x)))),
            F.lit(0), lambda acc, x: acc + x)
    return (value + F.lit(0.0)).cast(T.FloatType())


def _width_mask(code: Column) -> Column:
    """Ones for the bits that a code of this column's type has; a negative code fills more when widened."""
    kind = F.typeof(code)
    return (F.when(kind == "tinyint", F.lit(0xFF).cast("bigint")).when(kind == "smallint", F.lit(0xFFFF).cast("bigint"))
            .when(kind == "int", F.lit(0xFFFFFFFF).cast("bigint")).otherwise(F.lit(-1).cast("bigint")))


def literal_vector(values: np.ndarray) -> Column:
    """A constant array column; integral codes stay integral."""
    if values.dtype.kind in "iu":
        return F.array(*[F.lit(int(v)) for v in values])
    return F.array(*[F.lit(float(v)) for v in values])
