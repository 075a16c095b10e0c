"""Rows by application id, in the order the caller asked for."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from karst.operators.bounds import HOT_ROWS, left_join_unique, quoted
from karst.schema import is_integral

POS = "pos"
LITERAL_IDS = 1000


def _id_type(schema: T.StructType, id_column: str) -> T.DataType:
    if id_column not in schema.names:
        raise ValueError(f"id column does not exist: {id_column}")
    dtype = schema[id_column].dataType
    if not (is_integral(dtype) or isinstance(dtype, T.StringType)):
        raise ValueError("the id column must contain integers or strings")
    return dtype


def check_ids(ids: Iterable) -> list:
    """Ids written in the caller's code: strings or 64-bit integers, not mixed."""
    values = list(ids)
    for value in values:
        if isinstance(value, str):
            continue
        if isinstance(value, bool) or not isinstance(value, int):
            raise ValueError("ids must be strings or integers, without nulls")
        if not -(1 << 63) <= value < 1 << 63:
            raise ValueError("integer ids must fit 64 bits")
    if len({isinstance(v, str) for v in values}) > 1:
        raise ValueError("ids are either all text or all whole numbers")
    return values


def request_frame(spark: SparkSession, ids: Iterable, id_column: str = "id") -> DataFrame:
    """Request DataFrame ``(pos, id)`` for ids given as a Python list."""
    values = check_ids(ids)
    kind = T.StringType() if values and isinstance(values[0], str) else T.LongType()
    schema = T.StructType([T.StructField(POS, T.LongType()), T.StructField(id_column, kind)])
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], schema)


def projection(schema: T.StructType, id_column: str, columns: Sequence[str] | None) -> list[str]:
    _id_type(schema, id_column)
    names = list(schema.names) if columns is None else list(columns)
    if not names:
        raise ValueError("select at least one column")
    if len(set(names)) != len(names):
        raise ValueError("a column is listed twice")
    unknown = [n for n in names if n not in schema.names]
    if unknown:
        raise ValueError(f"column does not exist: {', '.join(unknown)}")
    return names


def stored_duplicates(df: DataFrame, request: DataFrame, id_column: str = "id") -> DataFrame:
    """Requested ids that are stored more than once, with their count."""
    wanted = request.select(F.col(quoted(id_column))).distinct()
    return (df.select(F.col(quoted(id_column))).join(wanted, id_column, "left_semi")
            .groupBy(F.col(quoted(id_column))).agg(F.count("*").alias("copies")).filter("copies > 1"))


def take_ids(df: DataFrame, request: DataFrame | Iterable, id_column: str = "id",
             columns: Sequence[str] | None = None, on_missing: str = "error",
             ordered: bool = True, keep_pos: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Stored rows for a request ``(pos, id)``, in request order, repeats included.

    A requested id that is stored twice raises when the result is computed, and
    so does an id that is not stored, unless ``on_missing="skip"`` leaves it out.
    A long list of ids should arrive as a DataFrame.  Each distinct id is
    fetched once, and an id that fills much of the request is split over tasks.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing must be 'error' or 'skip'")
    dtype = _id_type(df.schema, id_column)
    names = projection(df.schema, id_column, columns)
    listed = not isinstance(request, DataFrame)
    literal = None
    if listed:
        values = check_ids(request)
        literal = list(dict.fromkeys(values)) if len(values) <= LITERAL_IDS else None
        request = request_frame(df.sparkSession, values, id_column)
    have = request.schema[id_column].dataType
    if isinstance(have, T.StringType) != isinstance(dtype, T.StringType) or not (
            is_integral(have) or isinstance(have, T.StringType)):
        raise ValueError(f"requested ids are {have.simpleString()}, the column is {dtype.simpleString()}")
    key = F.col(quoted(id_column))
    request = request.select(F.col(POS), key)
    if literal:
        # ids written in the call reach the Parquet scan as a filter
        df = df.filter(key.isin(literal))
    # one row per id, combined on the map side; a second copy is an error
    stored = (df.select(key, F.struct(*[F.col(quoted(n)) for n in names]).alias("_row"))
              .join(request.select(key).distinct(), id_column, "left_semi")
              .groupBy(key).agg(F.any_value("_row").alias("_row"), F.count("*").alias("_copies")))
    if listed:
        joined = request.join(stored, id_column, "left")
    else:
        joined = left_join_unique(request, stored, [id_column], F.col(POS), hot_rows=hot_rows, small=False)
    shown = F.coalesce(key.cast("string"), F.lit("null"))
    if on_missing == "skip":
        joined = joined.filter(F.col("_copies").isNotNull())
    checked = (F.when(F.col("_copies") == 1, F.col(POS))
               .when(F.col("_copies") > 1, F.raise_error(F.concat(F.lit("duplicate stored id: "), shown)).cast("bigint"))
               .otherwise(F.raise_error(F.concat(F.lit("id is not stored: "), shown)).cast("bigint")))
    # the filter keeps the check alive when pos itself is not returned
    joined = joined.withColumn(POS, checked).filter(F.col(POS).isNotNull())
    if ordered:
        joined = joined.orderBy(POS)
    return joined.select(*([POS] if keep_pos else []),
                         *[F.col(f"_row.{quoted(n)}").alias(n, metadata=df.schema[n].metadata or {}) for n in names])
