"""Schemas with fixed-dimension vector columns.

Spark arrays have no fixed length, so the dimension lives in the field
metadata and is checked with one aggregate before anything is committed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

VECTOR_DIM = "vector_dim"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType)


class SchemaMismatch(ValueError):
    """Data that does not fit the schema of its table."""


def _as_type(spec: str | T.DataType) -> T.DataType:
    return spec if isinstance(spec, T.DataType) else T.DataType.fromDDL(spec)


def make_schema(fields: Iterable[tuple[str, str | T.DataType]]) -> T.StructType:
    """Schema from ``(name, type)`` pairs; types are DDL strings or DataTypes."""
    struct = T.StructType([T.StructField(name, _as_type(spec)) for name, spec in fields])
    if not struct.fields:
        raise ValueError("a schema needs at least one column")
    if len(set(struct.names)) != len(struct.names):
        raise ValueError("column names must be unique")
    return struct


def vector_field(name: str, dim: int, element: T.DataType | None = None) -> T.StructField:
    if isinstance(dim, bool) or not isinstance(dim, int) or dim <= 0:
        raise ValueError("vector dimension must be a positive integer")
    return T.StructField(name, T.ArrayType(element or T.FloatType()), True, {VECTOR_DIM: dim})


def make_vector_schema(id_name: str, vector_name: str, dim: int,
                       id_type: str | T.DataType = "string") -> T.StructType:
    """The usual two-column schema: an id and an embedding of ``dim`` floats."""
    return T.StructType([T.StructField(id_name, _as_type(id_type)), vector_field(vector_name, dim)])


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NUMERIC)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, _INTEGRAL)


def is_vector_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.FloatType, T.DoubleType))


def vector_dims(schema: T.StructType) -> dict[str, int]:
    """Declared vector columns of a schema and their dimensions."""
    return {f.name: f.metadata[VECTOR_DIM] for f in schema.fields if VECTOR_DIM in (f.metadata or {})}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def check_supported(schema: T.StructType) -> None:
    """Reject column types the table format does not take."""
    if not schema.fields:
        raise SchemaMismatch("a table needs at least one column")

    def walk(dtype: T.DataType, path: str) -> None:
        if isinstance(dtype, T.ArrayType):
            walk(dtype.elementType, path + "[]")
        elif isinstance(dtype, T.StructType):
            for child in dtype.fields:
                walk(child.dataType, f"{path}.{child.name}")
        elif isinstance(dtype, T.DecimalType) and dtype == T.DecimalType(20, 0):
            return  # how Spark reads an unsigned 64-bit column
        elif isinstance(dtype, (T.MapType, T.DecimalType, T.TimestampType, T.DayTimeIntervalType,
                                T.YearMonthIntervalType, T.CalendarIntervalType, T.VariantType)):
            raise SchemaMismatch(f"column {path} has the unsupported type {dtype.simpleString()}")

    for field in schema.fields:
        walk(field.dataType, field.name)


def vector_aggregates(columns: Sequence[str]) -> list[Column]:
    """Aggregates that say whether columns hold finite vectors of one length.

    All of them stay right if a row is counted twice, so they can also be
    observed while the rows are written.
    """
    out = []
    for i, name in enumerate(columns):
        value = F.col(_quoted(name))
        finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        out += [F.count(value).alias(f"n{i}"), F.min(F.size(value)).alias(f"lo{i}"),
                F.max(F.size(value)).alias(f"hi{i}"), F.min(finite).alias(f"ok{i}")]
    return out


def unchecked_vectors(schema: T.StructType) -> list[str]:
    """Columns whose vectors need a look: declared ones and other float arrays."""
    return [f.name for f in schema.fields if is_vector_type(f.dataType)]


def declare_vectors(df: DataFrame, columns: Sequence[str] | None = None, facts: dict | None = None) -> DataFrame:
    """Attach the dimension to vector columns after checking every row.

    ``facts`` are the ``vector_aggregates`` of ``unchecked_vectors(df.schema)``
    if they were observed already; otherwise one aggregate computes them.

    ``columns=None`` looks at all float arrays and declares those whose
    non-null values share one positive length; other arrays stay lists.  Named
    columns must qualify.
    """
    schema = df.schema
    explicit = columns is not None
    names = list(columns) if explicit else [
        f.name for f in schema.fields if is_vector_type(f.dataType) and VECTOR_DIM not in (f.metadata or {})]
    declared = vector_dims(schema)
    for name in names:
        if name not in schema.names:
            raise SchemaMismatch(f"vector column does not exist: {name}")
        if not is_vector_type(schema[name].dataType):
            raise SchemaMismatch(f"vector column {name} must be an array of floats")
    measured = list(dict.fromkeys([*names, *declared]))
    if not measured:
        return df
    if facts is None:
        looked = measured
        facts = df.agg(*vector_aggregates(looked)).first().asDict()
    else:
        looked = unchecked_vectors(schema)
    found = {name: {"rows": facts.get(f"n{i}"), "min": facts.get(f"lo{i}"), "max": facts.get(f"hi{i}"),
                    "finite": facts.get(f"ok{i}")} for i, name in enumerate(looked)}
    for name in measured:
        stats = found[name]
        if name in declared:
            if stats["rows"] and not (stats["min"] == stats["max"] == declared[name] and stats["finite"]):
                raise SchemaMismatch(f"column {name} needs finite vectors of dimension {declared[name]}")
            continue
        same = stats["rows"] and stats["min"] == stats["max"] and stats["min"] > 0 and stats["finite"]
        if same:
            df = df.withMetadata(name, {**(schema[name].metadata or {}), VECTOR_DIM: stats["min"]})
        elif explicit:
            if not stats["rows"]:
                raise SchemaMismatch(f"cannot infer the dimension of vector column {name}")
            raise SchemaMismatch(f"column {name} needs finite vectors of one positive dimension")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the column order and types of ``schema``; only exact widenings are cast."""
    if set(df.columns) != set(schema.names) or len(df.columns) != len(schema.names):
        missing = sorted(set(schema.names) - set(df.columns))
        extra = sorted(set(df.columns) - set(schema.names))
        raise SchemaMismatch(f"columns differ from the table: missing {missing}, unknown {extra}")
    columns = []
    for field in schema.fields:
        have = df.schema[field.name].dataType
        if not _fits(have, field.dataType):
            raise SchemaMismatch(f"column {field.name} is {have.simpleString()}, "
                                 f"the table has {field.dataType.simpleString()}")
        value = F.col(_quoted(field.name))
        if have != field.dataType:
            value = value.cast(field.dataType)
        columns.append(value.alias(field.name, metadata=field.metadata or {}))
    return df.select(*columns)


# Widening order of the numeric types.
_WIDTH = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def _fits(have: T.DataType, want: T.DataType) -> bool:
    if have == want or isinstance(have, T.NullType):
        return True
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        inner, outer = have.elementType, want.elementType
        # literals arrive as double arrays; a float vector column takes them
        return _fits(inner, outer) or (is_numeric(inner) and isinstance(outer, (T.FloatType, T.DoubleType)))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return have.names == want.names and all(
            _fits(a.dataType, b.dataType) for a, b in zip(have.fields, want.fields))
    if is_integral(have) and is_integral(want):
        # range is still checked: an ANSI cast raises on overflow
        return True
    if isinstance(have, T.FloatType) and isinstance(want, T.DoubleType):
        return True
    if isinstance(have, T.DoubleType) and isinstance(want, T.FloatType):
        return True
    if is_integral(have) and isinstance(want, (T.FloatType, T.DoubleType)):
        return _WIDTH[have.simpleString()] <= (3 if isinstance(want, T.DoubleType) else 2)
    return False


def describe_schema(schema: T.StructType) -> list[tuple[str, str, bool, int | None]]:
    """Flattened schema tree: (path, type, nullable, vector dimension)."""
    rows: list[tuple[str, str, bool, int | None]] = []

    def walk(name: str, dtype: T.DataType, nullable: bool, dim: int | None) -> None:
        rows.append((name, dtype.simpleString(), nullable, dim))
        if isinstance(dtype, T.StructType):
            for child in dtype.fields:
                walk(f"{name}.{child.name}", child.dataType, child.nullable, None)
        elif isinstance(dtype, T.ArrayType):
            walk(f"{name}.element", dtype.elementType, dtype.containsNull, None)

    for field in schema.fields:
        walk(field.name, field.dataType, field.nullable, (field.metadata or {}).get(VECTOR_DIM))
    return rows
