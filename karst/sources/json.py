"""JSON import with strict column typing.

Plain inference is not strict enough: it rounds large integers next to
fractions and turns mixed columns into strings.  Documents are parsed into
variants instead, one pass counts the kinds of values per column, and only
then are columns cast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from karst.functions.json_paths import json_path
from karst.schema import SchemaMismatch, declare_vectors, is_integral
from karst.session import materialise
from karst.sources.json_cut import column_rows, records, row_texts

_LINES = (".jsonl", ".ndjson")
# Hint types an imported column can take.
_SCALARS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType)

# Kinds of a JSON value, from the type name its variant reports.  Integers
# beyond 64 bits arrive as decimals of at least 19 digits without a fraction.
_KIND = """
CASE WHEN s = 'BIGINT' THEN 'int'
     WHEN s = 'STRING' THEN 'string'
     WHEN s = 'VOID' THEN 'null'
     WHEN s = 'BOOLEAN' THEN 'bool'
     WHEN s LIKE 'ARRAY%' THEN 'list'
     WHEN s LIKE 'OBJECT%' THEN 'object'
     WHEN s = 'NOT_OBJECT' THEN 'not_object'
     WHEN s RLIKE '^DECIMAL[(](19|2[0-9]|3[0-8]),0[)]$' THEN 'bigint'
     ELSE 'float' END"""


class JsonImportError(ValueError):
    pass


def parse(text: DataFrame) -> DataFrame:
    """One variant ``v`` per document of a text column ``value``."""
    return text.select(F.parse_json("value").alias("v"))


def _explode(df: DataFrame, variant: str, *names: str) -> DataFrame:
    """(key, value) pairs or items of a variant object or array, next to the kept columns."""
    return df.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col(variant).outer()).select(
            F.col("pos").alias(names[0]), F.col("key").alias(names[1]), F.col("value").alias(names[2])))


def row_objects(docs: DataFrame, jsonlines: bool = False) -> DataFrame:
    """One row object per row (column ``r``), from lines or arrays of objects."""
    if jsonlines:
        return docs.select(F.col("v").alias("r"))
    # an empty array has no rows; the outer explode gives it one without a position
    return _explode(docs, "v", "_pos", "_key", "r").filter("_pos IS NOT NULL").select("r")


def _with_items(values: DataFrame) -> DataFrame:
    """(name, item, value, s): every value and the type its variant reports, and for a list its items as well, in one pass."""
    own = F.array(F.struct(F.lit(False).alias("item"), F.col("value"), F.col("s")))
    inside = F.transform(F.try_variant_get("value", "$", "array<variant>"),
                         lambda x: F.struct(F.lit(True).alias("item"), x.alias("value"), F.schema_of_variant(x).alias("s")))
    # most values are no lists
    found = F.when(F.col("s").startswith("ARRAY"), F.concat(own, inside)).otherwise(own)
    return values.select("name", F.explode(found).alias("x")).select("name", "x.item", "x.value", "x.s")


def type_audit(objects: DataFrame) -> DataFrame:
    """Kinds of values per column: one row per (column, list item?, kind).

    ``inexact`` counts integers a double cannot hold, ``fractions`` numbers
    that are not whole.  Counts combine on the map side, so the shuffle carries
    a few rows per task.
    """
    pairs = _explode(objects.select("r"), "r", "_pos", "name", "value")
    # rows that are no objects come out without a name, and so do empty objects
    whole = F.when(F.col("name").isNull(), F.when(F.schema_of_variant("r").startswith("OBJECT"), "VOID")
                   .otherwise("NOT_OBJECT"))
    return _count_kinds(_with_items(pairs.select("name", "value", F.coalesce(whole, F.schema_of_variant("value")).alias("s"))))


def _count_kinds(values: DataFrame) -> DataFrame:
    """Counts per (name, item, kind) of columns (name, item, value, s)."""
    kinds = values.withColumn("kind", F.expr(_KIND))
    # CASE keeps the casts away from values of other kinds, where they would fail slowly
    whole = "variant_get(value, '$', 'bigint')"
    number = "variant_get(value, '$', 'double')"
    return kinds.groupBy("name", "item", "kind").agg(
        F.count("*").alias("n"),
        F.expr(f"count_if(CASE WHEN kind = 'int' THEN CAST({number} AS DECIMAL(38,0)) <> CAST({whole} AS DECIMAL(38,0)) "
               "ELSE false END)").alias("inexact"),
        F.expr(f"count_if(CASE WHEN kind = 'float' THEN {number} <> floor({number}) ELSE false END)").alias("fractions"))


def _scalar_type(name: str, kinds: Mapping[str, Mapping], hint: T.DataType | None) -> T.DataType:
    present = {k for k, c in kinds.items() if k != "null" and c["n"]}
    if present & {"object", "list"}:
        raise JsonImportError(f"column {name} contains nested objects or arrays; flatten them first")
    if hint is not None:
        if not isinstance(hint, _SCALARS):
            raise JsonImportError(f"unsupported type {hint.simpleString()} for column {name}")
        allowed = ({"string"} if isinstance(hint, T.StringType) else {"bool"} if isinstance(hint, T.BooleanType)
                   else {"int", "float"})
        if not present <= allowed or (is_integral(hint) and kinds.get("float", {}).get("fractions")):
            raise JsonImportError(f"cannot convert column {name} to {hint.simpleString()}")
        return hint
    if "bigint" in present:
        raise JsonImportError(f"column {name} has integers beyond 64 bits")
    if not present:
        return T.NullType()
    if present == {"string"}:
        return T.StringType()
    if present == {"bool"}:
        return T.BooleanType()
    if present == {"int"}:
        return T.LongType()
    if present <= {"int", "float"}:
        if kinds.get("int", {}).get("inexact"):
            raise JsonImportError(f"promoting column {name} to double would lose integer precision; give its type")
        return T.DoubleType()
    raise JsonImportError(f"column {name} mixes incompatible types: {', '.join(sorted(present))}")


def _as_type(hint) -> T.DataType:
    if isinstance(hint, T.DataType):
        return hint
    if not isinstance(hint, str):
        raise JsonImportError("types must map column names to Spark types")
    try:
        return T.DataType.fromDDL(hint)
    except Exception as error:
        raise JsonImportError(f"unknown type {hint!r}") from error


def read_json(spark: SparkSession, path: str | list[str], jsonlines: bool | None = None,
              types: Mapping[str, str | T.DataType] | None = None,
              vector_columns: Sequence[str] = (), check_vectors: bool = True) -> DataFrame:
    """Rows of JSON files: arrays of row objects, objects of column arrays, or JSON Lines.

    Absent and null fields are null.  Integers stay 64-bit, numbers promote to
    double if no integer loses precision, mixed kinds and nested objects raise.
    Arrays become lists; ``vector_columns`` must hold finite vectors of one
    length, as floats unless ``types`` asks for ``array<double>``.  A caller that
    checks vectors while writing them passes ``check_vectors=False``.
    """
    checked = vector_columns if check_vectors else ()
    first = path if isinstance(path, str) else path[0]
    lines = first.rstrip("/").endswith(_LINES) if jsonlines is None else jsonlines
    named: list[str] = []
    if lines:
        text = spark.read.text(path).filter(F.trim("value") != "")
    else:
        opening, found = records(spark, path, JsonImportError)
        if opening == "[":
            text = row_texts(spark, found, JsonImportError)
        else:
            text, named = column_rows(spark, found, JsonImportError)
            text = materialise(text, "json-rows")
    return _check_vectors(typed_rows(row_objects(parse(text), True), types, vector_columns, named), checked)


def typed_rows(objects: DataFrame, types=None, vector_columns: Sequence[str] = (), named: Sequence[str] = ()) -> DataFrame:
    """Audit row objects (column ``r``) and cast them to one schema; ``named`` columns exist also if no row has them."""
    audit = type_audit(objects)
    if named:
        empty = objects.sparkSession.createDataFrame([(n, False, "null", 1, 0, 0) for n in named], audit.schema)
        audit = audit.unionByName(empty)
    schema = _plan(audit, types, vector_columns)
    columns = [_cast(F.col("r"), name, dtype).alias(name) for name, dtype in schema.items()]
    return objects.select(*columns)


def _plan(audit: DataFrame, types, vector_columns: Sequence[str]) -> dict[str, T.DataType]:
    """Column types from the audit, which has a few rows per column."""
    hints = {name: _as_type(h) for name, h in (types or {}).items()}
    found: dict[str, dict[bool, dict[str, dict]]] = {}
    for row in audit.collect():
        kinds = found.setdefault(row["name"], {False: {}, True: {}})[row["item"]]
        if row["kind"] not in kinds or row["n"] > kinds[row["kind"]]["n"]:
            kinds[row["kind"]] = row.asDict()
    nameless = found.pop(None, None)
    if nameless and "not_object" in nameless[False]:
        raise JsonImportError("every row needs to be an object with named fields")
    if not found:
        if not hints:
            raise JsonImportError("nothing to infer columns from: pass types")
        found = {name: {False: {}, True: {}} for name in hints}
    unknown = [n for n in hints if n not in found]
    if unknown:
        raise JsonImportError(f"no such column for the types given: {', '.join(unknown)}")
    unknown = [n for n in vector_columns if n not in found]
    if unknown:
        raise JsonImportError(f"no such vector column: {', '.join(unknown)}")
    schema: dict[str, T.DataType] = {}
    for name in sorted(found):
        own, items = found[name][False], found[name][True]
        hint, vector = hints.get(name), name in vector_columns
        present = {k for k in own if k != "null"}
        if not (vector or isinstance(hint, T.ArrayType) or "list" in present):
            schema[name] = _scalar_type(name, own, hint)
            continue
        if not present <= {"list"}:
            raise JsonImportError(f"{name} has lists in some rows and single values in others")
        if hint is not None and not isinstance(hint, T.ArrayType):
            raise JsonImportError(f"{name} holds lists, so its type has to be an array")
        element = hint.elementType if hint is not None else T.FloatType() if vector else None
        if vector and (not {k for k in items} <= {"int", "float"} or not items):
            raise JsonImportError(f"{name} holds something other than numbers, so it is no vector column")
        if not {k for k in items if k != "null"} and element is None:
            raise JsonImportError(f"the lists of {name} are all empty: pass its type")
        schema[name] = T.ArrayType(_scalar_type(f"{name}[]", items, element))
    return schema


def _cast(row: Column, name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.NullType):
        return F.lit(None)
    target = dtype.simpleString()
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.FloatType):
        # out-of-range values become infinite here and fail the vector check
        return F.variant_get(row, json_path(name), "array<double>").cast("array<float>")
    if isinstance(dtype, T.FloatType):
        return F.variant_get(row, json_path(name), "double").cast("float")
    return F.variant_get(row, json_path(name), target)


def _check_vectors(df: DataFrame, vector_columns: Sequence[str]) -> DataFrame:
    if not vector_columns:
        return df
    try:
        return declare_vectors(df, list(vector_columns))
    except SchemaMismatch as error:
        raise JsonImportError(str(error)) from error


def audit_report(objects: DataFrame) -> DataFrame:
    """Per column: values of each kind and integers that a double would round."""
    kinds = type_audit(objects).filter("NOT item AND name IS NOT NULL")
    count = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"n_{k}")
             for k in ("null", "bool", "int", "float", "string", "list", "object")}
    return kinds.groupBy("name").agg(*count.values(), F.sum("inexact").alias("inexact_ints"))

