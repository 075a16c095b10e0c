"""Typed access to JSON text and membership tests on arrays.

Text is parsed once into a variant; getters return null when the value at the
path has another JSON type.  Malformed text gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from karst.functions.expressions import lit


def json_path(*keys: str) -> str:
    """``$["k1"]["k2"]`` for a sequence of object keys."""
    steps = []
    for key in keys:
        if '"' not in key:
            steps.append(f'["{key}"]')
        elif "'" not in key:
            steps.append(f"['{key}']")
        else:
            raise ValueError("a JSON key cannot contain both kinds of quotes")
    return "$" + "".join(steps)


def _flatten(path) -> list[str]:
    if len(path) == 1 and not isinstance(path[0], str):
        path = path[0]
    return [str(p) for p in path]


def _at(expr: Column, path) -> Column:
    return F.try_variant_get(F.try_parse_json(expr), json_path(*_flatten(path)), "variant")


def _typed(expr: Column, path, is_kind, target: str) -> Column:
    """Value at the path if its JSON kind fits.

    Indexing a one-element array keeps both parts unconditional, so the text
    is parsed once per row; a CASE would parse it a second time.
    """
    value = _at(expr, path)
    return F.get(F.array(F.try_variant_get(value, "$", target)),
                 F.when(is_kind(F.schema_of_variant(value)), F.lit(0)))


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def json_get_str(expr: Column, *path) -> Column:
    """String at a key path."""
    return _typed(expr, path, lambda kind: kind == "STRING", "string")


def json_get_int(expr: Column, *path) -> Column:
    """64-bit integer at a key path."""
    return _typed(expr, path, lambda kind: kind == "BIGINT", "bigint")


def json_get_float(expr: Column, *path) -> Column:
    """Double at a key path; integers widen."""
    return _typed(expr, path, _is_number, "double")


def json_get_bool(expr: Column, *path) -> Column:
    """Boolean at a key path."""
    return _typed(expr, path, lambda kind: kind == "BOOLEAN", "boolean")


def json_contains(expr: Column, *path) -> Column:
    """Whether the key path exists; an explicit JSON null counts as present."""
    return _at(expr, path).isNotNull()


def json_array_has(expr: Column, path, value, quote_value: bool = True) -> Column:
    """Whether the JSON array at ``path`` holds ``value``.

    ``quote_value=True`` looks for a JSON string; otherwise ``value`` is a bare
    literal (number or boolean) compared by its JSON text.
    """
    path = [path] if isinstance(path, str) else list(path)
    items = F.try_variant_get(F.try_parse_json(expr), json_path(*path), "array<variant>")
    wanted = lit(value).cast("string")
    if quote_value:
        def hit(x: Column) -> Column:
            return (F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") == wanted)
    else:
        def hit(x: Column) -> Column:
            return (F.schema_of_variant(x) != "STRING") & (F.to_json(x) == wanted)
    return F.exists(items, hit)


def array_has(array: Column, value) -> Column:
    """Membership in an array column."""
    return F.array_contains(array, lit(value))
