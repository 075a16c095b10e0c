"""Imports that create a table or append to one.

Rows are written first and committed last, so an import that fails leaves
nothing behind.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from karst.plans.store import Database, Table
from karst.schema import SchemaMismatch
from karst.sources.csv import read_csv
from karst.sources.json import JsonImportError, read_json
from karst.sources.sqlite import read_sqlite


def _store(target, name: str | None, frame, vector_columns=None) -> Table:
    if isinstance(target, Database):
        if name is None:
            raise ValueError("name the table to create")
        return target.create_table(name, frame, vector_columns=vector_columns)
    return target.add(frame)


def import_csv(target: Database | Table, source, name: str | None = None, **options) -> Table:
    """``import_csv(db, path, name)`` creates a table, ``import_csv(table, path)`` appends.

    An append reads with the table's own types, so nothing is inferred.
    """
    if isinstance(target, Table) and options.get("types") is None:
        options["types"] = target.schema
    return _store(target, name, read_csv(target.spark, source, **options))


def import_json(target: Database | Table, source, name: str | None = None, jsonlines: bool | None = None,
                types=None, vector_columns=()) -> Table:
    frame = read_json(target.spark, source, jsonlines, types, vector_columns, check_vectors=False)
    if isinstance(target, Table):
        # absent fields are null; columns the input does not mention exist in the table
        for field in target.schema.fields:
            if field.name not in frame.columns:
                frame = frame.withColumn(field.name, F.lit(None).cast(field.dataType))
    try:
        return _store(target, name, frame, list(vector_columns))
    except SchemaMismatch as error:
        raise JsonImportError(str(error)) from error


def import_sqlite(target: Database | Table, path: str, name: str | None = None, source_table: str | None = None,
                  sql: str | None = None, params=()) -> Table:
    return _store(target, name, read_sqlite(target.spark, path, source_table, sql, params))
