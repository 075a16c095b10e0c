"""SQLite databases as a partitioned Spark source.

Reads one database file or a directory of them, on a file system that every
executor has mounted.  Whole tables are split by row id, so many tasks read
one file; a query is one task per file.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from karst.session import posix_path

ROWS_PER_PARTITION = 500_000
FETCH = 8192

# SQLite storage classes and the column types they import as.
_STORAGE = {"integer": T.LongType(), "real": T.DoubleType(), "text": T.StringType(), "blob": T.BinaryType()}


def database_files(path: str) -> list[str]:
    root = posix_path(path)
    if os.path.isdir(root):
        return sorted(p for p in glob.glob(os.path.join(root, "*")) if p.endswith((".sqlite", ".db", ".sqlite3")))
    found = sorted(glob.glob(root))
    if not found:
        raise FileNotFoundError(f"no database at {path}")
    return found


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _statement(source_table: str | None, sql: str | None) -> str:
    return f"SELECT * FROM {_identifier(source_table)}" if source_table is not None else sql


def _declared(name: str | None) -> T.DataType:
    """Type for a column without values, from SQLite's affinity rules."""
    text = (name or "").upper()
    if "INT" in text:
        return T.LongType()
    if any(w in text for w in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    if any(w in text for w in ("REAL", "FLOA", "DOUB")):
        return T.DoubleType()
    if "BLOB" in text:
        return T.BinaryType()
    return T.StringType()


def storage_classes(path: str, source_table: str | None, sql: str | None,
                    params: Sequence) -> list[tuple[int, str, str | None, str | None]]:
    """(position, column, storage class or None, declared type) found in one file.

    SQLite scans the rows; Python sees one summary row.
    """
    connection = _connect(path)
    try:
        cursor = connection.execute(f"SELECT * FROM ({_statement(source_table, sql)}) LIMIT 0", params)
        names = [d[0] for d in cursor.description]
        declared = {}
        if source_table is not None:
            declared = {r[1]: r[2] for r in connection.execute(f"PRAGMA table_info({_identifier(source_table)})")}
        kinds = ", ".join(f"group_concat(DISTINCT typeof({_identifier(n)}))" for n in names)
        row = connection.execute(f"SELECT {kinds} FROM ({_statement(source_table, sql)})", params).fetchone()
    finally:
        connection.close()
    out = []
    for position, (name, value) in enumerate(zip(names, row)):
        seen = set((value or "").split(",")) - {"", "null"}
        out += [(position, name, kind, declared.get(name)) for kind in sorted(seen) or [None]]
    return out


def schema_of(found: Sequence[tuple[int, str, str | None, str | None]]) -> T.StructType:
    """One schema from the storage classes of all files."""
    columns: dict[int, dict] = {}
    for position, name, kind, declared in found:
        entry = columns.setdefault(position, {"names": set(), "kinds": set(), "declared": declared})
        entry["names"].add(name)
        if kind is not None:
            entry["kinds"].add(kind)
    fields = []
    for position in sorted(columns):
        entry = columns[position]
        if len(entry["names"]) > 1:
            raise ValueError("the database files have different columns")
        name, kinds = next(iter(entry["names"])), entry["kinds"]
        if kinds == {"integer", "real"}:
            dtype: T.DataType = T.DoubleType()
        elif len(kinds) > 1:
            raise ValueError(f"column {name} mixes storage types {sorted(kinds)}; CAST it in a query")
        else:
            dtype = _STORAGE[next(iter(kinds))] if kinds else _declared(entry["declared"])
        fields.append(T.StructField(name, dtype))
    if len({f.name for f in fields}) != len(fields):
        raise ValueError("columns need unique names; add aliases")
    return T.StructType(fields)


def infer_schema(spark: SparkSession, paths: Sequence[str], source_table: str | None, sql: str | None,
                 params: Sequence) -> T.StructType:
    """Column types from the data; with many files each is summarised by a task."""
    if len(paths) == 1:
        return schema_of(storage_classes(paths[0], source_table, sql, params))

    def look(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rows = [r for path in frame.column("path").to_pylist() for r in storage_classes(path, source_table, sql, params)]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.string()) for c in columns[1:]]],
                ["position", "name", "kind", "declared"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 1000))
    found = listed.mapInArrow(look, "position int, name string, kind string, declared string").distinct()
    return schema_of([tuple(r) for r in found.collect()])


class _Slice(InputPartition):
    def __init__(self, path: str, low: int | None, high: int | None):
        self.path, self.low, self.high = path, low, high


class SqliteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.paths = database_files(options["path"])
        self.table = options.get("source_table")
        self.sql = options.get("sql")
        self.params = _decode(options.get("params", "[]"))
        self.rows = int(options.get("rows_per_partition", ROWS_PER_PARTITION))

    def partitions(self) -> list[_Slice]:
        out = []
        for path in self.paths:
            bounds = self._bounds(path) if self.table is not None else None
            if bounds is None:
                out.append(_Slice(path, None, None))
                continue
            low, high, count = bounds
            if count:
                step = max(1, (high - low + 1) * self.rows // max(count, 1))
                out += [_Slice(path, start, min(start + step - 1, high)) for start in range(low, high + 1, step)]
        return out

    def _bounds(self, path: str):
        connection = _connect(path)
        try:
            return connection.execute(
                f"SELECT min(rowid), max(rowid), count(*) FROM {_identifier(self.table)}").fetchone()
        except sqlite3.OperationalError:
            return None      # views and WITHOUT ROWID tables have no row id
        finally:
            connection.close()

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        statement, params = _statement(self.table, self.sql), self.params
        if partition.low is not None:
            statement += " WHERE rowid BETWEEN ? AND ?"
            params = [partition.low, partition.high]
        target = to_arrow_schema(self.schema)
        connection = _connect(partition.path)
        try:
            cursor = connection.execute(statement, params)
            while rows := cursor.fetchmany(FETCH):
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([float(x) if x is not None else None for x in c] if pa.types.is_floating(f.type) else c, f.type)
                     for c, f in zip(columns, target)], schema=target)
        finally:
            connection.close()


def _encode(params: Sequence) -> str:
    import base64
    import json
    return json.dumps([{"b": base64.b64encode(p).decode()} if isinstance(p, (bytes, bytearray)) else {"v": p} for p in params])


def _decode(text: str) -> list:
    import base64
    import json
    return [base64.b64decode(p["b"]) if "b" in p else p["v"] for p in json.loads(text)] if text != "[]" else []


class SqliteSource(DataSource):
    """``spark.read.format("sqlite")`` with ``source_table`` or ``sql`` and ``params``."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        # used without ``read_sqlite``, which summarises the files in tasks
        return schema_of([row for path in database_files(self.options["path"]) for row in storage_classes(
            path, self.options.get("source_table"), self.options.get("sql"), _decode(self.options.get("params", "[]")))])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SqliteReader(schema, dict(self.options))


def read_sqlite(spark: SparkSession, path: str, source_table: str | None = None, sql: str | None = None,
                params: Sequence = (), rows_per_partition: int = ROWS_PER_PARTITION,
                schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of a table, or of a query with bound parameters.  BLOB columns are binary, NULL is null.

    Column types come from the data unless ``schema`` gives them.
    """
    if (source_table is None) == (sql is None):
        raise ValueError("pass a source_table or a sql text, not both or neither")
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").option("params", _encode(params)).option("rows_per_partition", rows_per_partition)
    reader = reader.option("source_table", source_table) if source_table is not None else reader.option("sql", sql)
    if schema is None:
        schema = infer_schema(spark, database_files(path), source_table, sql, list(params))
    return reader.schema(schema).load(path)


def write_sqlite(df: DataFrame, path: str, table: str) -> int:
    """Write one database file per partition; a repeated task replaces its own file."""
    root = posix_path(path)
    names = df.columns
    kinds = {"LongType": "INTEGER", "IntegerType": "INTEGER", "ShortType": "INTEGER", "ByteType": "INTEGER",
             "DoubleType": "REAL", "FloatType": "REAL", "StringType": "TEXT", "BinaryType": "BLOB"}
    columns = ", ".join(f"{_identifier(f.name)} {kinds[type(f.dataType).__name__]}" for f in df.schema.fields)
    marks = ", ".join("?" for _ in names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        context = TaskContext.get()
        os.makedirs(root, exist_ok=True)
        final = os.path.join(root, f"part-{context.partitionId():05d}.sqlite")
        temporary = f"{final}.{context.taskAttemptId()}.tmp"
        connection = sqlite3.connect(temporary)
        rows = 0
        try:
            connection.execute(f"CREATE TABLE {_identifier(table)} ({columns})")
            for batch in batches:
                rows += batch.num_rows
                connection.executemany(f"INSERT INTO {_identifier(table)} VALUES ({marks})",
                                       zip(*[c.to_pylist() for c in batch.columns]))
            connection.commit()
        finally:
            connection.close()
        os.replace(temporary, final)
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], ["rows"])

    return sum(r[0] for r in df.mapInArrow(write, "rows bigint").collect())
