"""Named, versioned tables on any storage Spark can reach.

A table is a directory of Parquet segments.  A version is one commit record
that lists its segments, written after the data, so readers never see a
half-written table and a failed write leaves the table as it was.  Changes
write new segments and keep untouched ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from karst.functions.expressions import bind
from karst.operators import mutate
from karst.operators.bounds import fits_broadcast, left_join_unique
from karst.operators.batches import batches, id_manifest, rows_at, sample_rows, transform_batches
from karst.operators.lookup import POS, projection, take_ids
from karst.operators.scan import check_count
from karst.plans import files
from karst.plans.commits import Commit, CommitLog, Segment
from karst.plans.indexes import (SEGMENT, Indexes, IndexStats, create_fts_index, create_scalar_index,
                                 create_vector_index)
from karst.plans.query import ScanQuery, VectorQuery
from karst.schema import (SchemaMismatch, check_supported, conform, declare_vectors, describe_schema,
                          unchecked_vectors, vector_aggregates)
from karst.session import materialise, ship, write_observed

COMPACT_BYTES = 256 << 20
OPTIMIZE = ("all", "compact", "prune", "index")


class TableNotFound(KeyError):
    pass


class TableExists(ValueError):
    pass


class StaleDataset(RuntimeError):
    """The table changed after the dataset was built."""


def as_frame(spark: SparkSession, data) -> DataFrame:
    """A DataFrame from a Spark or pandas DataFrame, an Arrow table, columns or rows."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, pa.Table):
        from karst.sources.arrow_ipc import from_arrow
        return from_arrow(spark, data)
    if isinstance(data, Mapping):
        lengths = {len(v) for v in data.values()}
        if len(lengths) > 1:
            raise ValueError("columns must have equal lengths")
        from karst.sources.arrow_ipc import from_arrow
        return from_arrow(spark, pa.table({k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v)
                                           for k, v in data.items()}))
    if hasattr(data, "columns") and hasattr(data, "iloc"):
        from karst.sources.arrow_ipc import from_arrow
        return from_arrow(spark, pa.Table.from_pandas(data, preserve_index=False))
    rows = list(data)
    if rows and isinstance(rows[0], Mapping):
        from karst.sources.arrow_ipc import from_arrow
        return from_arrow(spark, pa.Table.from_pylist(rows))
    return spark.createDataFrame(rows)


def _check_name(name: str) -> str:
    if not isinstance(name, str) or not name or name.startswith(("_", ".")) or any(c in name for c in "/\\\0:"):
        raise ValueError(f"invalid name {name!r}")
    return name


def connect(spark: SparkSession, uri: str) -> "Database":
    return Database(spark, uri)


class Database:
    """A directory (local or object store) that holds tables and namespaces.

    Credentials and endpoints belong in Spark's Hadoop configuration.
    """

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")
        ship(spark)

    def _path(self, name: str, namespace: str | None = None) -> str:
        return "/".join([self.uri, *([_check_name(namespace)] if namespace else []), _check_name(name)])

    def _is_table(self, path: str) -> bool:
        return bool(CommitLog(self.spark, f"{path}/_commits").versions())

    def create_table(self, name: str, data=None, schema: T.StructType | None = None, *,
                     vector_columns: Sequence[str] | None = None, namespace: str | None = None) -> "Table":
        """Create a table from data (schema inferred) or empty from a schema."""
        path = self._path(name, namespace)
        if self._is_table(path):
            raise TableExists(f"table exists: {name}")
        if data is None and schema is None:
            raise ValueError("give data or a schema")
        table = Table(self.spark, path, name)
        if data is None:
            check_supported(schema)
            table._commit("create", schema, [])
            return table
        frame = as_frame(self.spark, data)
        if schema is not None:
            frame = conform(frame, schema)
        check_supported(frame.schema)
        segment, facts = table._write(frame)
        try:
            written = declare_vectors(table._read([segment.name], frame.schema), vector_columns, facts)
            table._commit("create", written.schema, [segment] if segment.rows else [])
        except Exception:
            table._discard(segment)
            raise
        return table

    def open_table(self, name: str, namespace: str | None = None) -> "Table":
        path = self._path(name, namespace)
        if not self._is_table(path):
            raise TableNotFound(f"table does not exist: {name}")
        return Table(self.spark, path, name)

    def table_names(self, limit: int | None = None, start_after: str | None = None,
                    namespace: str | None = None) -> list[str]:
        root = f"{self.uri}/{_check_name(namespace)}" if namespace else self.uri
        if limit is not None:
            check_count(limit, "limit")
        names = [n for n, is_dir, _ in files.children(self.spark, root)
                 if is_dir and self._is_table(f"{root}/{n}") and (start_after is None or n > start_after)]
        return names if limit is None else names[:limit]

    def drop_table(self, name: str, namespace: str | None = None) -> None:
        files.delete(self.spark, self.open_table(name, namespace).path)

    def drop_all_tables(self, namespace: str | None = None) -> None:
        for name in self.table_names(namespace=namespace):
            self.drop_table(name, namespace)

    def rename_table(self, old: str, new: str, namespace: str | None = None, new_namespace: str | None = None) -> None:
        source = self.open_table(old, namespace).path
        target = self._path(new, new_namespace if new_namespace is not None else namespace)
        if files.exists(self.spark, target):
            raise TableExists(f"table exists: {new}")
        files.rename(self.spark, source, target)

    def create_namespace(self, name: str) -> None:
        path = f"{self.uri}/{_check_name(name)}"
        if files.exists(self.spark, path):
            raise ValueError(f"namespace or table exists: {name}")
        files.make_dirs(self.spark, path)
        files.write_new(self.spark, f"{path}/_namespace", "")

    def drop_namespace(self, name: str) -> None:
        if name not in self.list_namespaces():
            raise KeyError(f"namespace does not exist: {name}")
        if self.table_names(namespace=name):
            raise ValueError(f"namespace is not empty: {name}")
        files.delete(self.spark, f"{self.uri}/{_check_name(name)}")

    def list_namespaces(self) -> list[str]:
        return [n for n, is_dir, _ in files.children(self.spark, self.uri)
                if is_dir and files.exists(self.spark, f"{self.uri}/{n}/_namespace")]

    def sink(self, name: str):
        """``frame.transform(db.sink("t"))``-style writer: creates the table or appends to it."""
        def write(frame: DataFrame) -> DataFrame:
            try:
                self.open_table(name).add(frame)
            except TableNotFound:
                self.create_table(name, frame)
            return frame
        return write


class Table:
    """A stored table.  Reads are lazy DataFrames pinned to the version they were made from."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.log = CommitLog(spark, f"{path}/_commits")
        self.indexes = Indexes(self)

    # ------------------------------------------------------------------ reads

    def commit(self) -> Commit:
        latest = self.log.latest()
        if latest is None:
            raise TableNotFound(f"table does not exist: {self.name}")
        return latest

    @property
    def schema(self) -> T.StructType:
        return _schema_of(self.commit())

    @property
    def version(self) -> int:
        return self.commit().version

    def _read(self, segments: Sequence[str], schema: T.StructType) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        frame = self.spark.read.schema(schema).parquet(*[f"{self.path}/{s}" for s in segments])
        # the reader drops field metadata; put the vector dimensions back
        for item in schema.fields:
            if item.metadata:
                frame = frame.withMetadata(item.name, item.metadata)
        return frame

    def to_df(self, commit: Commit | None = None) -> DataFrame:
        commit = commit or self.commit()
        return self._read([s.name for s in commit.segments], _schema_of(commit))

    def segments_frame(self, segments: Sequence[str], with_segment: bool = False) -> DataFrame:
        """Rows of some segments, optionally with the name of the segment they are in."""
        frame = self._read(segments, self.schema)
        if with_segment:
            if not segments:
                return frame.withColumn(SEGMENT, F.lit(None).cast("string"))
            frame = frame.withColumn(SEGMENT, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        return frame

    def count_rows(self) -> int:
        return sum(s.rows for s in self.commit().segments)

    def describe(self) -> DataFrame:
        """Schema tree as rows (path, type, nullable, vector_dim)."""
        return self.spark.createDataFrame(describe_schema(self.schema),
                                          "path string, type string, nullable boolean, vector_dim int")

    def query(self) -> ScanQuery:
        return ScanQuery(self)

    def vector_search(self, vector, column: str | None = None) -> VectorQuery:
        return VectorQuery(self, vector, column)

    def nearest_to(self, vector, k: int, column: str | None = None) -> DataFrame:
        """One-shot search with default settings."""
        return self.vector_search(vector, column).limit(k).execute()

    def embedding_search(self, value, encoder, column: str = "embedding") -> VectorQuery:
        from karst.operators.embed import encode_batch
        return VectorQuery(self, encode_batch(encoder, [value])[0], column)

    def take_ids(self, ids, id_column: str = "id", columns: Sequence[str] | None = None,
                 on_missing: str = "error") -> DataFrame:
        """Rows in request order; a range index on the id column narrows what is read."""
        name = f"{id_column}_idx"
        indexed = name in self.list_indices() and self.indexes.read(name).kind == "btree"
        return take_ids(self.indexes.scan(name) if indexed else self.to_df(), ids, id_column, columns, on_missing)

    def dataset(self, id_column: str = "id", ids=None, columns: Sequence[str] | None = None) -> "IdDataset":
        return IdDataset(self, id_column, ids, columns)

    # ----------------------------------------------------------------- writes

    def _write(self, frame: DataFrame) -> tuple[Segment, dict]:
        """Write rows as a new segment; vector facts are observed on the way."""
        name = f"seg-{uuid.uuid4().hex}"
        path = f"{self.path}/{name}"
        facts = write_observed(frame, path, vector_aggregates(unchecked_vectors(frame.schema)))
        parts = [n for n, is_dir, _ in files.children(self.spark, path) if not is_dir and n.endswith(".parquet")]
        rows = self.spark.read.schema(frame.schema).parquet(path).count() if parts else 0
        return Segment(name, rows, len(parts)), facts

    def _discard(self, segment: Segment) -> None:
        files.delete(self.spark, f"{self.path}/{segment.name}")

    def _commit(self, operation: str, schema: T.StructType, segments: list[Segment], *,
                metadata: dict | None = None, tokens: dict | None = None, **summary) -> Commit:
        last = self.log.latest()
        return self.log.append(Commit(
            version=1 if last is None else last.version + 1, operation=operation, schema=schema.json(),
            segments=[s for s in segments if s.rows],
            table_metadata=dict(metadata if metadata is not None else last.table_metadata if last else {}),
            tokens=dict(tokens if tokens is not None else last.tokens if last else {}),
            summary={"rows": str(sum(s.rows for s in segments)), "segments": str(len(segments)),
                     **{k: str(v) for k, v in summary.items()}}))

    def add(self, data, token: tuple[str, int] | None = None) -> "Table":
        """Append rows as one commit.  The data is written, checked, then committed.

        ``token = (writer, number)`` makes the append idempotent: a number that
        the writer has already committed is skipped.
        """
        last = self.commit()
        if token is not None and last.tokens.get(token[0], -1) >= token[1]:
            return self
        schema = _schema_of(last)
        frame = conform(as_frame(self.spark, data), schema)
        segment, facts = self._write(frame)
        try:
            self._check_vectors(segment, schema, facts)
            tokens = {**last.tokens, token[0]: token[1]} if token is not None else None
            self._commit("append", schema, [*last.segments, segment], tokens=tokens, added=segment.rows)
        except Exception:
            self._discard(segment)
            raise
        return self

    def _check_vectors(self, segment: Segment, schema: T.StructType, facts: dict) -> None:
        if segment.rows:
            declare_vectors(self._read([segment.name], schema), [], facts)

    def append_partitions(self, frames: Iterable) -> "Table":
        """Append several inputs, one commit each; earlier ones stay if a later one fails."""
        for frame in frames:
            self.add(frame)
        return self

    def _rewrite(self, operation: str, last: Commit, touched: set[str], frame: DataFrame | None, **summary) -> None:
        """Replace the touched segments by ``frame`` and keep the others."""
        kept = [s for s in last.segments if s.name not in touched]
        schema = _schema_of(last)
        fresh, facts = [], {}
        if frame is not None:
            segment, facts = self._write(frame.select(*[f"`{n}`" for n in schema.names]))
            fresh = [segment]
        try:
            for segment in fresh:
                self._check_vectors(segment, schema, facts)
            self._commit(operation, schema, kept + fresh, **summary)
        except Exception:
            for segment in fresh:
                self._discard(segment)
            raise

    def delete_rows(self, predicate: str | Column) -> int:
        """Delete matching rows; only segments that hold such rows are rewritten."""
        last = self.commit()
        rows = self.segments_frame([s.name for s in last.segments], with_segment=True)
        hit = F.coalesce(bind(mutate.as_predicate(predicate), rows), F.lit(False))
        counts = {r[SEGMENT]: r["n"] for r in
                  rows.filter(hit).groupBy(SEGMENT).agg(F.count("*").alias("n")).collect()}
        whole = {s.name for s in last.segments if counts.get(s.name) == s.rows}
        partial = [name for name in counts if name not in whole]
        remaining = mutate.delete_rows(self._read(partial, _schema_of(last)), predicate) if partial else None
        self._rewrite("delete", last, set(counts), remaining, deleted=sum(counts.values()))
        return sum(counts.values())

    def merge_insert(self, data, on: str | Sequence[str], *, update: bool = True, insert: bool = True,
                     condition: str | Column | None = None) -> "Table":
        """Upsert; only segments with a matching key are rewritten."""
        last = self.commit()
        schema = _schema_of(last)
        keys = [on] if isinstance(on, str) else list(on)
        if not keys:
            raise ValueError("merge keys cannot be empty")
        for key in keys:
            if key not in schema.names:
                raise SchemaMismatch(f"merge key does not exist: {key}")
        # the source is used several times below, so it is computed once
        source = materialise(conform(as_frame(self.spark, data), schema), "merge")
        mutate.check_unique(source, keys, "merge source")
        small = fits_broadcast(source)
        columns = [F.col(f"`{k}`") for k in keys]
        rows = self.segments_frame([s.name for s in last.segments], with_segment=True)
        touched = [] if not update or not last.segments else [
            r[0] for r in left_join_unique(rows.select(*columns, SEGMENT, F.col("_metadata.row_index").alias("_row")),
                                           source.select(*columns).dropna(), keys, F.col("_row"), "left_semi", small=small, bounded=True)
            .select(SEGMENT).distinct().collect()]
        changed = mutate.merge_insert(self._read(touched, schema), source, keys, insert=False, condition=condition,
                                      check_source=False, small=small) if touched else None
        if insert:
            # after the match above, keys can only be stored in the touched segments
            base = self._read(touched if update else [s.name for s in last.segments], schema)
            fresh = mutate.unmatched(base, source, keys, small)
            changed = fresh if changed is None else changed.unionByName(fresh)
        if changed is None:
            self._commit("merge", schema, list(last.segments))
        else:
            self._rewrite("merge", last, set(touched), changed)
        return self

    # --------------------------------------------------- metadata and history

    def get_metadata(self, keys: Sequence[str] | None = None) -> dict[str, str]:
        stored = self.commit().table_metadata
        return dict(stored) if keys is None else {k: stored[k] for k in keys if k in stored}

    def set_metadata(self, pairs: Mapping[str, str]) -> "Table":
        if any(not isinstance(x, str) or "\0" in x for pair in pairs.items() for x in pair):
            raise ValueError("metadata keys and values must be strings without NUL")
        if pairs:
            last = self.commit()
            self._commit("set_metadata", _schema_of(last), list(last.segments),
                         metadata={**last.table_metadata, **pairs})
        return self

    def delete_metadata(self, keys: Sequence[str]) -> "Table":
        if keys:
            last = self.commit()
            self._commit("delete_metadata", _schema_of(last), list(last.segments),
                         metadata={k: v for k, v in last.table_metadata.items() if k not in set(keys)})
        return self

    def list_versions(self) -> DataFrame:
        """History, oldest first, with the exact time in seconds and nanoseconds."""
        records = (self.spark.read.option("pathGlobFilter", "*.json").option("multiLine", True)
                   .schema("version bigint, operation string, timestamp_ns bigint, summary map<string,string>")
                   .json(self.log.path))
        frame = records.select(
            "version", "operation", F.expr("timestamp_ns div 1000000000").alias("timestamp_seconds"),
            (F.col("timestamp_ns") % 1_000_000_000).cast("int").alias("timestamp_nanos"), F.col("summary").alias("metadata"))
        millis = F.col("timestamp_seconds") * 1000 + F.expr("timestamp_nanos div 1000000")
        stamp = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
            secs=(millis / F.lit(1000)).cast("decimal(18,6)"))
        return (frame.withColumn("timestamp", stamp)
                .select("version", "timestamp", "timestamp_seconds", "timestamp_nanos", "operation", "metadata")
                .orderBy("version"))

    # ---------------------------------------------------------------- indexes

    def create_vector_index(self, column: str | None = None, type: str = "auto", **options) -> str | None:
        return create_vector_index(self, column, type, **options)

    def create_scalar_index(self, columns, type: str = "btree", **options) -> str:
        return create_scalar_index(self, columns, type, **options)

    def create_fts_index(self, columns, **options) -> str:
        return create_fts_index(self, columns, **options)

    def list_indices(self) -> list[str]:
        return self.indexes.names()

    def drop_index(self, name: str) -> None:
        self.indexes.drop(name)

    def index_stats(self, name: str) -> IndexStats:
        return self.indexes.stats(name)

    # ------------------------------------------------------------ maintenance

    def optimize(self, type: str = "all", keep_versions: int = 1) -> "Table":
        """``compact`` merges small files, ``index`` extends the indexes, ``prune``
        deletes data only old versions use, ``all`` does the three in that order."""
        if type not in OPTIMIZE:
            raise ValueError(f"optimize type must be one of {', '.join(OPTIMIZE)}")
        if type in ("all", "compact"):
            self._compact()
        if type in ("all", "index"):
            for name in self.list_indices():
                self.indexes.extend(name)
        if type in ("all", "prune"):
            self._prune(keep_versions)
        return self

    def _compact(self) -> None:
        """Rewrite all small segments as one, without a shuffle; segments that are already big are left alone."""
        last = self.commit()
        sizes = {s.name: files.tree_bytes(self.spark, f"{self.path}/{s.name}") for s in last.segments}
        small = [s for s in last.segments if sizes[s.name] < COMPACT_BYTES or s.files * COMPACT_BYTES > 4 * sizes[s.name]]
        if len(small) == 1 and small[0].files <= max(1, -(-sizes[small[0].name] // COMPACT_BYTES)):
            return
        if not small:
            return
        target = max(1, -(-sum(sizes[s.name] for s in small) // COMPACT_BYTES))
        frame = self._read([s.name for s in small], _schema_of(last)).coalesce(target)
        self._rewrite("compact", last, {s.name for s in small}, frame)

    def _prune(self, keep_versions: int) -> None:
        check_count(keep_versions, "keep_versions", 1)
        versions = self.log.versions()
        keep = versions[-keep_versions:]
        used = {s.name for v in keep for s in self.log.read(v).segments}
        for version in versions[:-keep_versions]:
            self.log.forget(version)
        for name, is_dir, _ in files.children(self.spark, self.path):
            if is_dir and name.startswith("seg-") and name not in used:
                files.delete(self.spark, f"{self.path}/{name}")


def _schema_of(commit: Commit) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit.schema))


class IdDataset:
    """Ordered access to the rows of one table version by application id.

    The manifest (position, id) is a written DataFrame; nothing else is read
    until rows are asked for.  After a write to the table every access raises.
    """

    def __init__(self, table: Table, id_column: str = "id", ids=None, columns: Sequence[str] | None = None):
        self.table, self.id_column = table, id_column
        commit = table.commit()
        self.version = commit.version
        self.frame = table.to_df(commit)
        self.columns = projection(self.frame.schema, id_column, columns)
        self.given = ids is not None
        self.manifest = id_manifest(self.frame, id_column, ids)
        self.size = self.manifest.count()

    def __len__(self) -> int:
        return self.size

    def _check_version(self) -> None:
        actual = self.table.version
        if actual != self.version:
            raise StaleDataset(f"this dataset shows version {self.version}, the table is at {actual} now")

    def rows(self, positions) -> DataFrame:
        """Rows at 1-based positions (a list, or a DataFrame ``(pos, at)``), in that order."""
        self._check_version()
        return rows_at(self.frame, self.manifest, positions, self.id_column, self.columns, self.size)

    def __getitem__(self, position: int):
        self._check_version()
        return self.rows([position]).drop(POS).first()

    def batches(self, batchsize: int = 32, shuffle: bool = False, seed: int = 0, drop_last: bool = False,
                transform=None, schema=None) -> DataFrame:
        self._check_version()
        out = batches(self.frame, batchsize, self.id_column, self.columns, shuffle, seed, drop_last,
                      manifest=self.manifest if self.given or not shuffle else None)
        if transform is None:
            return out
        if schema is None:
            raise ValueError("a transform needs the schema of its result")
        return transform_batches(out, transform, schema)

    def sample(self, n: int, replace: bool = False, seed: int = 0) -> DataFrame:
        self._check_version()
        return sample_rows(self.frame, n, self.id_column, replace, seed, self.columns, self.manifest)
