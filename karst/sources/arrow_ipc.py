"""Arrow tables and IPC files.

A small in-memory table goes through ``createDataFrame``.  Files are read by a
Python data source: one input partition per run of record batches, so a large
file is read by many tasks.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from karst.schema import VECTOR_DIM
from karst.session import posix_path

BATCHES_PER_PARTITION = 64


def plain_type(dtype: pa.DataType) -> pa.DataType:
    """The Arrow type Spark reads for a physical input type.

    Unsigned integers widen, dictionaries are decoded, times become
    nanoseconds as integers, large and fixed-size layouts become ordinary ones.
    """
    if pa.types.is_dictionary(dtype):
        return plain_type(dtype.value_type)
    if pa.types.is_uint8(dtype):
        return pa.int16()
    if pa.types.is_uint16(dtype):
        return pa.int32()
    if pa.types.is_uint32(dtype):
        return pa.int64()
    if pa.types.is_uint64(dtype):
        return pa.decimal128(20, 0)
    if pa.types.is_float16(dtype):
        return pa.float32()
    if pa.types.is_time(dtype):
        return pa.int64()
    if pa.types.is_date64(dtype):
        return pa.date32()
    if pa.types.is_timestamp(dtype):
        if dtype.tz is not None:
            raise ValueError("zoned timestamps are not supported")
        return pa.timestamp("us")
    if pa.types.is_large_string(dtype) or pa.types.is_string_view(dtype):
        return pa.string()
    if pa.types.is_large_binary(dtype) or pa.types.is_fixed_size_binary(dtype) or pa.types.is_binary_view(dtype):
        return pa.binary()
    if pa.types.is_fixed_size_list(dtype) or pa.types.is_list(dtype) or pa.types.is_large_list(dtype):
        return pa.list_(pa.field("element", plain_type(dtype.value_type), dtype.value_field.nullable))
    if pa.types.is_struct(dtype):
        return pa.struct([pa.field(f.name, plain_type(f.type), f.nullable) for f in dtype])
    if pa.types.is_map(dtype) or pa.types.is_decimal(dtype) or pa.types.is_duration(dtype) or pa.types.is_interval(dtype):
        raise ValueError(f"unsupported Arrow type {dtype}")
    return dtype


def plain_schema(schema: pa.Schema) -> pa.Schema:
    return pa.schema([pa.field(f.name, plain_type(f.type), f.nullable) for f in schema])


def plain_array(array: pa.Array, target: pa.DataType) -> pa.Array:
    if array.type == target:
        return array
    if pa.types.is_dictionary(array.type):
        return plain_array(array.dictionary_decode(), target)
    if pa.types.is_time(array.type):
        unit = {"s": 1_000_000_000, "ms": 1_000_000, "us": 1000, "ns": 1}[array.type.unit]
        import pyarrow.compute as pc
        raw = array.cast(pa.int32() if pa.types.is_time32(array.type) else pa.int64()).cast(pa.int64())
        return pc.multiply(raw, unit)
    if pa.types.is_struct(target):
        children = [plain_array(array.field(i), target[i].type) for i in range(target.num_fields)]
        return pa.StructArray.from_arrays(children, fields=list(target), mask=array.is_null())
    if pa.types.is_list(target):
        sizes = array.value_lengths().fill_null(0) if array.null_count else array.value_lengths()
        ends = [0]
        for n in sizes.to_pylist():
            ends.append(ends[-1] + n)
        values = plain_array(array.flatten(), target.value_type)
        offsets = pa.array(ends, pa.int32())
        return pa.ListArray.from_arrays(offsets, values, type=target,
                                        mask=array.is_null() if array.null_count else None)
    return array.cast(target)


def spark_schema(schema: pa.Schema) -> T.StructType:
    """Spark schema of an Arrow schema; fixed-size float lists declare their dimension."""
    out = from_arrow_schema(plain_schema(schema), prefer_timestamp_ntz=True)
    fields = []
    for field, source in zip(out.fields, schema):
        metadata = {VECTOR_DIM: source.type.list_size} if (
            pa.types.is_fixed_size_list(source.type) and pa.types.is_floating(source.type.value_type)) else {}
        fields.append(T.StructField(field.name, field.dataType, field.nullable, metadata))
    return T.StructType(fields)


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    """DataFrame from an in-memory Arrow table; the driver already holds its rows."""
    if not table.num_columns:
        raise ValueError("a table needs at least one column")
    target = plain_schema(table.schema)
    columns = [plain_array(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c, f.type)
               for c, f in zip(table.columns, target)]
    schema = spark_schema(table.schema)
    if table.num_rows == 0:
        return spark.createDataFrame([], schema)
    plain = pa.Table.from_arrays(columns, schema=target)
    frame = spark.createDataFrame(plain, _nullable(schema))
    for field in schema.fields:
        if field.metadata:
            frame = frame.withMetadata(field.name, field.metadata)
    return frame


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class _Run(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


def _open(path: str):
    source = pa.memory_map(path)
    try:
        return ipc.open_file(source), True
    except pa.ArrowInvalid:
        source.seek(0)
        return ipc.open_stream(source), False


def ipc_files(path: str) -> list[str]:
    root = posix_path(path)
    if os.path.isdir(root):
        return sorted(p for p in glob.glob(os.path.join(root, "*")) if p.endswith((".arrow", ".ipc", ".feather")))
    return sorted(glob.glob(root))


class ArrowIpcReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_Run]:
        runs = []
        for path in ipc_files(self.path):
            reader, random_access = _open(path)
            if random_access:
                count = reader.num_record_batches
                runs += [_Run(path, lo, min(lo + BATCHES_PER_PARTITION, count))
                         for lo in range(0, count, BATCHES_PER_PARTITION)]
            else:
                runs.append(_Run(path, 0, -1))
        return runs

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        reader, random_access = _open(partition.path)
        target = plain_schema(reader.schema)
        batches = (reader.get_batch(i) for i in range(partition.start, partition.stop)) if random_access else reader
        for batch in batches:
            yield pa.RecordBatch.from_arrays([plain_array(c, f.type) for c, f in zip(batch.columns, target)], schema=target)


class ArrowIpcSource(DataSource):
    """``spark.read.format("arrow_ipc").load(path)``: files, a directory or a glob."""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self) -> T.StructType:
        found = ipc_files(self.options["path"])
        if not found:
            raise FileNotFoundError(f"no Arrow files at {self.options['path']}")
        return _nullable(spark_schema(_open(found[0])[0].schema))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArrowIpcReader(self.options["path"])


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """Rows of Arrow IPC files on a file system every executor has mounted."""
    spark.dataSource.register(ArrowIpcSource)
    frame = spark.read.format("arrow_ipc").load(path)
    for field in spark_schema(_open(ipc_files(path)[0])[0].schema).fields:
        if field.metadata:
            frame = frame.withMetadata(field.name, field.metadata)
    return frame


def write_arrow(df: DataFrame, path: str) -> int:
    """Write one IPC file per partition; a repeated task replaces its own file."""
    root = posix_path(path)
    target = to_arrow_schema(df.schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        os.makedirs(root, exist_ok=True)
        final = os.path.join(root, f"part-{part:05d}.arrow")
        temporary = f"{final}.{TaskContext.get().taskAttemptId()}.tmp"
        rows = 0
        with ipc.new_file(temporary, target) as writer:
            for batch in batches:
                rows += batch.num_rows
                writer.write_batch(batch.cast(target) if batch.schema != target else batch)
        os.replace(temporary, final)
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], ["rows"])

    return sum(r[0] for r in df.mapInArrow(write, "rows bigint").collect())
