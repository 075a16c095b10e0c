"""Embedding generation with encoders supplied by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from karst.operators.bounds import quoted
from karst.operators.scan import check_count
from karst.operators.search import knn
from karst.schema import declare_vectors, unchecked_vectors, vector_aggregates
from karst.session import materialise_observed


def encode_batch(encoder: Callable, inputs: list) -> np.ndarray:
    """Run ``encoder`` on one batch and check what it returns.

    The encoder gives one vector per input, or a matrix with one row per
    input.  Vectors need one positive dimension and finite float values.
    """
    output = encoder(inputs)
    if isinstance(output, np.ndarray) and output.ndim == 2:
        block = output
        if block.dtype.kind not in "iuf":
            raise ValueError("the encoder must return real numbers")
    elif isinstance(output, (list, tuple)) or isinstance(output, np.ndarray):
        rows = [np.asarray(v) for v in output]
        if any(r.ndim != 1 or r.dtype.kind not in "iuf" and r.size for r in rows):
            raise ValueError("the encoder must return vectors of real numbers")
        if len({r.size for r in rows}) > 1:
            raise ValueError("embedding dimensions must agree")
        block = np.stack(rows) if rows else np.empty((0, 0), np.float32)
    else:
        raise ValueError("the encoder must return vectors or a matrix")
    if len(block) != len(inputs):
        raise ValueError("the encoder must return one vector per input")
    with np.errstate(over="ignore"):
        block = block.astype(np.float32)
    if len(block) and block.shape[1] == 0:
        raise ValueError("the encoder returned vectors without values")
    if not np.isfinite(block).all():
        raise ValueError("embeddings must be finite in single precision")
    return block


def _vectors(block: np.ndarray) -> pa.Array:
    width = block.shape[1] if len(block) else 0
    offsets = np.arange(len(block) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.ravel(), pa.float32()))


def with_embeddings(df: DataFrame, source: str, encoder: Callable, column: str = "embedding",
                    batchsize: int = 64, overwrite: bool = False, encoder_factory: bool = False,
                    check: bool = True) -> DataFrame:
    """``df`` plus a float vector column computed from ``source``.

    Tasks hand the encoder ``batchsize`` values at a time, across Arrow batch
    borders.  With ``encoder_factory=True``, ``encoder()`` is called once per task
    to load a model.  ``check`` writes the result once to the scratch folder and
    verifies that all tasks produced the same dimension, so an expensive model
    runs once.
    """
    check_count(batchsize, "batchsize", 1)
    if source not in df.columns:
        raise ValueError(f"nothing to encode: no column {source}")
    if column in df.columns and not overwrite:
        raise ValueError(f"{column} is taken; pass overwrite=True to replace it")
    if df.isEmpty():
        raise ValueError("cannot infer the embedding dimension from empty data")
    kept = [c for c in df.columns if c != column]
    # a column that is both source and target is read under another name
    feed = df.select(*[F.col(quoted(c)) for c in kept], F.col(quoted(source)).alias("_source"))
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(column, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder() if encoder_factory else encoder
        dim = None
        waiting: pa.Table | None = None

        def flush(table: pa.Table) -> pa.RecordBatch:
            nonlocal dim
            block = encode_batch(model, table["_source"].to_pylist())
            if dim is not None and block.shape[1] != dim:
                raise ValueError("the embedding dimension changed between batches")
            dim = block.shape[1]
            arrays = [table[c].combine_chunks() for c in kept] + [_vectors(block)]
            return pa.RecordBatch.from_arrays(arrays, names=[*kept, column])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            full = waiting.num_rows - waiting.num_rows % batchsize
            for lo in range(0, full, batchsize):
                yield flush(waiting.slice(lo, batchsize))
            waiting = waiting.slice(full)
        if waiting is not None and waiting.num_rows:
            yield flush(waiting)

    encoded = feed.mapInArrow(run, schema)
    if not check:
        return encoded
    written, facts = materialise_observed(encoded, "embeddings", vector_aggregates(unchecked_vectors(schema)))
    return declare_vectors(written, [column], facts)


def embedding_search(df: DataFrame, value, encoder: Callable, k: int, column: str = "embedding", **options) -> DataFrame:
    """Encode one query value on the driver and search for its neighbours."""
    vector = encode_batch(encoder, [value])[0]
    return knn(df, vector, k, column, **options)


def embedding_dims(df: DataFrame, column: str) -> DataFrame:
    """One row: smallest and largest dimension, and whether all values are finite."""
    value = F.col(quoted(column))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return df.agg(F.count(value).alias("vectors"), F.min(F.size(value)).alias("min_dim"),
                  F.max(F.size(value)).alias("max_dim"), F.min(finite).alias("all_finite"))


