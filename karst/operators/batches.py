"""Id manifests, training batches and samples.

A manifest is a DataFrame ``(pos, id)`` with positions 1..n.  Only the id
column is read to build it; other columns join it when they are needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from karst.operators import numbering
from karst.operators.bounds import left_join_unique, quoted
from karst.operators.lookup import POS, _id_type, check_ids, projection, request_frame, take_ids
from karst.operators.mutate import check_unique
from karst.operators.scan import check_count


def shuffle_key(seed: int, value: Column) -> Column:
    """Pseudo-random sort key that depends on the seed and the id only, so any
    partitioning of the table gives the same order."""
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), value.cast("string")))


def _with_null_check(ids: DataFrame, id_column: str) -> DataFrame:
    name = F.col(quoted(id_column))
    checked = F.when(name.isNull(), F.raise_error(F.lit("ids cannot be null")).cast(ids.schema[id_column].dataType))
    return ids.select(checked.otherwise(name).alias(id_column))


def id_manifest(df: DataFrame, id_column: str = "id", ids: DataFrame | Iterable | None = None,
                seed: int | None = None, check: bool = True) -> DataFrame:
    """Positions 1..n of the unique ids, in id order or shuffled by ``seed``.

    ``ids`` restricts (and, if it is a list or carries ``pos``, orders) the manifest.
    """
    _id_type(df.schema, id_column)
    if ids is None:
        base = _with_null_check(df, id_column)
    elif isinstance(ids, DataFrame):
        base = ids
    else:
        base = request_frame(df.sparkSession, check_ids(ids), id_column)
    if check:
        check_unique(base, [id_column], "the dataset")
    if seed is None:
        if POS in base.columns:
            return base.select(POS, F.col(quoted(id_column)))
        return numbering.number_rows(base.select(F.col(quoted(id_column))), [id_column], POS)
    keyed = base.select(F.col(quoted(id_column)), shuffle_key(seed, F.col(quoted(id_column))).alias("_key"))
    return numbering.number_rows(keyed, ["_key", id_column], POS, keep=[id_column])


def rows_at(df: DataFrame, manifest: DataFrame, positions: DataFrame | Sequence[int], id_column: str = "id",
            columns: Sequence[str] | None = None, size: int | None = None) -> DataFrame:
    """Rows at 1-based manifest positions, in the order given, repeats included.

    ``positions`` is a list, or a DataFrame ``(pos, at)`` where ``pos`` orders
    the result and ``at`` is the manifest position.
    """
    listed = not isinstance(positions, DataFrame)
    if listed:
        values = list(positions)
        if any(isinstance(v, bool) or not isinstance(v, int) for v in values):
            raise ValueError("positions must be integers")
        count = size if size is not None else manifest.count()
        for value in values:
            if not 1 <= value <= count:
                raise IndexError(f"position {value} is outside 1..{count}")
        positions = df.sparkSession.createDataFrame(
            [(i + 1, v) for i, v in enumerate(values)], "pos bigint, at bigint")
    lookup = manifest.select(F.col(POS).alias("at"), F.col(quoted(id_column)))
    request = (positions.join(lookup, "at", "left") if listed else
               left_join_unique(positions, lookup, ["at"], F.col(POS), small=False))
    request = request.select(
        F.when(F.col(quoted(id_column)).isNotNull(), F.col(POS)).otherwise(
            F.raise_error(F.concat(F.lit("position is out of range: "), F.col("at").cast("string"))).cast("bigint")
        ).alias(POS), F.col(quoted(id_column)))
    return take_ids(df, request, id_column, columns, keep_pos=True)


def batches(df: DataFrame, batchsize: int = 32, id_column: str = "id", columns: Sequence[str] | None = None,
            shuffle: bool = False, seed: int = 0, drop_last: bool = False,
            manifest: DataFrame | None = None) -> DataFrame:
    """Rows with ``batch_id`` (from 0) and ``pos``; every batch but the last is full.

    ``shuffle`` permutes the ids by ``seed``; use a new seed per epoch.
    """
    check_count(batchsize, "batchsize", 1)
    names = projection(df.schema, id_column, columns)
    given = manifest is not None
    if manifest is None or shuffle:
        manifest = id_manifest(df, id_column, None if manifest is None else manifest.select(F.col(quoted(id_column))),
                               seed if shuffle else None, check=manifest is None)
    numbered = manifest.withColumn("batch_id", F.expr(f"(pos - 1) div {batchsize}"))
    if drop_last:
        total = manifest.count()
        numbered = numbered.filter(F.col("batch_id") < total // batchsize)
    if names == [id_column]:
        return numbered.select("batch_id", POS, F.col(quoted(id_column)))
    if given:
        # ids named by the caller must be stored, and once
        joined = take_ids(df, numbered.select(POS, F.col(quoted(id_column))), id_column, names, ordered=False, keep_pos=True)
        joined = joined.withColumn("batch_id", F.expr(f"({POS} - 1) div {batchsize}"))
    else:
        wide = df.select(*[F.col(quoted(n)) for n in dict.fromkeys([id_column, *names])])
        joined = numbered.join(wide, id_column)
    return joined.select("batch_id", POS, *[F.col(quoted(n)) for n in names])


def transform_batches(batched: DataFrame, transform: Callable[[pd.DataFrame], pd.DataFrame],
                      schema: str | T.StructType) -> DataFrame:
    """Apply a decoder, collator or augmentation to each batch.

    Spark brings a batch together in one task; its size is the batch size.
    ``transform`` gets the rows in batch order and returns rows of ``schema``.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return transform(frame.sort_values(POS, ignore_index=True))

    return batched.groupBy("batch_id").applyInPandas(run, schema)


def sample_rows(df: DataFrame, n: int, id_column: str = "id", replace: bool = False, seed: int = 0,
                columns: Sequence[str] | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """``n`` rows drawn uniformly over the ids, reproducible by ``seed``.

    Without replacement these are the ``n`` smallest shuffle keys.  With
    replacement draw ``i`` hashes ``seed:i`` to a position.
    """
    check_count(n, "n")
    names = projection(df.schema, id_column, columns)
    key = F.col(quoted(id_column))
    spark = df.sparkSession
    if n == 0:
        return df.select(*[F.col(quoted(c)) for c in names]).limit(0)
    base = df.select(key) if manifest is None else manifest.select(key)
    size = base.count()
    if size == 0:
        raise ValueError("there are no ids to draw from")
    if not replace:
        if n > size:
            raise ValueError(f"{n} draws without replacement from {size} ids")
        keyed = base.select(key, shuffle_key(seed, key).alias("_key"))
        chosen = numbering.smallest(keyed, ["_key", id_column], n).select(key)
        if manifest is not None:
            # ids named by the caller must be stored, and once
            request = chosen.select(F.monotonically_increasing_id().alias(POS), key)
            return take_ids(df, request, id_column, names, ordered=False)
        wide = df.select(*[F.col(quoted(c)) for c in dict.fromkeys([id_column, *names])])
        small = F.broadcast(chosen) if n <= numbering.TOP_N else chosen
        return wide.join(small, id_column, "left_semi").select(*[F.col(quoted(c)) for c in names])
    if manifest is None:
        manifest = id_manifest(df, id_column, check=False)
    draws = spark.range(n).select(
        (F.col("id") + 1).alias(POS),
        (F.conv(F.substring(F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col("id").cast("string"))), 1, 15), 16, 10)
         .cast("bigint") % F.lit(size) + 1).alias("at"))
    return rows_at(df, manifest, draws, id_column, names, size)
