"""Exact nearest-neighbour search: one query vector, or a table of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from karst.functions import kernels
from karst.functions.metrics import check_metric, distance, literal_vector, query_vector
from karst.operators.bounds import BROADCAST_BYTES, quoted
from karst.operators.numbering import TOP_N, smallest
from karst.operators.scan import check_count, where as apply_where
from karst.schema import VECTOR_DIM, is_numeric, is_vector_type
from karst.session import materialise

DISTANCE = "_distance"
FILE, LINE = "_karst_file", "_karst_line"   # where a row lies: its file, and its number there
LITERALS = 1000         # files and keys of winners that are named in a filter
QUERY_SLICE = 512       # size of one matrix product inside a task
VECTOR_SLICE, FIRST_SLICE = 8192, 1024
PAIR_SLICE = 1 << 17


def vector_column(schema: T.StructType, column: str | None = None) -> str:
    """The column to search: the named one, else ``vector``, else the only candidate."""
    if column is not None:
        if column not in schema.names:
            raise ValueError(f"vector column does not exist: {column}")
        dtype = schema[column].dataType
        if not (isinstance(dtype, T.BinaryType)
                or isinstance(dtype, T.ArrayType) and is_numeric(dtype.elementType)):
            raise ValueError(f"column {column} does not hold vectors")
        return column
    numeric = [f.name for f in schema.fields
               if isinstance(f.dataType, T.ArrayType) and is_numeric(f.dataType.elementType)]
    if "vector" in numeric:
        return "vector"
    floats = [n for n in numeric if is_vector_type(schema[n].dataType)]
    found = floats or numeric
    if len(found) != 1:
        raise ValueError(f"name the vector column; candidates: {found}")
    return found[0]


def _query_codes(query, metric: str) -> np.ndarray:
    if metric != "hamming":
        return query_vector(query)
    if isinstance(query, (bytes, bytearray)):
        return np.frombuffer(bytes(query), np.uint8)
    codes = np.asarray(query)
    if codes.ndim != 1 or codes.size == 0 or codes.dtype.kind not in "iu":
        raise ValueError("hamming search needs a non-empty list of integer codes")
    return codes


def _check_dim(schema: T.StructType, column: str, query: np.ndarray) -> None:
    dim = (schema[column].metadata or {}).get(VECTOR_DIM)
    if dim is not None and dim != len(query):
        raise ValueError(f"the query has {len(query)} values, column {column} has vectors of {dim}")


def _best(table: pa.Table, k: int, order: list[str]) -> pa.Table:
    """The k first rows by ``order``; rows clearly beyond the k-th distance are cut first."""
    if table.num_rows > k:
        keep = kernels.candidates(table[DISTANCE].to_numpy().astype(np.float64), k, 0.0)
        table = table.take(pa.array(keep))
    keys = [(name, "ascending") for name in order]
    return table.take(pc.sort_indices(table, sort_keys=keys)[:k])


def top_k_batches(query: np.ndarray, column: str, metric: str, k: int, order: list[str],
                  keep: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partition function that keeps the k nearest rows and emits them once.

    A very large k is not kept in memory: every row is emitted with its distance.
    """

    trim = k <= TOP_N

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: pa.Table | None = None
        for batch in batches:
            vectors, present = kernels.matrix(batch.column(column), len(query))
            if not len(vectors):
                continue
            values = kernels.distances(vectors, query, metric)
            rows = np.flatnonzero(present)
            near = kernels.candidates(values, k)
            if not len(near):
                continue
            picked = pa.Table.from_batches([batch.select(keep)]).take(pa.array(rows[near]))
            picked = picked.append_column(DISTANCE, pa.array((values[near] + 0.0).astype(np.float32)))
            if not trim:
                yield from picked.combine_chunks().to_batches()
                continue
            best = picked if best is None else pa.concat_tables([best, picked])
            best = _best(best, k, order)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return run


def read_from_files(df: DataFrame) -> bool:
    """Whether the rows of ``df`` are rows of files, filtered and projected only."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        if not plan.deterministic():
            return False
        plan = plan.children().apply(0)
    return plan.getClass().getSimpleName() == "LogicalRelation" and "_metadata" not in df.columns


def _of_any_width(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))


def fetched(rows: DataFrame, winners: DataFrame, order: Sequence[str]) -> DataFrame:
    """Whole rows of ``winners(FILE, LINE, ...)``, which hold the place of each and no more than a search returns.

    The second scan opens only the files that winners lie in, and within them
    the row groups that may hold their first key; the reader prunes by both.
    """
    files = winners.select(FILE).distinct().limit(LITERALS + 1).collect()
    placed = rows.withColumns({FILE: F.col("_metadata.file_path"), LINE: F.col("_metadata.row_index")})
    if len(files) <= LITERALS:
        placed = placed.filter(F.col(FILE).isin([r[0] for r in files]))
    if order:
        low, high = winners.agg(F.min(quoted(order[0])), F.max(quoted(order[0]))).first()
        if low is not None and isinstance(rows.schema[order[0]].dataType, (T.IntegralType, T.StringType, T.DateType)):
            placed = placed.filter(F.col(quoted(order[0])).between(low, high) | F.col(quoted(order[0])).isNull())
    return placed.join(winners.select(FILE, LINE, DISTANCE), [FILE, LINE]).drop(FILE, LINE)


def knn(df: DataFrame, query, k: int, column: str | None = None, metric: str = "l2",
        key: str | Sequence[str] | None = None, where: str | Column | None = None,
        prefilter: bool = True, select: Sequence[str] | None = None, offset: int = 0,
        engine: str = "arrow") -> DataFrame:
    """The ``k`` rows nearest to ``query``, with a float ``_distance``, ascending.

    ``key`` breaks ties and makes the result deterministic.  The filter applies
    before the search, or to the k winners with ``prefilter=False``.
    ``engine="arrow"`` computes distances per Arrow batch and leaves k rows per
    partition; ``engine="columns"`` stays in JVM expressions.  Rows with a null
    vector never match.

    If wide columns are asked for and the rows come straight from files, the
    search itself sees the key and the vector only.  The winners' places are
    written down, and a second scan fetches the columns of those rows.
    """
    check_count(k, "k")
    check_count(offset, "offset")
    metric = check_metric(metric)
    name = vector_column(df.schema, column)
    target = _query_codes(query, metric)
    _check_dim(df.schema, name, target)
    order = [] if key is None else [key] if isinstance(key, str) else list(key)
    wanted = [c for c in (select if select is not None else df.columns) if c != DISTANCE]
    unknown = [c for c in [*wanted, *order] if c not in df.columns]
    if unknown:
        raise ValueError(f"column does not exist: {', '.join(unknown)}")
    rows = apply_where(df, where) if prefilter else df
    rows = rows.filter(F.col(quoted(name)).isNotNull())
    # a filter on the winners may need columns that are not returned
    carried = list(dict.fromkeys([*wanted, *order, *([] if prefilter else df.columns)]))
    late = (any(_of_any_width(df.schema[c].dataType) for c in carried if c not in (*order, name))
            and read_from_files(df))
    if late:
        places = {FILE: F.col("_metadata.file_path"), LINE: F.col("_metadata.row_index")}
        narrow = rows.select(*[F.col(quoted(c)) for c in dict.fromkeys([*order, name])], *[v.alias(c) for c, v in places.items()])
        found = materialise(_scored_top(narrow, target, name, metric, k, offset, order, [*order, FILE, LINE], engine), "winners")
        top = smallest(fetched(rows, found, order), [DISTANCE, *order], k, 0)
    else:
        top = _scored_top(rows, target, name, metric, k, offset, order, carried, engine)
    if not prefilter:
        top = apply_where(top, where)
    return top.select(*[F.col(quoted(c)) for c in wanted], DISTANCE)


def _scored_top(rows: DataFrame, target: np.ndarray, name: str, metric: str, k: int, offset: int, order: list[str],
                carried: list[str], engine: str) -> DataFrame:
    """The ``k`` nearest ``rows`` after ``offset``, with the columns ``carried`` and their distance."""
    if engine == "arrow":
        scan = rows.select(*[F.col(quoted(c)) for c in dict.fromkeys([*carried, name])])
        schema = T.StructType([rows.schema[c] for c in carried] + [T.StructField(DISTANCE, T.FloatType())])
        scored = scan.mapInArrow(
            top_k_batches(target, name, metric, max(k + offset, 1), [DISTANCE, *order], carried), schema)
    elif engine == "columns":
        vector = F.col(quoted(name))
        sized = F.when(F.size(vector) == len(target), vector).otherwise(
            F.raise_error(F.lit(f"expected vectors of dimension {len(target)}")).cast(rows.schema[name].dataType))
        scored = (rows.withColumn(DISTANCE, distance(sized, literal_vector(target), metric))
                  .filter(F.col(DISTANCE).isNotNull() & ~F.isnan(DISTANCE)))
    else:
        raise ValueError("engine must be 'arrow' or 'columns'")
    return smallest(scored, [DISTANCE, *order], k, offset).select(*[F.col(quoted(c)) for c in carried], DISTANCE)


class _BlockTopK:
    """Running top k of one block of queries against any number of vector batches."""

    def __init__(self, ids: pa.Array, points: np.ndarray, metric: str, k: int, names: tuple[str, str],
                 edges: np.ndarray | None = None):
        self.ids, self.points, self.metric, self.k, self.names = ids, points, metric, k, names
        # a k-th distance known from elsewhere; rows beyond it are not wanted
        self.edges = np.full(len(points), np.inf) if edges is None else edges.astype(np.float64)
        self.lines = np.empty(0, np.int64)
        self.table: pa.Table | None = None

    def add(self, ids: pa.Array, vectors: np.ndarray) -> None:
        lo = 0
        while lo < len(vectors):
            # the first rows only tell how far the others may be
            step = FIRST_SLICE if self.table is None and np.isinf(self.edges).any() else VECTOR_SLICE
            self._add_slice(ids[lo:lo + step], vectors[lo:lo + step])
            lo += step

    def _add_slice(self, ids: pa.Array, vectors: np.ndarray) -> None:
        pairs = kernels.near_pairs(vectors, self.points, self.metric, self.edges)
        if pairs is None:
            rough = kernels.distances_many(vectors, self.points, self.metric)
            pairs = kernels.candidate_pairs(*kernels.distance_bounds(rough, vectors, self.points, self.metric), self.k, self.edges)
        line, pick = pairs
        # many ties at the edge give many candidates: they are settled piece by piece
        for lo in range(0, len(line), PAIR_SLICE):
            self._merge(line[lo:lo + PAIR_SLICE], pick[lo:lo + PAIR_SLICE], ids, vectors)

    def _merge(self, line: np.ndarray, pick: np.ndarray, ids: pa.Array, vectors: np.ndarray) -> None:
        if not len(line):
            return
        exact = kernels.distances(vectors[pick], self.points[line], self.metric).astype(np.float32)
        part = pa.table({"_line": pa.array(line, pa.int64()),
                         self.names[1]: ids.take(pa.array(pick, pa.int64())),
                         DISTANCE: pa.array(exact + np.float32(0.0))})
        merged = part if self.table is None else pa.concat_tables([self.table, part])
        merged = merged.take(pc.sort_indices(merged, sort_keys=[
            ("_line", "ascending"), (DISTANCE, "ascending"), (self.names[1], "ascending")]))
        lines = merged["_line"].to_numpy()
        starts = np.flatnonzero(np.r_[True, lines[1:] != lines[:-1]])
        rank = np.arange(len(lines)) - np.repeat(starts, np.diff(np.r_[starts, len(lines)]))
        self.table = merged.take(pa.array(np.flatnonzero(rank < self.k))).combine_chunks()
        last = np.flatnonzero(rank == self.k - 1)
        self.edges[lines[last]] = np.minimum(self.edges[lines[last]], merged[DISTANCE].to_numpy()[last])

    def result(self) -> pa.Table | None:
        if self.table is None:
            return None
        return pa.table({self.names[0]: self.ids.take(self.table["_line"].combine_chunks()),
                         self.names[1]: self.table[self.names[1]], DISTANCE: self.table[DISTANCE]})


def blocks_of(ids: pa.Array, points: np.ndarray, metric: str, k: int, names: tuple[str, str],
              edges: np.ndarray | None = None) -> list[_BlockTopK]:
    return [_BlockTopK(ids[lo:lo + QUERY_SLICE], points[lo:lo + QUERY_SLICE], metric, k, names,
                       None if edges is None else edges[lo:lo + QUERY_SLICE])
            for lo in range(0, len(points), QUERY_SLICE)]


def knn_join(queries: DataFrame, vectors: DataFrame, k: int, query_key: str, vector_key: str,
             query_column: str, vector_column_name: str, metric: str = "l2",
             query_block: int | None = None, vector_block: int | None = None,
             broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The ``k`` nearest ``vectors`` of every row of ``queries``; both keys are unique.

    Returns the two keys and ``_distance``.  Queries measured to fit
    ``broadcast_bytes`` are shipped to the tasks that scan the vectors, so the
    vector table is read once and never shuffled.  More queries than that are
    split into blocks of that size, as are the vectors, and Spark co-groups
    pairs of blocks.  For l2 and cosine the blocks are parts of Voronoi cells,
    and only those pairs meet that can hold a neighbour (``pivots``); the other
    metrics have no triangle inequality to tell by, so all pairs of blocks
    meet.  All ways score block against block with matrix products and emit k
    rows per query and block, so pairs of rows are never materialised.
    """
    check_count(k, "k", 1)
    metric = check_metric(metric)
    names = (query_key, vector_key)
    if query_key == vector_key:
        raise ValueError("rename one key: query and vector keys must differ")
    q = queries.select(F.col(quoted(query_key)), F.col(quoted(query_column)).alias("_q")).filter("_q IS NOT NULL")
    v = vectors.select(F.col(quoted(vector_key)), F.col(quoted(vector_column_name)).alias("_v")).filter(
        "_v IS NOT NULL")
    schema = T.StructType([T.StructField(query_key, queries.schema[query_key].dataType),
                           T.StructField(vector_key, vectors.schema[vector_key].dataType),
                           T.StructField(DISTANCE, T.FloatType())])
    probe = q.agg(F.count("*").alias("n"), F.max(F.size("_q")).alias("dim"), F.min(F.size("_q")).alias("lo"),
                  F.sum(F.octet_length(F.col(quoted(query_key)).cast("string"))).alias("key_bytes")).first()
    if not probe["n"]:
        return queries.sparkSession.createDataFrame([], schema)
    dim = probe["dim"]
    if dim != probe["lo"] or dim == 0:
        raise ValueError("query vectors need one positive dimension")

    if probe["n"] * (8 * dim + 16) + (probe["key_bytes"] or 0) <= broadcast_bytes:
        table = q.toArrow()
        ids = table[query_key].combine_chunks()
        points, _ = kernels.matrix(table["_q"], dim)
        shared = queries.sparkSession.sparkContext.broadcast((ids, points))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, targets = shared.value
            blocks = blocks_of(query_ids, targets, metric, k, names)
            for batch in batches:
                rows, present = kernels.matrix(batch.column("_v"), dim)
                keys, rows = kernels.without_surplus_copies(
                    batch.column(vector_key).filter(pa.array(present)), rows, k)
                for block in blocks:
                    block.add(keys, rows)
            for block in blocks:
                part = block.result()
                if part is not None:
                    yield from part.combine_chunks().to_batches()

        found = v.mapInArrow(scan, schema)
    elif metric in ("l2", "cosine"):
        from karst.operators.pivots import pivot_join
        found = pivot_join(q, v, k, query_key, vector_key, dim, metric, schema, query_block, vector_block)
    else:
        query_block = query_block or max(1, BROADCAST_BYTES // (8 * dim))
        vector_block = vector_block or max(1, BROADCAST_BYTES // (8 * dim))
        n_q = -(-probe["n"] // query_block)
        n_v = max(1, -(-v.count() // vector_block))

        def block(key: str, vector: str, count: int) -> Column:
            return F.pmod(F.xxhash64(F.col(quoted(key)), F.col(vector)), F.lit(count)).cast("int")

        left = q.select(block(query_key, "_q", n_q).alias("_bq"),
                        F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))).alias("_bv"), "*")
        right = v.select(F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("_bq"),
                         block(vector_key, "_v", n_v).alias("_bv"), "*")

        def pair(a: pa.Table, b: pa.Table) -> pa.Table:
            parts = [pa.table({query_key: pa.array([], a.schema.field(query_key).type),
                               vector_key: pa.array([], b.schema.field(vector_key).type),
                               DISTANCE: pa.array([], pa.float32())})]
            if a.num_rows and b.num_rows:
                targets, _ = kernels.matrix(a["_q"], dim)
                points, _ = kernels.matrix(b["_v"], dim)
                keys, points = kernels.without_surplus_copies(b[vector_key].combine_chunks(), points, k)
                for block in blocks_of(a[query_key].combine_chunks(), targets, metric, k, names):
                    block.add(keys, points)
                    parts.append(block.result())
            return pa.concat_tables([p for p in parts if p is not None])

        found = left.groupBy("_bq", "_bv").cogroup(right.groupBy("_bq", "_bv")).applyInArrow(pair, schema)

    # each task left k rows per query, and Spark's group limit cuts to k again
    # before the shuffle, so the final window sees k rows per query and task
    window = Window.partitionBy(F.col(quoted(query_key))).orderBy(DISTANCE, F.col(quoted(vector_key)))
    return found.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k).drop("_rank")
