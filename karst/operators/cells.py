"""Clustered layouts for approximate search: cells, product and scalar codes.

Centres come from Spark's k-means on a training sample.  The rows are written
clustered by cell, so a query that probes a few cells reads a few directories.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from karst.functions import kernels
from karst.functions.codes import CODE_WORDS, Cells, ProductCodes, ScalarCodes
from karst.functions.metrics import check_metric, query_vector
from karst.operators.bounds import quoted
from karst.operators.numbering import TOP_N, smallest
from karst.operators.scan import where as apply_where
from karst.operators.search import DISTANCE, knn, knn_join
from karst.schema import VECTOR_DIM
from karst.session import materialise

CELL, BUCKET, ROW, CODE = "_cell", "_bucket", "_row", "_code"
FRAGMENT = "_fragment"           # numbers the separate writes of one index; _row is unique within it
LAYOUT_COLUMNS = (CELL, BUCKET, ROW, CODE, FRAGMENT)
MAX_CENTRE_BYTES = 64 << 20      # centres are broadcast, so their size is bounded here
TRAIN_PER_CELL = 256
BOOK_ROWS = 2048                 # rows that share code books, as far as these fit MAX_CENTRE_BYTES
BOOK_TRAINED = 1 << 16           # rows that a task trains code books on
WORD_STEP = 1 << 13              # rows compared with the words of a code book at a time
SETTLED = 0.01                   # share of the error below which a round counts as no gain
ASKED = 32                       # rows that the recall of codes is measured with
ROW_GROUP = 16 << 20             # bytes of a row group, the least that a search of candidates reads
ROW_RANGES = 64                  # ranges of row numbers in the filter of a second scan
ROW_BLOCK, MAX_BLOCKS = 1 << 12, 4096


def cell_count(rows: int, dim: int, requested: int | None = None) -> int:
    """Cells of an index: as many as asked for, else the root of the rows within ``MAX_CENTRE_BYTES`` of centres.

    More centres than that cannot be broadcast, so asking for them raises.
    """
    most = MAX_CENTRE_BYTES // (4 * dim)
    if requested and requested > 0:
        wanted = min(requested, rows)
        if wanted > most:
            raise ValueError(f"{wanted} centres of {dim} values exceed {MAX_CENTRE_BYTES >> 20} MB; at most {most} fit")
        return max(1, wanted)
    return max(1, min(round(math.sqrt(rows)), most, rows))


def train_cells(df: DataFrame, column: str, metric: str = "l2", num_partitions: int | None = None,
                max_iterations: int | None = None, sample_rate: float | None = None, seed: int = 17) -> Cells:
    """K-means centres from a sample of the non-null vectors."""
    metric = check_metric(metric)
    if metric == "hamming":
        raise ValueError("clustered indexes need l2, cosine or dot")
    if num_partitions is not None and (num_partitions == 0 or num_partitions < -1):
        raise ValueError("num_partitions must be positive, or -1 for automatic")
    if sample_rate is not None and not 0.0 <= sample_rate <= 1.0:
        raise ValueError("sample_rate must be between 0 and 1")
    vector = F.col(quoted(column))
    vectors = df.select(vector.alias("v")).filter("v IS NOT NULL")
    dim = (df.schema[column].metadata or {}).get(VECTOR_DIM)
    if dim is not None:
        rows = df.count()        # checked when it was stored; file footers give the count
    else:
        rows, low, dim = vectors.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v"))).first()
        if rows and (low != dim or not dim):
            raise ValueError("vectors need one positive dimension")
    if not rows:
        raise ValueError("no vectors to train on")
    cells = cell_count(rows, dim, num_partitions)
    rate = sample_rate if sample_rate else min(1.0, TRAIN_PER_CELL * cells / rows)
    sample = vectors if rate >= 1.0 else vectors.sample(False, rate, seed)
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
        sample = sample.select(F.when(norm > 0, F.transform("v", lambda x: x / norm)).alias("v")).filter("v IS NOT NULL")
    features = sample.select(array_to_vector(F.col("v").cast("array<double>")).alias("features")).persist()
    try:
        trained = features.count()
        if not trained:
            raise ValueError("the training sample is empty; raise sample_rate")
        if cells == 1 or trained == 1:
            from pyspark.ml.stat import Summarizer
            centre = features.select(Summarizer.mean(F.col("features"))).first()[0].toArray()
            return Cells(centre[None, :].astype(np.float32), metric, [1.0])
        model = (KMeans(k=min(cells, trained), seed=seed, maxIter=max_iterations if max_iterations and max_iterations > 0 else 10,
                        featuresCol="features").fit(features))
        sizes = model.summary.clusterSizes
        return Cells(np.stack(model.clusterCenters()).astype(np.float32), metric, [s / trained for s in sizes])
    finally:
        features.unpersist()


def assign_cells(df: DataFrame, column: str, cells: Cells) -> DataFrame:
    """Non-null rows with the cell of their vector."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(cells)
    dim = cells.dim

    @F.arrow_udf(T.IntegerType())
    def nearest(values: pa.Array) -> pa.Array:
        model = shared.value
        rows, present = kernels.matrix(values, dim)
        out = np.zeros(len(values), np.int32)
        step = max(1, (32 << 20) // (8 * len(model.centres)))
        found = [kernels.nearest_rows(model.centres, model.prepare(rows[lo:lo + step]))
                 for lo in range(0, len(rows), step)]
        if found:
            out[present] = np.concatenate(found)
        return pa.array(out, mask=~present)

    vector = F.col(quoted(column))
    return df.filter(vector.isNotNull()).withColumn(CELL, nearest(vector))


def write_cells(assigned: DataFrame, cells: Cells, path: str, fragment: int = 0) -> None:
    """Write rows clustered by cell, one directory per bucket of cells.

    Rows of one cell go to one task, except that a cell expected to hold more
    than a task's share of the rows (by the training sample) is split.  The
    split follows the row order of the input, so read that from storage
    (``session.materialise`` it if it comes out of a shuffle).
    """
    spark = assigned.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = [(i, math.ceil(share * parts)) for i, share in enumerate(cells.shares) if share * parts > 1]
    salted = assigned.withColumn("_spread", F.monotonically_increasing_id())
    if splits:
        # at most one entry per shuffle partition
        table = spark.createDataFrame(splits, "_cell int, _splits int")
        salted = salted.join(F.broadcast(table), CELL, "left")
        salted = salted.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_spread"), F.col("_splits")), F.lit(0)))
        salted = salted.repartition(CELL, "_salt").drop("_splits", "_salt")
    else:
        salted = salted.repartition(CELL)
    bucket = F.floor(F.col(CELL) / F.lit(cells.width)).cast("int")
    (salted.drop("_spread").withColumn(BUCKET, bucket).sortWithinPartitions(BUCKET, CELL)
     .withColumn(ROW, F.monotonically_increasing_id()).withColumn(FRAGMENT, F.lit(fragment))
     .write.option("parquet.block.size", ROW_GROUP).partitionBy(BUCKET).parquet(path))


def read_cells(spark, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def probed(layout: DataFrame, cells: Cells, query: np.ndarray, nprobes: int | None) -> DataFrame:
    """Rows of the probed cells: the directories are pruned before anything is read."""
    if nprobes is None or nprobes >= len(cells.centres):
        return layout
    chosen = cells.probe(query, nprobes)
    buckets = sorted({c // cells.width for c in chosen})
    return layout.filter(F.col(BUCKET).isin(buckets) & F.col(CELL).isin(chosen))


def ivf_search(layout: DataFrame, cells: Cells, query: Sequence[float], k: int, column: str,
               nprobes: int | None = 20, **options) -> DataFrame:
    """Exact distances over the probed cells; all cells give the exact answer."""
    target = query_vector(query)
    return knn(probed(layout, cells, target, nprobes), target, k, column, metric=cells.metric, **options)


# ---------------------------------------------------------------- product codes

def sub_vector_count(dim: int, requested: int | None = None) -> int:
    if requested and requested > 0:
        if dim % requested:
            raise ValueError(f"num_sub_vectors must divide the dimension {dim}")
        return requested
    return next((dim // w for w in (16, 8, 4, 2) if dim % w == 0), dim)


def book_groups(counts: np.ndarray, most: int) -> np.ndarray:
    """Group of every cell: neighbours in number, with ``BOOK_ROWS`` rows or more where ``most`` groups would not do."""
    target = max(BOOK_ROWS, -(-int(counts.sum()) // most))
    before = np.cumsum(counts) - counts
    return np.unique(before // target, return_inverse=True)[1].ravel()


def train_product_codes(assigned: DataFrame, column: str, cells: Cells, num_sub_vectors: int | None = None,
                        iterations: int = 8, seed: int = 17) -> ProductCodes:
    """Code books of all sub-vectors for each group of cells.

    Books of one size for a growing table lose their fit: vectors without
    clusters leave over more than half of what the cells leave.  So cells of
    ``BOOK_ROWS`` rows share books, within ``MAX_CENTRE_BYTES`` of them.  A task
    trains a group on its rows, all up to about ``BOOK_TRAINED`` and a random
    share of them beyond.  Rounds end when the error hardly falls any more.
    """
    spark = assigned.sparkSession
    subs = sub_vector_count(cells.dim, num_sub_vectors)
    width = cells.dim // subs
    shared = spark.sparkContext.broadcast(cells)

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            vectors, _ = kernels.matrix(batch.column("v"), model.dim)
            cell = batch.column(CELL).to_numpy(zero_copy_only=False)
            rest = (model.prepare(vectors) - model.centres[cell]).astype(np.float32)
            edges = np.arange(len(rest) + 1, dtype=np.int32) * model.dim
            yield pa.RecordBatch.from_arrays([batch.column(CELL), pa.ListArray.from_arrays(pa.array(edges), pa.array(rest.ravel()))],
                                             [CELL, "rest"])

    rest = materialise(assigned.select(F.col(quoted(column)).alias("v"), CELL).mapInArrow(residuals, f"{CELL} int, rest array<float>"),
                       "residuals")
    counts = np.zeros(len(cells.centres), np.int64)
    for row in rest.groupBy(CELL).count().collect():
        counts[row[CELL]] = row["count"]
    group = book_groups(counts, max(1, MAX_CENTRE_BYTES // (4 * CODE_WORDS * cells.dim)))
    sizes = np.bincount(group, counts)
    table = spark.createDataFrame([(c, int(g), float(min(1.0, BOOK_TRAINED / max(sizes[g], 1)))) for c, g in enumerate(group)],
                                  f"{CELL} int, _group int, _share double")
    trained = rest.withColumn("_draw", F.rand(seed)).join(F.broadcast(table), CELL).filter("_draw < _share").select("_group", "rest")

    def train(rows: pa.Table) -> pa.Table:
        points, _ = kernels.matrix(rows["rest"], subs * width)
        books = [_code_book(points[:, s * width:(s + 1) * width], iterations, seed + s) for s in range(subs)]
        return pa.table({"_group": rows["_group"].slice(0, 1), "books": pa.array([np.stack(books).tobytes()], pa.binary())})

    books = np.zeros((len(sizes), subs, CODE_WORDS, width), np.float32)
    # within MAX_CENTRE_BYTES altogether
    for row in trained.groupBy("_group").applyInArrow(train, "_group int, books binary").toLocalIterator():
        books[row["_group"]] = np.frombuffer(row["books"], np.float32).reshape(subs, CODE_WORDS, width)
    return ProductCodes(books, group)


def _code_book(points: np.ndarray, iterations: int, seed: int) -> np.ndarray:
    """``CODE_WORDS`` words by k-means, started from distinct points."""
    unique = np.unique(points, axis=0)
    chosen = np.random.default_rng(seed).permutation(len(unique))[:CODE_WORDS]
    book = unique[np.resize(chosen, CODE_WORDS)].astype(np.float32)
    if len(unique) <= CODE_WORDS:
        return book
    last = math.inf
    for _ in range(iterations):
        word = np.concatenate([kernels.nearest_rows(book, points[lo:lo + WORD_STEP]) for lo in range(0, len(points), WORD_STEP)])
        counts = np.bincount(word, minlength=CODE_WORDS)[:, None]
        sums = np.stack([np.bincount(word, points[:, d], CODE_WORDS) for d in range(points.shape[1])], axis=1)
        error = float(((points - book[word]).astype(np.float64) ** 2).sum())
        book = np.where(counts > 0, sums / np.maximum(counts, 1), book).astype(np.float32)
        if error >= last * (1 - SETTLED):
            break
        last = error
    return book


def code_errors(layout: DataFrame, column: str, cells: Cells, codec: ProductCodes | ScalarCodes) -> DataFrame:
    """``layout`` with ``_error``, the squared distance of a vector to what its code stands for, and ``_energy``, to its cell's centre."""
    shared = layout.sparkSession.sparkContext.broadcast((cells, codec))

    @F.arrow_udf("_error double, _energy double")
    def errors(values: pa.Array, codes: pa.Array, cell: pa.Array) -> pa.Array:
        model, quantiser = shared.value
        rows, _ = kernels.matrix(values, model.dim)
        own = cell.to_numpy(zero_copy_only=False)
        wide = model.prepare(rows).astype(np.float64)
        raw, _ = kernels.matrix(codes, quantiser.size)
        decoded = quantiser.decode(model, raw, own)
        return pa.StructArray.from_arrays([pa.array(((wide - decoded) ** 2).sum(axis=1)),
                                           pa.array(((wide - model.centres[own]) ** 2).sum(axis=1))], ["_error", "_energy"])

    return layout.withColumn("_e", errors(F.col(quoted(column)), F.col(CODE), F.col(CELL))).select("*", "_e.*").drop("_e")


# ----------------------------------------------------------------- scalar codes

def train_scalar_codes(assigned: DataFrame, column: str, cells: Cells) -> ScalarCodes:
    """Range of every dimension: each task reduces its rows to two vectors first."""
    shared = assigned.sparkSession.sparkContext.broadcast(cells)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        low = high = None
        for batch in batches:
            vectors, _ = kernels.matrix(batch.column("v"), model.dim)
            if len(vectors):
                rows = model.prepare(vectors).astype(np.float64)
                low = rows.min(0) if low is None else np.minimum(low, rows.min(0))
                high = rows.max(0) if high is None else np.maximum(high, rows.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(model.dim, dtype=np.int32)), pa.array(low), pa.array(high)], ["d", "lo", "hi"])

    rows = (assigned.select(F.col(quoted(column)).alias("v")).mapInArrow(ranges, "d int, lo double, hi double")
            .groupBy("d").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("d").collect())
    low = np.array([r.lo for r in rows])
    span = np.array([r.hi for r in rows]) - low
    return ScalarCodes(low, np.where(span > 0, span / 255.0, 1.0))


def add_codes(assigned: DataFrame, column: str, cells: Cells, codec: ProductCodes | ScalarCodes) -> DataFrame:
    """``_code`` as bytes next to every assigned row."""
    shared = assigned.sparkSession.sparkContext.broadcast((cells, codec))
    dim = cells.dim

    @F.arrow_udf(T.BinaryType())
    def encode(values: pa.Array, cell: pa.Array) -> pa.Array:
        model, quantiser = shared.value
        rows, _ = kernels.matrix(values, dim)
        codes = quantiser.encode(model, rows, cell.to_numpy(zero_copy_only=False))
        return pa.array([c.tobytes() for c in codes], pa.binary())

    return assigned.withColumn(CODE, encode(F.col(quoted(column)), F.col(CELL)))


def code_search(layout: DataFrame, cells: Cells, codec: ProductCodes | ScalarCodes, query: Sequence[float], k: int,
                column: str, key: str | Sequence[str] | None = None, nprobes: int | None = 20,
                refine_factor: int | None = None, where: str | Column | None = None,
                prefilter: bool = True, select: Sequence[str] | None = None, offset: int = 0) -> DataFrame:
    """Search by codes, then optionally re-rank ``refine_factor * k`` rows exactly.

    The first pass reads only codes and filter columns of the probed cells.
    Its candidates are written down; the second pass names their directories
    and ranges of their row numbers in the filter of its scan, so that vectors
    and other columns are read from row groups that hold a candidate only.
    """
    target = query_vector(query)
    order = [] if key is None else [key] if isinstance(key, str) else list(key)
    names = [c for c in (select or [c for c in layout.columns if c not in LAYOUT_COLUMNS]) if c != DISTANCE]
    if refine_factor is not None and refine_factor < 1:
        raise ValueError("refine_factor must be positive")
    rows = probed(layout, cells, target, nprobes)
    if prefilter:
        rows = apply_where(rows, where)
    wanted = (k + offset) * (refine_factor or 1)
    shared = layout.sparkSession.sparkContext.broadcast((cells, codec))
    carried = list(dict.fromkeys([FRAGMENT, ROW, BUCKET, CELL, *order]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, quantiser = shared.value
        best: pa.Table | None = None
        for batch in batches:
            codes, _ = kernels.matrix(batch.column(CODE), quantiser.size)
            if not len(codes):
                continue
            values = quantiser.approximate(model, target, codes, batch.column(CELL).to_numpy(zero_copy_only=False))
            near = kernels.candidates(values, max(wanted, 1))
            part = pa.Table.from_batches([batch.select(carried)]).take(pa.array(near))
            part = part.append_column(DISTANCE, pa.array((values[near] + 0.0).astype(np.float32)))
            if wanted > TOP_N:
                yield from part.combine_chunks().to_batches()
                continue
            best = part if best is None else pa.concat_tables([best, part])
            best = best.take(_order(best, order)[:max(wanted, 1)])
        if best is not None:
            yield from best.combine_chunks().to_batches()

    schema = T.StructType([layout.schema[c] for c in carried] + [T.StructField(DISTANCE, T.FloatType())])
    scored = rows.select(*[F.col(quoted(c)) for c in dict.fromkeys([*carried, CODE])]).mapInArrow(scan, schema)
    found = materialise(smallest(scored, [DISTANCE, *order], wanted), "candidates")
    picked = found.select(FRAGMENT, ROW, F.col(DISTANCE).alias("_approximate"))
    full = candidate_rows(rows, found).join(picked, [FRAGMENT, ROW])
    if refine_factor:
        result = knn(full.drop("_approximate"), target, k, column, metric=cells.metric, key=key, select=names,
                     offset=offset, where=None if prefilter else where, prefilter=prefilter)
        return result
    top = smallest(full.withColumnRenamed("_approximate", DISTANCE), [DISTANCE, *order], k, offset)
    if not prefilter:
        top = apply_where(top, where)
    return top.select(*[F.col(quoted(c)) for c in names], DISTANCE)


def measured_refine_factor(layout: DataFrame, cells: Cells, codec: ProductCodes | ScalarCodes, k: int, column: str, key: str,
                           recall: float = 0.9, seed: int = 17) -> int:
    """Least ``refine_factor`` that finds ``recall`` of the k exact neighbours of each of ``ASKED`` random rows by their codes.

    How many candidates that takes depends on the vectors: few among clusters,
    a share of all rows where there are none.  One pass finds the neighbours,
    one counts the rows whose codes are as near as theirs.
    """
    spark = layout.sparkSession
    name = F.col(quoted(key))
    drawn = layout.orderBy(F.xxhash64(name, F.lit(seed)), name).select(F.col(quoted(column)).alias("q")).limit(ASKED).collect()
    asked = [np.asarray(r.q, np.float32) for r in drawn]
    numbered = spark.createDataFrame([(i, r.q) for i, r in enumerate(drawn)],
                                     T.StructType([T.StructField("_asked", T.IntegerType()), T.StructField("q", layout.schema[column].dataType)]))
    exact = knn_join(numbered, layout.select(name, F.col(quoted(column))), k, "_asked", key, "q", column, metric=cells.metric)
    near = layout.select(name, CODE, CELL).join(F.broadcast(exact.select("_asked", name)), key).select("_asked", CODE, CELL).collect()
    edges = np.full(len(asked), -math.inf)
    for i, query in enumerate(asked):
        own = [r for r in near if r["_asked"] == i]
        codes = np.frombuffer(b"".join(bytes(r[CODE]) for r in own), np.uint8).reshape(len(own), codec.size)
        values = np.sort(codec.approximate(cells, query, codes, np.array([r[CELL] for r in own], np.int64)))
        if len(values):
            edge = values[math.ceil(recall * len(values)) - 1]
            edges[i] = edge + kernels.SLACK * max(1.0, abs(edge))
    shared = spark.sparkContext.broadcast((cells, codec, asked, edges))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, quantiser, queries, limits = shared.value
        total = np.zeros(len(queries), np.int64)
        for batch in batches:
            codes, _ = kernels.matrix(batch.column(CODE), quantiser.size)
            cell = batch.column(CELL).to_numpy(zero_copy_only=False)
            for i, query in enumerate(queries):
                total[i] += np.count_nonzero(quantiser.approximate(model, query, codes, cell) <= limits[i])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "n"])

    counted = layout.select(CODE, CELL).mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    return max(1, -(-int(counted.agg(F.max("n")).first()[0] or 0) // k))


def row_ranges(places: list[tuple[int, int, int, int]], most: int = ROW_RANGES) -> list[tuple[int, int, int, int]]:
    """``(fragment, bucket, first, last)`` ranges merged over their smallest gaps until at most ``most`` are left in a directory."""
    merged: list[tuple[int, int, int, int]] = []
    for key in sorted({p[:2] for p in places}):
        own = sorted(p[2:] for p in places if p[:2] == key)
        gaps = sorted((b[0] - a[1], i) for i, (a, b) in enumerate(zip(own, own[1:])))
        cuts = sorted(i for _, i in gaps[len(gaps) - (most - 1):]) if len(gaps) >= most else list(range(len(gaps)))
        first = 0
        for cut in [*cuts, len(own) - 1]:
            merged.append((*key, own[first][0], own[cut][1]))
            first = cut + 1
    return merged


def candidate_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``rows`` in the ranges of row numbers that ``found`` has candidates in, by a filter that the reader prunes with.

    Candidates in more than ``MAX_BLOCKS`` blocks of row numbers are spread over so much of the layout
    that only the directories are named.
    """
    block = F.floor(F.col(ROW) / ROW_BLOCK)
    places = found.groupBy(FRAGMENT, BUCKET, block.alias("_b")).agg(F.min(ROW).alias("lo"), F.max(ROW).alias("hi"))
    places = [(p[FRAGMENT], p[BUCKET], p.lo, p.hi) for p in places.limit(MAX_BLOCKS + 1).collect()]
    if not places:
        return rows.limit(0)
    if len(places) > MAX_BLOCKS:
        return rows
    buckets = sorted({p[1] for p in places})
    ranges = row_ranges([(f, 0, lo, hi) for f, _, lo, hi in places])
    condition = None
    for fragment, _, low, high in ranges:
        one = (F.col(FRAGMENT) == fragment) & F.col(ROW).between(low, high)
        condition = one if condition is None else condition | one
    return rows.filter(F.col(BUCKET).isin(buckets) & condition)


def _order(table: pa.Table, order: list[str]) -> pa.Array:
    return pc.sort_indices(table, sort_keys=[(n, "ascending") for n in [DISTANCE, *order]])
