"""Exact nearest neighbours for a table of queries, block by block along a Voronoi partition.

Pivots cut both tables into cells, and a cell into rings of about equal size
around its pivot: those are the blocks.  With the distances between pivots and
the least and greatest distance of each block to its pivot, the triangle
inequality bounds every distance between two blocks from both sides.

1. A query block first meets its home blocks, the nearest ones that hold k
   vectors.  That gives every query a k-th distance.
2. The largest of those bounds the block: only vector blocks that can hold
   something closer are visited, and only by slices of queries whose own bound
   allows it, each starting from the k-th distance it has.  Blocks are sent
   in tiles of several, so a row travels to at most ``TILES`` of them, or as
   many as it takes to keep a tile within ``BROADCAST_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from karst.functions import kernels
from karst.functions.codes import unit_rows
from karst.operators.bounds import BROADCAST_BYTES, quoted
from karst.session import materialise_observed, materialise

#: bins of a cell by distance to the pivot, of which rings are made
BINS = 256
#: pivots for each block of vectors, and at most (centres and bins are broadcast)
PIVOTS_PER_BLOCK, MAX_PIVOTS = 4, 1024
#: rows of a tile of blocks each way, and tiles along a table as far as a tile's rows fit ``BROADCAST_BYTES``
TILE_ROWS, TILES = 1 << 13, 32
#: rounding of a distance, as a share of the lengths it comes from
SLACK = 1e-6
_NOWHERE = -1


def _directions(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Points whose l2 distances order like the metric: a chord of unit vectors is the root of twice their cosine distance."""
    return unit_rows(vectors).astype(np.float64) if metric == "cosine" else vectors.astype(np.float64)


def _chord(distance: np.ndarray, metric: str) -> np.ndarray:
    return np.sqrt(2.0 * np.maximum(distance, 0.0)) if metric == "cosine" else distance


def _train(v: DataFrame, dim: int, metric: str, count: int, rows: int, seed: int) -> np.ndarray:
    """Pivots: a few rounds of k-means on a sample of at most 64 rows for each."""
    want = 64 * count
    sample = v.select("_v") if rows <= want else v.select("_v").sample(False, min(1.0, 1.2 * want / rows), seed).limit(want)
    points, _ = kernels.matrix(sample.toArrow()["_v"], dim)
    points = _directions(points, metric)
    points = np.unique(points[np.isfinite(points).all(axis=1)], axis=0)
    if len(points) <= count:
        return points if len(points) else np.zeros((1, dim))
    centres = points[np.random.default_rng(seed).choice(len(points), count, replace=False)]
    for _ in range(5):
        owner = kernels.nearest_rows(centres, points)
        sizes = np.bincount(owner, minlength=count)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _located(rows: DataFrame, column: str, dim: int, metric: str, shared) -> DataFrame:
    """Rows with the cell of their vector and the distance to its pivot; a vector without a direction or length is nowhere."""
    def locate(values: pa.Array) -> pa.Array:
        vectors, present = kernels.matrix(values, dim)
        points = _directions(vectors, metric)
        cell, gap = np.full(len(values), _NOWHERE, np.int32), np.zeros(len(values))
        good = np.isfinite(points).all(axis=1)
        if metric == "cosine":
            good &= (points != 0).any(axis=1)
        at = np.flatnonzero(present)[good]
        for lo in range(0, len(at), 4096):
            part = points[good][lo:lo + 4096]
            own = kernels.nearest_rows(shared.value, part)
            cell[at[lo:lo + 4096]] = own
            gap[at[lo:lo + 4096]] = np.sqrt(((part - shared.value[own]) ** 2).sum(axis=1))
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(gap)], ["cell", "gap"])

    found = F.arrow_udf(locate, "cell int, gap double")(F.col(column))
    return rows.withColumn("_place", found).select("*", "_place.cell", "_place.gap").drop("_place")


def _blocked(rows: DataFrame, key: str, size: int, label: str) -> tuple[DataFrame, list]:
    """Rows with their block, and ``(block, cell, least gap, greatest gap, rows)`` of every block.

    There are at most ``MAX_PIVOTS * BINS`` bins, whatever the table holds; a
    bin with more rows than a block is dealt by the hash of the key.
    """
    written, facts = materialise_observed(rows, label, [F.max("gap").alias("most")])
    most = float(facts["most"] or 0.0) or 1.0
    bin_ = F.least(F.floor(F.col("gap") / F.lit(most) * BINS), F.lit(BINS - 1)).cast("int")
    placed = written.withColumn("_bin", bin_)
    bins = placed.groupBy("cell", "_bin").agg(F.count("*").alias("n"), F.min("gap").alias("lo"), F.max("gap").alias("hi")).collect()
    blocks, table = [], []
    last = None
    for b in sorted(bins, key=lambda b: (b.cell, b._bin)):
        parts = max(1, -(-b.n // size))
        if last is not None and parts == 1 and last["cell"] == b.cell and last["parts"] == 1 and last["n"] + b.n <= size:
            last.update(n=last["n"] + b.n, hi=b.hi)
        else:
            last = {"first": sum(x["parts"] for x in blocks[-1:]) + (blocks[-1]["first"] if blocks else 0), "cell": b.cell,
                    "lo": b.lo, "hi": b.hi, "n": b.n, "parts": parts}
            blocks.append(last)
        table.append((b.cell, b._bin, last["first"], last["parts"]))
    lookup = rows.sparkSession.createDataFrame(table, "cell int, _bin int, _first int, _parts int")
    dealt = placed.join(F.broadcast(lookup), ["cell", "_bin"]).withColumn(
        "_block", F.col("_first") + F.pmod(F.xxhash64(F.col(quoted(key))), F.col("_parts")).cast("int"))
    summary = [(x["first"] + i, x["cell"], x["lo"], x["hi"], -(-x["n"] // x["parts"])) for x in blocks for i in range(x["parts"])]
    return dealt.drop("_bin", "_first", "_parts"), summary


def block_bounds(cell: int, low: float, high: float, others: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance from anything in a block to anything in each of ``others`` (block, cell, low, high, rows)."""
    cells = others[:, 1].astype(int)
    apart = between[cell, cells]
    slack = SLACK * (apart + high + others[:, 3])
    least = np.maximum.reduce([np.zeros(len(others)), apart - high - others[:, 3], others[:, 2] - high - apart, low - others[:, 3] - apart])
    least, most = np.maximum(least - slack, 0.0), apart + high + others[:, 3] + slack
    nowhere = cells == _NOWHERE
    return np.where(nowhere, 0.0, least), np.where(nowhere, np.inf, most)


def home_blocks(upper: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The blocks with the least upper bounds that hold ``k`` rows together."""
    order = np.argsort(upper, kind="stable")
    enough = int(np.searchsorted(np.cumsum(rows[order]), k)) + 1
    return order[:enough]


def pivot_join(q: DataFrame, v: DataFrame, k: int, query_key: str, vector_key: str, dim: int, metric: str, schema: T.StructType,
               query_block: int | None = None, vector_block: int | None = None, seed: int = 17, report: list | None = None) -> DataFrame:
    """k rows or more for every query of ``q(query_key, _q)`` among ``v(vector_key, _v)``: its nearest ones are among them.

    ``report``, if given, is filled with the number of block pairs there are
    and the number that meet.
    """
    from karst.operators.search import DISTANCE, QUERY_SLICE, blocks_of
    spark = q.sparkSession
    names = (query_key, vector_key)
    query_block = query_block or max(1, BROADCAST_BYTES // (8 * dim))
    vector_block = vector_block or max(1, BROADCAST_BYTES // (8 * dim))
    rows = v.count()
    if not rows:
        return spark.createDataFrame([], schema)
    count = int(min(max(1, PIVOTS_PER_BLOCK * -(-rows // vector_block)), MAX_PIVOTS, max(1, BROADCAST_BYTES // (8 * dim))))
    pivots = _train(v, dim, metric, count, rows, seed)
    shared = spark.sparkContext.broadcast(pivots)
    points, v_blocks = _blocked(_located(v, "_v", dim, metric, shared), vector_key, vector_block, "cells")
    asked, q_blocks = _blocked(_located(q, "_q", dim, metric, shared), query_key, query_block, "queries")
    asked = asked.filter(F.col("cell") != _NOWHERE)
    # one row for a block of BROADCAST_BYTES of vectors, so far below the vectors themselves
    others = np.array(v_blocks, dtype=np.float64)
    between = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0.0)) if len(pivots) * len(pivots) * dim < 1 << 24 \
        else np.sqrt(np.stack([((pivots - p) ** 2).sum(axis=1) for p in pivots]))
    # vectors that are nowhere count for no query
    sizes = np.where(others[:, 1] == _NOWHERE, 0, others[:, 4])
    plan = spark.sparkContext.broadcast((others, sizes, between))
    tile = min(max(1, BROADCAST_BYTES // (8 * dim)), max(TILE_ROWS, rows // TILES))
    across_q, across_v = (max(1, round(tile * len(b) / max(1, sum(x[4] for x in b)))) for b in (q_blocks, v_blocks))
    summary = spark.createDataFrame([b for b in q_blocks if b[1] != _NOWHERE], "_bq int, cell int, lo double, hi double, n long")

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held, apart = plan.value
        for batch in batches:
            out = []
            for number, cell, low, high, _ in zip(*(c.to_pylist() for c in batch.columns)):
                _, upper = block_bounds(cell, low, high, blocks, apart)
                out += [(number, int(blocks[j, 0])) for j in home_blocks(upper, held, k)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in zip(*out)] if out else [pa.array([], pa.int32())] * 2, ["_bq", "_bv"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks that may hold something nearer than ``reach``; homes have been visited."""
        blocks, held, apart = plan.value
        for batch in batches:
            out = []
            for number, cell, low, high, _, reach in zip(*(c.to_pylist() for c in batch.columns)):
                least, upper = block_bounds(cell, low, high, blocks, apart)
                home = set(home_blocks(upper, held, k).tolist())
                limit = np.inf if reach is None else float(_chord(np.float64(reach), metric)) * (1 + SLACK) + SLACK
                out += [(number, int(blocks[j, 0])) for j in np.flatnonzero(least <= limit) if j not in home]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in zip(*out)] if out else [pa.array([], pa.int32())] * 2, ["_bq", "_bv"])

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        parts = [pa.table({query_key: pa.array([], a.schema.field(query_key).type), vector_key: pa.array([], b.schema.field(vector_key).type),
                           DISTANCE: pa.array([], pa.float32())})]
        if a.num_rows and b.num_rows:
            blocks, _, apart = plan.value
            seeds = a["_seed"].to_numpy().astype(np.float64) if a["_seed"].null_count == 0 else \
                np.nan_to_num(a["_seed"].to_numpy().astype(np.float64), nan=np.inf)
            one = blocks[blocks[:, 0] == b["_bv"][0].as_py()]
            gap, cell = a["gap"].to_numpy(), a["cell"].to_numpy()
            near = np.ones(a.num_rows, dtype=bool)
            if one[0, 1] != _NOWHERE:
                d = apart[cell, int(one[0, 1])]
                least = np.maximum.reduce([np.zeros(len(d)), d - gap - one[0, 3], one[0, 2] - gap - d, gap - one[0, 3] - d])
                near = least - SLACK * (d + gap + one[0, 3]) <= _chord(seeds, metric) * (1 + SLACK) + SLACK
            a, seeds = a.filter(pa.array(near)), seeds[near]
            targets, _ = kernels.matrix(a["_q"], dim)
            found, _ = kernels.matrix(b["_v"], dim)
            keys, found = kernels.without_surplus_copies(b[vector_key].combine_chunks(), found, k)
            for block in blocks_of(a[query_key].combine_chunks(), targets, metric, k, names, seeds) if len(targets) else ():
                block.add(keys, found)
                parts.append(block.result())
        return pa.concat_tables([p for p in parts if p is not None])

    def meet_tile(a: pa.Table, b: pa.Table) -> pa.Table:
        """The queries of a tile with its vectors, one vector block after the other; every block narrows the k-th distances."""
        empty = pa.table({query_key: pa.array([], a.schema.field(query_key).type), vector_key: pa.array([], b.schema.field(vector_key).type),
                          DISTANCE: pa.array([], pa.float32())})
        if not a.num_rows or not b.num_rows:
            return empty
        blocks, _, apart = plan.value
        targets, _ = kernels.matrix(a["_q"], dim)
        found, _ = kernels.matrix(b["_v"], dim)
        seeds = np.nan_to_num(a["_seed"].fill_null(np.inf).to_numpy().astype(np.float64), nan=np.inf)
        gap, cell, of = a["gap"].to_numpy(), a["cell"].to_numpy(), a["_bq"].to_numpy()
        keys, owner = b[vector_key].combine_chunks(), b["_block"].to_numpy()
        order = np.argsort(owner, kind="stable")
        pieces = [(int(owner[p[0]]), p) for p in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)]
        pieces = [(blocks[np.searchsorted(blocks[:, 0], number)], *kernels.without_surplus_copies(keys.take(pa.array(p)), found[p], k))
                  for number, p in pieces]
        parts = [empty]
        for own in np.split(np.argsort(of, kind="stable"), np.flatnonzero(np.diff(np.sort(of, kind="stable"))) + 1):
            ids = a[query_key].combine_chunks().take(pa.array(own))
            for lo in range(0, len(own), QUERY_SLICE):
                at = own[lo:lo + QUERY_SLICE]
                block, = blocks_of(ids.slice(lo, len(at)), targets[at], metric, k, names, seeds[at])
                for one, numbers, vectors in pieces:
                    near = np.ones(len(at), dtype=bool)
                    if one[1] != _NOWHERE:
                        d = apart[cell[at], int(one[1])]
                        least = np.maximum.reduce([np.zeros(len(d)), d - gap[at] - one[3], one[2] - gap[at] - d, gap[at] - one[3] - d])
                        near = least - SLACK * (d + gap[at] + one[3]) <= _chord(block.edges, metric) * (1 + SLACK) + SLACK
                    if near.any():
                        block.add(numbers, vectors)
                parts.append(block.result())
        return pa.concat_tables([p for p in parts if p is not None])

    def tiled(queries: DataFrame, pairs: DataFrame) -> DataFrame:
        """``pairs`` by tiles of several blocks each way, so that a row is sent to tiles and not to every block it meets."""
        tiles = pairs.select(F.floor(F.col("_bq") / across_q).cast("int").alias("_tq"),
                             F.floor(F.col("_bv") / across_v).cast("int").alias("_tv")).distinct()
        left = queries.withColumnRenamed("_block", "_bq").withColumn("_tq", F.floor(F.col("_bq") / across_q).cast("int")).join(tiles, "_tq")
        right = points.select(quoted(vector_key), "_v", "_block", F.floor(F.col("_block") / across_v).cast("int").alias("_tv")).join(tiles, "_tv")
        return left.groupBy("_tq", "_tv").cogroup(right.groupBy("_tq", "_tv")).applyInArrow(meet_tile, schema)

    def joined(queries: DataFrame, pairs: DataFrame) -> DataFrame:
        left = queries.withColumnRenamed("_block", "_bq").join(pairs, "_bq")
        right = points.select(quoted(vector_key), "_v", F.col("_block").alias("_bv")).join(pairs, "_bv")
        return left.groupBy("_bq", "_bv").cogroup(right.groupBy("_bq", "_bv")).applyInArrow(meet, schema)

    home = materialise(summary.mapInArrow(homes, "_bq int, _bv int"), "homes")
    first = materialise(joined(asked.withColumn("_seed", F.lit(None).cast("float")), home), "home-neighbours")
    # the k-th distance at home; a query with fewer neighbours there has none yet
    key: Column = F.col(quoted(query_key))
    reached = first.groupBy(key.alias("_key")).agg(F.sort_array(F.collect_list(DISTANCE)).alias("_d")).select(
        "_key", F.get("_d", F.lit(k - 1)).alias("_seed"))
    seeded = materialise(asked.join(reached, key.eqNullSafe(F.col("_key")), "left").drop("_key"), "seeded")
    reach = seeded.groupBy(F.col("_block").alias("_bq")).agg(
        F.when(F.count_if(F.col("_seed").isNull()) == 0, F.max("_seed")).cast("double").alias("reach"))
    pairs = materialise(summary.join(reach, "_bq").mapInArrow(visits, "_bq int, _bv int"), "visits")
    if report is not None:
        report += [len(v_blocks) * summary.count(), home.count() + pairs.count()]
    # a tile may hold home blocks as well; it meets all of its blocks, so those that have met would come twice
    return tiled(seeded, pairs.union(home))
