"""Exact top-k by inner product: branch and bound over dimension blocks in a vertical layout."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from karst.session import materialise, ship

#: rows of one side that meet in a task
QUERY_BLOCK, ROW_BLOCK = 1024, 16_384
#: rows scored at once, and dimensions accumulated between two looks at the bounds
STRIP, STEP = 2048, 8
_RESULT = "query_id bigint, vec_id bigint, score bigint"
#: sums below this are exact in doubles
_EXACT = float(1 << 53)


def _vertical(vectors: pd.Series) -> np.ndarray:
    """One row per dimension."""
    return np.ascontiguousarray(np.stack(vectors.to_numpy()).T) if len(vectors) else np.zeros((0, 0))


def _rest(columns: np.ndarray) -> np.ndarray:
    """Norm of what is left of each vector from every dimension block on, rounded up."""
    size = -(-len(columns) // STEP)
    out = np.zeros((size + 1, columns.shape[1]))
    for block in range(size - 1, -1, -1):
        part = columns[block * STEP:(block + 1) * STEP]
        out[block] = out[block + 1] + np.einsum("ij,ij->j", part, part)
    return np.sqrt(out) * (1 + 1e-9)


class _Best:
    """The k best rows of each query so far; equal scores keep the smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries
        self.floor = np.full(queries, -np.inf)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[query], scores]), np.concatenate([self.ids[query], ids])
        if len(scores) > self.k:
            # everything that ties with the k-th stays until the ids decide
            edge = -np.partition(-scores, self.k - 1)[self.k - 1]
            keep = scores >= edge
            scores, ids = scores[keep], ids[keep]
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]
        if len(order) == self.k:
            self.floor[query] = self.scores[query][-1]


def block_best(query_ids: np.ndarray, queries: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """The k best ``rows`` of each of ``queries`` (both one column per vector, whole numbers as doubles).

    A strip of rows is scored dimension block by dimension block.  After each,
    a pair survives if its partial score plus the product of both remaining
    norms reaches the query's k-th score; survivors are compacted to a pair
    list once they are few, and only they are carried on.
    """
    best = _Best(queries.shape[1], k)
    left = _rest(queries)
    order = np.argsort(-_rest(rows)[0], kind="stable") if len(rows) else np.arange(len(row_ids))
    exact = len(rows) * np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) < _EXACT
    for at in range(0, len(row_ids), STRIP):
        # rows with large norms first: floors rise early
        chosen = order[at:at + STRIP]
        strip, ids = rows[:, chosen], row_ids[chosen]
        if not exact:
            scores = queries.astype(np.int64).T @ strip.astype(np.int64)
            for q in range(queries.shape[1]):
                other = ids != query_ids[q]
                best.add(q, scores[q][other], ids[other])
            continue
        rest = _rest(strip)
        partial = np.zeros((queries.shape[1], len(ids)))
        pairs = None
        for block in range(-(-len(rows) // STEP)):
            dims = slice(block * STEP, (block + 1) * STEP)
            if pairs is None:
                partial += queries[dims].T @ strip[dims]
                alive = partial + left[block + 1][:, None] * rest[block + 1] >= best.floor[:, None]
                if np.count_nonzero(alive) * 8 < alive.size:
                    q, r = np.nonzero(alive)
                    pairs, sums = (q, r), partial[q, r]
            else:
                q, r = pairs
                sums = sums + np.einsum("ij,ij->j", queries[dims][:, q], strip[dims][:, r])
                alive = sums + left[block + 1][q] * rest[block + 1][r] >= best.floor[q]
                pairs, sums = (q[alive], r[alive]), sums[alive]
        if pairs is None:
            pairs = np.nonzero(partial >= best.floor[:, None])
            sums = partial[pairs]
        q, r = pairs
        other = ids[r] != query_ids[q]
        q, r, sums = q[other], r[other], sums[other]
        cuts = np.searchsorted(q, np.arange(queries.shape[1] + 1))
        for query in np.unique(q):
            part = slice(cuts[query], cuts[query + 1])
            best.add(query, sums[part].astype(np.int64), ids[r[part]])
    return [(query_ids[q], i, s) for q in range(queries.shape[1]) for i, s in zip(best.ids[q], best.scores[q])]


def _meet(k: int, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    if not len(queries) or not len(rows):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    found = block_best(queries["vec_id"].to_numpy(np.int64), _vertical(queries["v"]), rows["vec_id"].to_numpy(np.int64),
                       _vertical(rows["v"]), k)
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows of largest inner product for each query, without its own id.

    Both tables have ``vec_id`` and ``v``, an array<double> of whole numbers.
    Both are cut into blocks by hash, and every pair of blocks is one task's
    work; a block of rows is repeated once per block of queries and the other
    way round, whose number follows from counts.  Only vectors of equal length
    meet.  Ties go to the smaller vec_id.

    Null ids, null vectors, null or non-finite components and empty vectors
    take no part.  A row stored several times counts as often; a query id
    stored several times searches once, with its smallest vector.  Fewer than
    k candidates give all, and an empty side gives no rows.  Scores are exact
    while they fit 64 bits.  Other columns are ignored.
    """
    ship(rows.sparkSession)
    usable = ("vec_id is not null and size(v) > 0 and "
              "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("v").cast("array<double>").alias("v")).filter(usable)
    queries = queries.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    queries = queries.filter(usable).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = max(24, math.ceil(n_rows / ROW_BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))
    hashed = F.xxhash64("vec_id")
    left = queries.select(F.size("v").alias("dims"), F.pmod(hashed, F.lit(query_blocks)).cast("int").alias("qb"), "vec_id", "v",
                          F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    # rows that share an id are spread too
    right = rows.select(F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
                        "vec_id", "v", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()),
                                              F.lit(row_blocks)).cast("int").alias("rb"))
    keys = ["dims", "qb", "rb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda q, r: _meet(k, q, r), _RESULT)
    found = materialise(found, "block-best")
    ranked = found.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(vectors: DataFrame, factor: float = 64.0) -> DataFrame:
    """``(vec_id, v)`` with every component x as floor(factor * x), x as double."""
    whole = F.transform(F.col("embedding").cast("array<double>"),
                        lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(
                            F.floor(F.lit(factor) * x).cast("double")))
    return vectors.select("vec_id", whole.alias("v"))
