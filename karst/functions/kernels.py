"""Numpy forms of the metrics, applied to one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Candidates this close to the k-th distance are kept until they are compared
# at the stored (float) width, so rounding never decides who is in the top k.
SLACK = 4e-7


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a 2-d array, plus the mask of usable rows.

    Null vectors are masked out.  A vector of another length is an error.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        present = np.asarray(column.is_valid())
        rows = [v.as_py() for v in column.drop_null()]
        if any(len(r) != dim for r in rows):
            raise ValueError(f"expected binary vectors of {dim} bytes")
        return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, dim), present
    present = np.asarray(column.is_valid())
    flat = column.drop_null().flatten()
    if flat.null_count:
        raise ValueError("vectors cannot contain null elements")
    values = flat.to_numpy(zero_copy_only=False)
    count = int(present.sum())
    lengths = np.asarray(column.drop_null().value_lengths())
    if count and (lengths != dim).any():
        raise ValueError(f"expected vectors of dimension {dim}")
    return values.reshape(count, dim), present


def distances(vectors: np.ndarray, query: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row to one query, or row by row to as many queries.

    Double precision, NaN where undefined.  Rows are summed one by one in a
    fixed order, so equal vectors get equal distances wherever they are stored.
    """
    if metric == "hamming":
        # numpy counts the bits of a signed number's absolute value
        differing = np.bitwise_xor(vectors, query.astype(vectors.dtype))
        differing = differing.view(differing.dtype.str.replace("i", "u"))
        return np.bitwise_count(differing).sum(1).astype(np.float64)
    wide = vectors.astype(np.float64)
    target = np.broadcast_to(query.astype(np.float64), wide.shape)
    if metric == "l2":
        wide -= target
        return np.sqrt(np.einsum("ij,ij->i", wide, wide))
    dots = np.einsum("ij,ij->i", wide, target)
    if metric == "dot":
        return 1.0 - dots
    norms = np.sqrt(np.einsum("ij,ij->i", wide, wide)) * np.sqrt(np.einsum("ij,ij->i", target, target))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms > 0, 1.0 - dots / norms, np.nan)


def distances_many(vectors: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """(queries x vectors) distances from one matrix product.

    Good for choosing candidates within ``distance_bounds``; the winners are recomputed with ``distances``.
    """
    if metric == "hamming":
        return np.stack([distances(vectors, q, metric) for q in queries]) if len(queries) else \
            np.empty((0, len(vectors)))
    wide, targets = vectors.astype(np.float64), queries.astype(np.float64)
    dots = targets @ wide.T
    if metric == "dot":
        return 1.0 - dots
    own = np.einsum("ij,ij->i", wide, wide)
    other = np.einsum("ij,ij->i", targets, targets)
    if metric == "l2":
        return np.sqrt(np.maximum(own[None, :] + other[:, None] - 2.0 * dots, 0.0))
    norms = np.sqrt(own)[None, :] * np.sqrt(other)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms > 0, 1.0 - dots / norms, np.nan)


def candidates(values: np.ndarray, k: int, slack: float = SLACK) -> np.ndarray:
    """Positions that can be among the k smallest, with every near tie at the edge."""
    usable = np.flatnonzero(~np.isnan(values))
    if len(usable) <= k:
        return usable
    edge = np.partition(values[usable], k - 1)[k - 1]
    return usable[values[usable] <= edge + slack * max(1.0, abs(edge))]


def distance_bounds(rough: np.ndarray, vectors: np.ndarray, queries: np.ndarray,
                    metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance that each entry of ``distances_many`` can stand for.

    A product of long, nearly equal vectors loses the digits of their small
    difference, so the error grows with the squared norms, not with the distance.
    """
    if metric == "hamming":
        return rough, rough
    unit = (vectors.shape[1] + 8) * np.finfo(np.float64).eps
    if metric == "cosine":
        return rough - 4 * unit, rough + 4 * unit
    wide, targets = vectors.astype(np.float64), queries.astype(np.float64)
    error = unit * (np.einsum("ij,ij->i", wide, wide)[None, :] + np.einsum("ij,ij->i", targets, targets)[:, None])
    if metric == "dot":
        return rough - error - unit, rough + error + unit
    return np.sqrt(np.maximum(rough * rough - error, 0.0)), np.sqrt(rough * rough + error)


def candidate_pairs(low: np.ndarray, high: np.ndarray, k: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) pairs that can be among the k smallest of their row, by the bounds of their distances.

    ``edges`` is the k-th distance each row has reached so far (infinite at
    first); near ties at the edge are kept.
    """
    bound = edges
    if high.shape[1] > k:
        own = np.where(np.isnan(high), np.inf, high)
        bound = np.minimum(bound, np.partition(own, k - 1, axis=1)[:, k - 1]) if np.isinf(edges).any() else edges
    bound = np.where(np.isinf(bound), np.inf, bound + SLACK * np.maximum(1.0, np.abs(bound)))
    return np.nonzero(low <= bound[:, None])


def near_pairs(vectors: np.ndarray, queries: np.ndarray, metric: str, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(query, vector) pairs within finite ``edges``, near ties included, from one single-precision product.

    ``dots >= own / 2 + other / 2 - edge^2 / 2`` is the l2 distance squared
    within the edge, with a margin for the rounding of the product.  None where
    single precision has no room for the values, or the metric has no such form.
    """
    if metric not in ("l2", "cosine") or not np.isfinite(edges).all():
        return None
    wide, targets = vectors.astype(np.float64), queries.astype(np.float64)
    own, other = np.einsum("ij,ij->i", wide, wide), np.einsum("ij,ij->i", targets, targets)
    if not (np.isfinite(own).all() and np.isfinite(other).all()):
        return None
    unit = 4 * (vectors.shape[1] + 8) * float(np.finfo(np.float32).eps)
    bound = edges + SLACK * np.maximum(1.0, np.abs(edges))
    if metric == "cosine":
        some, asked = own > 0, other > 0
        wide[some] /= np.sqrt(own[some])[:, None]
        targets[asked] /= np.sqrt(other[asked])[:, None]
        least = np.where(asked, 1.0 - bound - unit, np.inf)
        line, pick = _set_places(targets.astype(np.float32) @ wide.astype(np.float32).T >= least.astype(np.float32)[:, None])
        kept = some[pick]
        return line[kept], pick[kept]
    most = max(own.max(initial=0.0), other.max(initial=0.0), float((bound * bound).max(initial=0.0)))
    if not 1e-20 < most < 1e30:
        return None
    # the bound is one more value of every row, so the comparison is with zero
    left = np.concatenate([targets, np.full((len(targets), 1), -1.0), (bound * bound - other)[:, None] / 2 + unit * other[:, None]], axis=1)
    right = np.concatenate([wide, (own * (0.5 - unit))[:, None], np.ones((len(wide), 1))], axis=1)
    margin = unit * float((bound * bound).max(initial=0.0))
    return _set_places(left.astype(np.float32) @ right.astype(np.float32).T >= np.float32(-margin))


def _set_places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero`` of a matrix with few set places."""
    return np.divmod(np.flatnonzero(mask), max(mask.shape[1], 1))


def nearest_rows(centres: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Index of the closest centre (squared Euclidean) for every row."""
    scores = vectors.astype(np.float64) @ (-2.0 * centres.astype(np.float64).T)
    scores += np.einsum("ij,ij->i", centres, centres)[None, :]
    return scores.argmin(1)


def without_surplus_copies(ids: pa.Array, vectors: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
    """Drop copies of a vector beyond the k with the smallest ids.

    Copies have the same distance to every query and ties go to the smaller
    id, so the dropped rows cannot be among anyone's k nearest.
    """
    if len(vectors) <= k:
        return ids, vectors
    rows = np.ascontiguousarray(vectors)
    raw = rows.view(np.uint8).reshape(len(rows), -1)
    words = raw.view(np.uint64) if raw.shape[1] % 8 == 0 else raw.astype(np.uint64)
    weights = np.random.default_rng(0).integers(1, 1 << 62, words.shape[1], dtype=np.uint64) | np.uint64(1)
    sums = (words * weights).sum(1)
    if np.unique(sums, return_counts=True)[1].max() <= k:
        return ids, vectors           # no sum is that frequent, so no vector is
    _, group = np.unique(raw.view(np.dtype((np.void, raw.shape[1]))).ravel(), return_inverse=True)
    order = pc.sort_indices(pa.table({"g": pa.array(group.ravel()), "id": ids}),
                            sort_keys=[("g", "ascending"), ("id", "ascending")]).to_numpy()
    ordered = group.ravel()[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    rank = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    keep = np.sort(order[rank < k])
    return ids.take(pa.array(keep)), vectors[keep]
