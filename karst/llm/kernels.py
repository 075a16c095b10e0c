"""Vectorised text kernels: words, hashes and shingles of many documents at once.

They take Arrow columns inside tasks.  All documents of a chunk are handled by
the same numpy calls, so nothing loops over words.  A word is a maximal run of
characters outside U+0020 and U+0009 to U+000D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
SHINGLE_WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# odd 64-bit multipliers, one for each place in a window of words
_PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                    0xE7037ED1A0B428DB], dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers.get("up", ())) < count:
        size = max(count, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, factor in (("up", _BASE), ("down", inverse)):
            table = np.full(size, factor, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:count], _powers["down"][:count]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``limit`` bytes: first, end, bytes, offsets."""
    first = 0
    while first < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(offsets) - 1)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each document's words begin."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~spaces(data)
    cut = np.zeros(size + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:size]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | cut[1:size]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit content hashes of the given byte spans."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and where each document's begin.

    A document with fewer words, but at least one, has its whole word sequence
    as its only window; one without words has none.
    """
    counts = np.diff(bounds)
    sizes = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    # the word at which each window begins
    at = np.arange(edges[-1]) + np.repeat(bounds[:-1] - edges[:-1], sizes)
    room = np.repeat(np.minimum(counts, width), sizes)
    total = room.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for place in range(width):
        factor = _PLACES[place % 5] + np.uint64(2 * (place // 5))
        if len(at):
            word = hashes[np.minimum(at + place, len(hashes) - 1)]
            total += np.where(place < room, word * factor, np.uint64(0))
    return mix(total), edges


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased word shingles of each document of a chunk, repeats included."""
    data = lower(data)
    starts, ends, bounds = words(data, offsets)
    return windows(span_hashes(data, starts, ends), bounds, width)


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def long_lists(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """An Arrow array<long> column cut from ``values`` at ``edges``."""
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(signed(values)))


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of 64-bit values, by content and order."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((mix(values) | np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the \\n-split lines of each document, and where each document's begin."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    own = np.searchsorted(breaks, offsets)
    bounds = own + np.arange(len(offsets))
    # a line ends before the next line's start: at its \n, or at the document's end
    ends = np.append(starts[1:] - 1, len(data)) if len(starts) else starts
    if len(starts):
        ends[bounds[1:] - 1] = offsets[1:]
    return starts, ends, bounds


def repeats_within(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash, how often its owner has it, and whether it is the first of its kind there."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    key = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, group, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    head = np.zeros(len(hashes), dtype=bool)
    head[first] = True
    return counts[group], head


def count_in(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each document's elements are marked."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
