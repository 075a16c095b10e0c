"""Suffix arrays by induced sorting, with numpy doing a whole bucket at a time.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour.  The leftmost smaller ones (LMS) are sorted, and the others follow:
a pass over the buckets in ascending order puts the L suffixes in place, a
pass in descending order the S suffixes.  Inside a bucket only suffixes that
begin with a run of its own symbol depend on one another; they come in waves,
one for each repeat of the symbol, so a pass takes a few array operations per
bucket and time linear in the text.
"""

from __future__ import annotations

import numpy as np

from karst.llm.kernels import mix, powers


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last one is."""
    size = len(text)
    change = np.append(np.flatnonzero(text[:-1] != text[1:]), size - 1)
    change = change.astype(np.int32)
    # the last place of each run of one symbol, for all its places
    at = np.repeat(change, np.diff(change, prepend=np.int32(-1)))
    after = np.minimum(at + 1, size - 1)
    smaller = text[at] < text[after]
    smaller[at == size - 1] = True
    return smaller


def _deal(buckets: list[list[np.ndarray]], entries: np.ndarray, symbols: np.ndarray) -> None:
    """Append ``entries`` to the buckets of their symbols, keeping their order."""
    order = np.argsort(symbols, kind="stable")
    entries, symbols = entries[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    for symbol, part in zip(symbols[np.concatenate([[0], cuts])], np.split(entries, cuts)):
        buckets[symbol].append(part)


def induce(text: np.ndarray, smaller: np.ndarray, sorted_lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from the leftmost smaller ones in order."""
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _deal(seeds, sorted_lms, text[sorted_lms])
    rising: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    falling: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def before(entries: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        entries = entries[entries > 0] - 1
        entries = entries[smaller[entries] == kind]
        return entries, text[entries]

    def sweep(buckets: list[list[np.ndarray]], kind: bool, seeds_of, order) -> None:
        for symbol in order:
            done, waiting = [], buckets[symbol]
            while waiting:
                wave = np.concatenate(waiting)
                done.append(wave)
                waiting = []
                entries, heads = before(wave, kind)
                own = heads == symbol
                if own.any():
                    waiting = [entries[own]]
                    entries, heads = entries[~own], heads[~own]
                if len(entries):
                    _deal(buckets, entries, heads)
            buckets[symbol] = done
            for part in seeds_of(symbol):
                entries, heads = before(part, kind)
                if len(entries):
                    _deal(buckets, entries, heads)

    sweep(rising, False, lambda s: seeds[s], range(symbols))
    # descending: lists grow from a bucket's end, larger suffixes of the bucket come last
    falling[0] = [np.array([len(text) - 1], dtype=sorted_lms.dtype)]
    sweep(falling, True, lambda s: [p[::-1] for p in reversed(rising[s])], range(symbols - 1, -1, -1))
    out = []
    for symbol in range(symbols):
        out += rising[symbol] + [p[::-1] for p in reversed(falling[symbol])]
    return np.concatenate(out)


def _prefix_sums(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(mix(text.astype(np.uint64) + np.uint64(7)) * up[:-1], out=sums[1:])
    return sums, down


def _rank_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names``, numbers without gaps, by their first ``depth`` names at least.

    A level of names has almost as many symbols as places, where passes over
    buckets give numpy nothing to do at once; ranks of doubled length are
    sorted instead.
    """
    rank, reach, order = names.astype(np.int64), 1, None
    while reach < depth and rank.max() + 1 < len(rank):
        follow = np.zeros(len(rank), dtype=np.int64)
        follow[:-reach] = rank[reach:] + 1
        pair = rank * (len(rank) + 2) + follow
        order = np.argsort(pair)
        step = np.concatenate([[False], pair[order][1:] != pair[order][:-1]])
        rank[order] = np.cumsum(step)
        reach *= 2
    return np.argsort(rank) if order is None else order


def suffix_array(text: np.ndarray, symbols: int, depth: int | None = None) -> np.ndarray:
    """Suffixes of ``text`` in order; its last symbol must be 0 and occur nowhere else.

    With ``depth``, suffixes that agree in so many symbols may stand in any order.
    """
    if len(text) < 2:
        return np.arange(len(text))
    smaller = classify(text)
    # places of 32 bits: a shard is far below 2 GB
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    ordered = induce(text, smaller, lms, symbols)
    mark = np.zeros(len(text), dtype=bool)
    mark[lms] = True
    ordered = ordered[mark[ordered]]
    # name the sorted substrings, equal ones alike; each reaches to the next leftmost smaller suffix
    place = np.empty(len(text), dtype=np.int32)
    place[lms] = np.arange(len(lms), dtype=np.int32)
    end = np.append(lms[1:] + 1, len(text))
    sums, down = _prefix_sums(text)
    content = mix((sums[end] - sums[lms]) * down[lms] + (end - lms).astype(np.uint64))
    del sums
    own = content[place[ordered]]
    names = np.empty(len(lms), dtype=np.int64)
    names[place[ordered]] = np.cumsum(np.concatenate([[False], own[1:] != own[:-1]]))
    if len(lms) and names.max() + 1 < len(lms):
        # leftmost smaller suffixes are two places apart at least
        ordered = lms[_rank_names(names, len(lms) if depth is None else depth // 2 + 1)]
    return induce(text, smaller, ordered, symbols)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the suffix before it in ``order`` and their common prefix up to ``longest``."""
    size = len(text)
    ahead = np.full(size, -1, dtype=np.int32)
    ahead[order[1:]] = order[:-1]
    sums, down = _prefix_sums(text)

    def same(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
        return (sums[left + step] - sums[left]) * down[left] == (sums[right + step] - sums[right]) * down[right]

    # places that share the whole length need no search
    common = np.zeros(size, dtype=np.int32)
    here = np.flatnonzero((ahead >= 0) & (np.maximum(ahead, np.arange(size, dtype=np.int32)) + longest <= size)).astype(np.int32)
    common[here[same(here, ahead[here], longest)]] = longest
    here = np.flatnonzero((ahead >= 0) & (common < longest)).astype(np.int32)
    there, found = ahead[here], np.zeros(len(here), dtype=np.int32)
    step = 1 << (max(1, longest).bit_length() - 1)
    while step:
        left, right = here + found, there + found
        fits = np.flatnonzero((np.maximum(left, right) + step <= size) & (found + step <= longest))
        found[fits[same(left[fits], right[fits], step)]] += step
        step //= 2
    common[here] = found
    return ahead, common
