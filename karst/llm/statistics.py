"""Statistics of documents: the base quality counts, and features for a classifier."""

from __future__ import annotations

import numpy as np

from karst.llm import kernels as K

SYMBOLS = b"#*$%&|<>"

FEATURES = ("log_words", "mean_word", "longest_word", "symbols", "capitals", "digits", "stops", "bangs", "bars",
            "other_bytes", "line_words", "distinct_words", "repeat_words", "repeat_lines", "capital_starts",
            "single_chars", "symbol_words", "commas", "stop_ends", "long_words")


def _member(data: np.ndarray, chosen: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chosen)] = True
    return table[data]


class Counts:
    """Counts over the documents of one chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends, self.bounds = K.words(data, offsets)
        self.n_words = np.diff(self.bounds)
        self.owner = np.repeat(np.arange(len(offsets) - 1), self.n_words)
        self.hashes = K.span_hashes(data, self.starts, self.ends)
        inside = (data & 0xC0) != 0x80
        self.points = K.count_in(inside, np.stack([self.starts, self.ends], 1).ravel())[::2] if len(self.starts) else \
            np.zeros(0, np.int64)
        self.word_chars = K.count_in(inside & ~K.spaces(data), offsets)
        self.n_symbols = K.count_in(_member(data, SYMBOLS), offsets)
        self.line_starts, self.line_ends, self.line_bounds = K.lines(data, offsets)
        self.line_words = np.searchsorted(self.starts, self.line_ends) - np.searchsorted(self.starts, self.line_starts)
        line_owner = np.repeat(np.arange(len(offsets) - 1), np.diff(self.line_bounds))
        filled = np.flatnonzero(self.line_words)
        _, head = K.repeats_within(K.span_hashes(data, self.line_starts[filled], self.line_ends[filled]), line_owner[filled])
        again = np.zeros(len(self.line_words), dtype=bool)
        again[filled] = ~head
        self.n_dup_lines = K.count_in(again, self.line_bounds)
        self.n_lines = K.count_in(self.line_words > 0, self.line_bounds)
        grams, edges = K.windows(self.hashes, self.bounds, 3)
        counts, _ = K.repeats_within(grams, np.repeat(np.arange(len(offsets) - 1), np.diff(edges)))
        at = np.arange(len(grams)) + np.repeat(self.bounds[:-1] - edges[:-1], np.diff(edges))
        hit = np.zeros(len(self.starts) + 2, dtype=bool)
        for step in range(3):
            hit[at[counts > 1] + step] = True
        self.n_repeat_words = K.count_in(hit[:len(self.starts)], self.bounds)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` per document; an empty one gives zeros only."""
    c = Counts(data, offsets)
    words = np.maximum(c.n_words, 1)
    size = np.maximum(np.diff(offsets), 1)
    upper = (data >= 65) & (data <= 90)
    per_word = lambda mask: K.count_in(mask, c.bounds) / words
    first, last = data[c.starts], data[np.maximum(c.ends - 1, 0)]
    _, head = K.repeats_within(c.hashes, c.owner)
    longest = np.zeros(len(offsets) - 1)
    filled = np.flatnonzero(c.n_words)
    if len(filled):
        longest[filled] = np.maximum.reduceat(c.points, c.bounds[filled])
    symbols = np.concatenate([[0], np.cumsum(_member(data, SYMBOLS), dtype=np.int64)])
    columns = [
        np.log1p(c.n_words), c.word_chars / words, np.log1p(longest), c.n_symbols / words,
        K.count_in(upper, offsets) / size, K.count_in((data >= 48) & (data <= 57), offsets) / size,
        K.count_in(_member(data, b".?!"), offsets) / words, K.count_in(data == 33, offsets) / words,
        K.count_in(data == 124, offsets) / words, K.count_in(data >= 128, offsets) / size,
        np.log1p(c.n_words / np.maximum(c.n_lines, 1)), K.count_in(head, c.bounds) / words, c.n_repeat_words / words,
        c.n_dup_lines / np.maximum(c.n_lines, 1), per_word((first >= 65) & (first <= 90)), per_word(c.points == 1),
        per_word(symbols[c.ends] > symbols[c.starts]), K.count_in(data == 44, offsets) / words,
        per_word(_member(last, b".?!")), per_word(c.points > 12)]
    return np.where(c.n_words[:, None] > 0, np.stack(columns, axis=1), 0.0)
