"""Trained centres and quantisers, as the tasks use them.

Kept apart from the code that trains them, so that a worker which only encodes
or decodes loads nothing but numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from karst.functions import kernels

MAX_DIRECTORIES = 1024
CODE_WORDS = 256


@dataclass
class Cells:
    """Trained centres.  Cosine indexes cluster unit vectors."""

    centres: np.ndarray
    metric: str
    shares: list[float]

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    @property
    def width(self) -> int:
        """Cells per directory of the layout."""
        return -(-len(self.centres) // MAX_DIRECTORIES)

    def prepare(self, vectors: np.ndarray) -> np.ndarray:
        return unit_rows(vectors) if self.metric == "cosine" else vectors

    def probe(self, query: np.ndarray, nprobes: int | None) -> list[int]:
        """The cells closest to the query."""
        if len(query) != self.dim:
            raise ValueError(f"the query has {len(query)} values, the index has vectors of {self.dim}")
        count = len(self.centres) if nprobes is None else max(1, min(nprobes, len(self.centres)))
        scores = kernels.distances(self.centres, self.prepare(query[None, :])[0],
                                   "dot" if self.metric == "dot" else "l2")
        return sorted(int(i) for i in np.argsort(scores, kind="stable")[:count])


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]
    return np.divide(wide, norms, out=np.zeros_like(wide), where=norms > 0).astype(np.float32)


@dataclass
class ProductCodes:
    """Code books by sub-vector for each group of cells; codes describe the residual to the cell centre."""

    books: np.ndarray                    # (groups, sub-vectors, words, width)
    group: np.ndarray | None = None      # group of every cell; without it there is one

    def __post_init__(self):
        if self.books.ndim == 3:
            self.books = self.books[None]

    @property
    def size(self) -> int:
        """Bytes of a code."""
        return self.books.shape[1]

    def groups(self, cell: np.ndarray) -> np.ndarray:
        return np.zeros(len(cell), np.int64) if self.group is None else self.group[cell]

    def encode(self, cells: Cells, vectors: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = cells.prepare(vectors).astype(np.float64) - cells.centres[cell]
        _, subs, _, width = self.books.shape
        out = np.empty((len(vectors), subs), np.uint8)
        group = self.groups(cell)
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            for s in range(subs):
                out[rows, s] = kernels.nearest_rows(self.books[g, s], rest[rows, s * width:(s + 1) * width])
        return out

    def decode(self, cells: Cells, codes: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = self.books[self.groups(cell)[:, None], np.arange(self.size)[None, :], codes].reshape(len(codes), -1)
        return cells.centres[cell].astype(np.float64) + rest

    def approximate(self, cells: Cells, query: np.ndarray, codes: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Distances from lookup tables, one table per distinct cell in the batch."""
        _, subs, _, width = self.books.shape
        target = cells.prepare(query[None, :])[0].astype(np.float64)
        values = np.empty(len(codes))
        for c in np.unique(cell):
            rows = np.flatnonzero(cell == c)
            books = self.books[self.groups(np.array([c]))[0]].astype(np.float64)
            centre = cells.centres[c].astype(np.float64)
            if cells.metric == "dot":
                table = np.einsum("swd,sd->sw", books, target.reshape(subs, width))
                values[rows] = 1.0 - target @ centre - table[np.arange(subs), codes[rows]].sum(1)
            else:
                gap = (target - centre).reshape(subs, 1, width) - books
                table = np.einsum("swd,swd->sw", gap, gap)
                square = table[np.arange(subs), codes[rows]].sum(1)
                values[rows] = square / 2.0 if cells.metric == "cosine" else np.sqrt(square)
        return values


@dataclass
class ScalarCodes:
    """Eight bits per dimension between the smallest and largest value seen."""

    low: np.ndarray
    step: np.ndarray

    @property
    def size(self) -> int:
        """Bytes of a code."""
        return len(self.low)

    def encode(self, cells: Cells, vectors: np.ndarray, cell: np.ndarray) -> np.ndarray:
        scaled = (cells.prepare(vectors).astype(np.float64) - self.low) / self.step
        return np.clip(np.rint(scaled), 0, 255).astype(np.uint8)

    def decode(self, cells: Cells, codes: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return codes.astype(np.float64) * self.step + self.low

    def approximate(self, cells: Cells, query: np.ndarray, codes: np.ndarray, cell: np.ndarray) -> np.ndarray:
        decoded = self.decode(cells, codes, cell)
        return kernels.distances(decoded, cells.prepare(query[None, :])[0], cells.metric)
