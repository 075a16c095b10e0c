"""Packing of tokenised documents into fixed windows, best fit decreasing."""

from __future__ import annotations

import math
import os
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.session import materialise, ship

WINDOW, END_ID = 4096, 2
#: pieces packed together by one task
SHARD_PIECES = 20_000
#: distinct words whose ids a task remembers
REMEMBERED = 300_000
#: words encoded by one call, and what stands between them there
ENCODED, MARK = 1000, "\x01"

_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class _Ids:
    """Token ids of words.  The tokenizer never joins across ASCII white space, so words are encoded once."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        mark = self._ids(MARK)
        # the mark has to be an id of its own, or words are encoded one by one
        self.mark = mark[0] if len(mark) == 1 else None
        # a tokenizer that folds case needs one spelling of a word; added tokens are found before it folds
        rule = self.tokenizer.normalizer
        self.folds = rule is not None and rule.normalize_str(string.ascii_uppercase) == string.ascii_lowercase
        added = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(added), re.IGNORECASE) if added else None
        self._forget()

    def _ids(self, text: str) -> np.ndarray:
        encoding = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(encoding.ids, dtype=np.uint32)

    def _forget(self) -> None:
        self.known, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _several(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words on end, and how many each has; one call encodes them, with marks between."""
        own = MARK.encode()
        if self.mark is not None:
            ids = self._ids((b" " + own + b" ").join(words).decode())
            at = np.flatnonzero(ids == self.mark)
            # more of them where words hold the mark themselves
            if len(at) == len(words) - 1:
                return np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
        each = [self._ids(w.decode()) for w in words]
        return np.concatenate(each), np.array([len(i) for i in each], dtype=np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a chunk, and where each document's begin."""
        if self.folds and not (self.special and self.special.search(data)):
            data = K.lower(data)
        starts, ends, bounds = K.words(data, offsets)
        hashes = K.span_hashes(data, starts, ends)
        unique, first, group = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.known, unique)
        missing = np.ones(len(unique), dtype=bool)
        inside = place < len(self.known)
        missing[inside] = self.known[place[inside]] != unique[inside]
        if missing.any():
            raw, chosen = data.tobytes(), first[missing]
            texts = [raw[i:j] for i, j in zip(starts[chosen].tolist(), ends[chosen].tolist())]
            parts = [self._several(texts[at:at + ENCODED]) for at in range(0, len(texts), ENCODED)]
            sizes = np.concatenate([p[1] for p in parts])
            fresh = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(sizes))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, *(p[0] for p in parts)])
            known, at = np.concatenate([self.known, unique[missing]]), np.concatenate([self.at, fresh])
            # two sorted runs
            order = np.argsort(known, kind="stable")
            self.known, self.at = known[order], at[order]
        entry = self.at[np.searchsorted(self.known, unique)][group] if len(unique) else np.zeros(0, np.int64)
        sizes = self.starts[entry + 1] - self.starts[entry]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        source = np.arange(edges[-1]) + np.repeat(self.starts[entry] - edges[:-1], sizes)
        return self.flat[source], edges[bounds]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` ids of every row of ``docs(doc_id, text)``.

    ``tokenizer`` is the text of a tokenizer definition; it goes to the tasks
    with the job, so nothing is read from a task's disk.  A document's ids end
    with ``end_id``, so a null or empty text is one piece of one id.  A very
    long text is cut into full pieces and a rest.  Repeated rows and rows with
    a null doc_id give pieces of their own; an empty table gives none; other
    columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Ids(shared.value)
        for batch in batches:
            data, offsets = K.utf8(batch.column("text"))
            for first, _, part, bounds in K.chunks(data, offsets):
                ids, edges = words.encode(part, bounds)
                doc, start, length, crc, total = [], [], [], [], []
                for i in range(len(edges) - 1):
                    own = np.append(ids[edges[i]:edges[i + 1]], np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(own), window):
                        doc.append(first + i)
                        start.append(at)
                        length.append(min(window, len(own) - at))
                        crc.append(zlib.crc32(own[at:at + window].tobytes()))
                        total.append(len(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(pieces, _PIECE)


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each length, longest first into the tightest window that has room.

    A segment tree over remaining capacities holds how many open windows have
    each; the smallest capacity of at least the length is found by going down.
    """
    size = 1 << window.bit_length()
    tree = [0] * (2 * size)
    open_: list[list[int]] = [[] for _ in range(window + 1)]
    windows, offsets, made = [0] * len(lengths), [0] * len(lengths), 0

    def change(capacity: int, by: int) -> None:
        node = capacity + size
        while node:
            tree[node] += by
            node >>= 1

    def tightest(least: int) -> int:
        node = least + size
        if tree[node]:
            return least
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < size:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - size
            node >>= 1
        return -1

    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tightest(lengths[i])
        if room < 0:
            number, room, made = made, window, made + 1
        else:
            number = open_[room].pop()
            change(room, -1)
        windows[i], offsets[i] = number, window - room
        room -= lengths[i]
        if room:
            open_[room].append(number)
            change(room, 1)
    return windows, offsets


def packed(pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each piece's window and its place there.

    Full pieces are windows of their own.  The others are dealt by hash into
    shards of about ``shard_pieces``; each shard is packed alone and leaves few
    windows open.  Numbers of windows are disjoint, not gapless.  Repeated rows
    are packed each.  ``pieces`` is counted, so it should be a written table.
    """
    shards = max(1, math.ceil(pieces.count() / shard_pieces))
    # copies of a document have equal columns: a row number spreads them, and nothing depends on which copy goes where
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()),
                                              F.lit(shards)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        windows, offsets = best_fit(rows["length"].tolist(), window)
        shard = int(rows["shard"].iloc[0])
        return rows.assign(sequence_id=np.array(windows, dtype="int64") * shards + shard,
                           offset=np.array(offsets, dtype="int64"))[[f.name for f in out]]

    out = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("shard").applyInPandas(pack, out)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Every id of ``docs(doc_id, text)`` in exactly one piece of one window.

    Nulls, empty and very long texts, repeated rows, empty tables and other
    columns are treated as in ``tokenised``; ties of length are packed in the
    order of doc_id and place, as ``packed`` says.
    """
    return packed(materialise(tokenised(docs, tokenizer, end_id, window), "pieces"), window)
