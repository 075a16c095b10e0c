"""Removal of word windows that stand earlier in the corpus, found through difference-cover anchors.

``COVER`` is a difference cover of ``PERIOD``: for any two places in two
documents some shift below ``PERIOD`` takes both to a place whose residue is in
the cover.  So two equal windows of ``WINDOW`` words hold, at the same distance
from their starts, two equal windows of ``ANCHOR = WINDOW - PERIOD + 1`` words
that both start at cover places.  Only those anchors (4 in 13 places) are hashed
and shuffled, and those that stand once are dropped.

An anchor that stands twice is extended: the windows around it are hashed whole
and meet by their hash.  All occurrences of a repeated window hold a repeated
anchor, so the first one in the order of (doc_id, place) is among them, and
every later one is removed.  Both passes settle repeats within a batch before
anything is shuffled, and no pair of occurrences is ever formed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.llm.repeats import _batch, _union
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship

WINDOW = 20
#: residues whose differences are all residues of the period
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: places are (tag of the text) * 2^40 + word number, so that rows that share an id but not the text stay apart
PLACE = 1 << 40

_AT = "key bigint, doc_id bigint, at bigint, times int"


def _windows(part: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all whole windows of a chunk, the document and the word number of each."""
    starts, ends, edges = K.words(part, bounds)
    hashes, own = K.windows(K.span_hashes(part, starts, ends), edges, width)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(own))
    place = np.arange(len(hashes)) - own[doc]
    whole = np.diff(edges)[doc] >= width
    return hashes[whole], doc[whole], place[whole]


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64),
            batch.column("tag").to_numpy(zero_copy_only=False).astype(np.int64) * PLACE)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each document.  times 0: known to be repeated; else how often the batch has it (2: twice or more).

    Of an anchor that a batch holds several times one row is sent to meet the
    others, and the places of all are settled here.
    """
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    for batch in batches:
        ids, tags = _keys(batch)
        data, offsets = K.utf8(batch.column("text"))
        for first, _, part, bounds in K.chunks(data, offsets):
            hashes, doc, place = _windows(part, bounds, ANCHOR)
            chosen = cover[place % PERIOD]
            hashes, doc, place = hashes[chosen], doc[chosen] + first, place[chosen]
            if not len(hashes):
                continue
            _, lead, group, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            at = tags[doc] + place
            yield _batch(_AT, hashes[lead], ids[doc[lead]], at[lead], np.minimum(counts, 2))
            again = counts[group] > 1
            if again.any():
                # dealt by document: they are on their way there already
                yield _batch(_AT, K.mix(ids[doc[again]].astype(np.uint64)), ids[doc[again]], at[again], np.zeros(again.sum(), np.int64))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of anchors that stand twice or more; rows come sorted by key."""
    held = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
        ready = rows[3] == 0
        if ready.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[ready]) for c in rows[1:3]], ["doc_id", "at"])
            rows = [c[~ready] for c in rows]
        if held is not None:
            rows = [np.concatenate([h, c]) for h, c in zip(held, rows)]
        key, doc, at, times = rows
        if not len(key):
            continue
        # a row's neighbours tell whether it is alone; the last row waits for its next one, with what it knows
        same = key[1:] == key[:-1]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        done = several & (times == 1)
        done[-1] = False
        if done.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[done]), pa.array(at[done])], ["doc_id", "at"])
        held = [c[-1:] for c in rows]
        if several[-1] and times[-1] == 1:
            yield pa.RecordBatch.from_arrays([pa.array(doc[-1:]), pa.array(at[-1:])], ["doc_id", "at"])
            held[3] = np.array([2])


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole windows around repeated anchors.  times 0: later than another one of the batch."""
    for batch in batches:
        ids, tags = _keys(batch)
        data, offsets = K.utf8(batch.column("text"))
        spots = batch.column("spots")
        for first, end, part, bounds in K.chunks(data, offsets):
            hashes, doc, place = _windows(part, bounds, WINDOW)
            if not len(hashes):
                continue
            begin = np.searchsorted(doc, np.arange(end - first + 1))
            lists = spots.slice(first, end - first)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(end - first), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            # an anchor at p lies in the windows from p - (WINDOW - ANCHOR) to p
            low = np.minimum(begin[owner] + np.maximum(flat - (WINDOW - ANCHOR), 0), begin[owner + 1])
            high = np.minimum(begin[owner] + flat + 1, begin[owner + 1])
            edge = np.bincount(low, minlength=len(hashes) + 1) - np.bincount(high, minlength=len(hashes) + 1)
            near = np.flatnonzero(np.cumsum(edge)[:len(hashes)] > 0)
            if not len(near):
                continue
            hashes, own = hashes[near], doc[near] + first
            at, doc = tags[own] + place[near], ids[own]
            order = np.lexsort((at, doc, hashes))
            key, doc, at = hashes[order], doc[order], at[order]
            later, copy, _ = _ranked(key, doc, at)
            send = ~later & ~copy
            yield _batch(_AT, key[send], doc[send], at[send], np.ones(send.sum(), np.int64))
            if later.any():
                yield _batch(_AT, K.mix(doc[later].astype(np.uint64)), doc[later], at[later], np.zeros(later.sum(), np.int64))


def _ranked(key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in order of (key, doc, at): which are later than another, which repeat the row before, and their lead.

    A row is later than one of a smaller document, or of its own text at a
    smaller place.  The lead is the first row of the same key, document and text.
    """
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    text = at // PLACE
    own = fresh | np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])])
    index = np.arange(len(key))
    head = np.maximum.accumulate(np.where(fresh, index, 0))
    lead = np.maximum.accumulate(np.where(own, index, 0))
    later = (doc > doc[head]) | (at > at[lead])
    copy = ~own & np.concatenate([[False], at[1:] == at[:-1]])
    return later, copy, lead


def _first_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of windows that are not the first of their kind; rows come sorted by (key, doc_id, at)."""
    held = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
        ready = rows[3] == 0
        if ready.any():
            yield _batch("doc_id bigint, at bigint, size int", rows[1][ready], rows[2][ready], np.full(ready.sum(), WINDOW))
        rows = [c[~ready] for c in rows[:3]]
        known = 0
        if held is not None:
            known = len(held[0])
            rows = [np.concatenate([h, c]) for h, c in zip(held, rows)]
        key, doc, at = rows
        if not len(key):
            continue
        later, _, lead = _ranked(key, doc, at)
        later[:known] = False
        if later.any():
            yield _batch("doc_id bigint, at bigint, size int", doc[later], at[later], np.full(later.sum(), WINDOW))
        # the first of the last kind and the first of its last text settle what follows
        head = int(np.searchsorted(key, key[-1]))
        keep = np.unique([head, int(lead[-1])])
        held = [c[keep] for c in rows]


def _word_rows(batches: Iterator[pa.RecordBatch], text: bool) -> Iterator[pa.RecordBatch]:
    """Number of words and hash of the kept words of each text; ``starts`` and ``ends`` are the removed ones, if any."""
    for batch in batches:
        cut = "starts" in batch.schema.names
        n_words, removed, digests, kept = [], [], [], []
        spans = zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist()) if cut else None
        for value in batch.column("text"):
            words = (value.as_py() or "").encode().split()   # bytes are split at U+0020 and U+0009 to U+000D
            n_words.append(len(words))
            if cut:
                at, rest = 0, []
                for a, b in zip(*(s or () for s in next(spans))):
                    rest += words[at:a]
                    at = b
                words = rest + words[at:]
            joined = b" ".join(words)
            removed.append(n_words[-1] - len(words))
            digests.append(hashlib.sha256(joined).hexdigest())
            kept.append(joined if text and cut else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tag"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "tag", "n_words", "n_removed", "kept_sha256", "kept"])


def _texts(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # 22 bits, so that a place stays below 2^62
    return texts.withColumn("tag", F.pmod(F.xxhash64("text"), F.lit(1 << 22)))


def window_spans(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that hold repeated anchors, and ``(doc_id, tag, starts, ends)``: word spans to remove."""
    dealt = texts.filter("doc_id is not null").mapInArrow(_anchors, _AT).repartition("key").sortWithinPartitions("key")
    places = dealt.mapInArrow(_repeated, "doc_id bigint, at bigint")
    # as many as the document has places, so no longer than the text they are joined with
    tag, word = F.shiftright("at", 40), F.pmod("at", F.lit(PLACE)).cast("int")
    spots = places.groupBy("doc_id", tag.alias("tag")).agg(F.collect_list(word).alias("spots"))
    spots = materialise(spots, "anchors")
    near = left_join_unique(texts, spots, ["doc_id", "tag"], F.xxhash64("text"), "inner", small=False)
    near = materialise(near.dropDuplicates(["doc_id", "tag"]), "near-anchors")
    windows = near.mapInArrow(_extended, _AT).repartition("key").sortWithinPartitions("key", "doc_id", "at")
    later = windows.mapInArrow(_first_kept, "doc_id bigint, at bigint, size int")
    spans = later.repartition("doc_id").sortWithinPartitions("doc_id", "at")
    spans = spans.mapInArrow(_union, "doc_id bigint, tag bigint, starts array<bigint>, ends array<bigint>")
    return near.select("doc_id", "tag", "text"), materialise(spans, "word-spans")


def without_windows(docs: DataFrame, text: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` for every row of ``docs(doc_id, text)``.

    A word goes if it lies in a window of ``WINDOW`` words that also starts
    earlier: in a document with a smaller doc_id, or before it in its own text.
    ``kept`` holds the words left, joined by one space, of texts that lose
    some; it is null for the others, and without ``text``.

    Null and empty texts have no words; texts of fewer words and rows without
    doc_id stay whole.  Repeated rows give the same result each; texts that
    share a doc_id never remove each other's words.  Very long texts are taken
    whole; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    texts = _texts(docs)
    near, spans = window_spans(texts)
    schema = "doc_id bigint, tag bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary"
    whole = texts.mapInArrow(lambda batches: _word_rows(batches, False), schema).drop("kept")
    # both sides have a row per document and text
    cut = near.join(spans.hint("merge"), ["doc_id", "tag"]).mapInArrow(lambda batches: _word_rows(batches, text), schema)
    cut = cut.select("doc_id", "tag", F.struct("n_removed", "kept_sha256", "kept").alias("_cut"))
    joined = left_join_unique(whole, materialise(cut, "cut-texts"), ["doc_id", "tag"], F.xxhash64("kept_sha256"), small=False)
    return joined.select("doc_id", "n_words", F.coalesce("_cut.n_removed", "n_removed").alias("n_removed"),
                         F.coalesce("_cut.kept_sha256", "kept_sha256").alias("kept_sha256"), F.col("_cut.kept").alias("kept"))
