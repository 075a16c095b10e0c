"""Quality rules by cross-document line frequency: boilerplate lines of a host go, depleted documents too."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.llm.statistics import Counts
from karst.operators.bounds import fits_broadcast, left_join_unique
from karst.session import materialise, ship

#: a line is boilerplate from this many of its host's distinct documents, however many the host has
LINE_DOCUMENTS = 6
#: share of its words that a document must keep
KEPT_WORDS = 0.5
MIN_WORDS, MAX_REPEATED = 50, 50

_COUNTS = ("doc_id bigint, host string, print bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
           "n_dup_lines bigint, n_repeat_words bigint, lines array<bigint>, sizes array<bigint>")


def line_hashes(data: np.ndarray, c: Counts) -> np.ndarray:
    """Hashes of lines that ignore case (A-Z), digits and white space."""
    data = K.lower(data)
    data = np.where((data >= 48) & (data <= 57), np.uint8(48), data)
    return K.sequence_hashes(K.span_hashes(data, c.starts, c.ends), np.searchsorted(c.starts, c.line_starts),
                             np.searchsorted(c.starts, c.line_ends))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.utf8(batch.column("text"))
        for first, end, part, bounds in K.chunks(data, offsets):
            c = Counts(part, bounds)
            owner = np.repeat(np.arange(end - first), np.diff(c.line_bounds))
            filled = np.flatnonzero(c.line_words)
            hashes, owner, sizes = line_hashes(part, c)[filled], owner[filled], c.line_words[filled]
            # a document's equal lines are one, with all their words
            order = np.lexsort((hashes, owner))
            hashes, owner, sizes = hashes[order], owner[order], sizes[order]
            head = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])[:len(hashes)])
            sizes = np.add.reduceat(sizes, head) if len(head) else sizes
            edges = np.searchsorted(owner[head], np.arange(end - first + 1))
            counts = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words]
            print_ = K.span_hashes(part, bounds[:-1], bounds[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, end - first), batch.column("host").slice(first, end - first),
                 pa.array(K.signed(print_)), *(pa.array(x.astype(np.int64)) for x in counts),
                 K.long_lists(hashes[head], edges), K.long_lists(sizes.astype(np.int64), edges)],
                ["doc_id", "host", "print", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "lines", "sizes"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.utf8(batch.column("text"))
        texts, gone = [], batch.column("dropped").to_pylist()
        for first, end, part, bounds in K.chunks(data, offsets):
            c = Counts(part, bounds)
            hashes, raw = K.signed(line_hashes(part, c)), part.tobytes()
            for i in range(end - first):
                lines = range(c.line_bounds[i], c.line_bounds[i + 1])
                out = set(gone[first + i] or ())
                kept = [raw[c.line_starts[n]:c.line_ends[n]] for n in lines if not (c.line_words[n] and int(hashes[n]) in out)]
                texts.append(b"\n".join(kept).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def line_rules(docs: DataFrame, line_documents: int = LINE_DOCUMENTS, kept_words: float = KEPT_WORDS) -> DataFrame:
    """Counts and verdict for every row of ``docs(doc_id, text, source)``; the host is the source.

    A line (ignoring case, digits and white space) is boilerplate when at
    least ``line_documents`` of its host's distinct documents have it, at any
    size of the host; copies of a whole text are one document.  ``dropped`` lists the hashes of a document's boilerplate lines,
    ``n_dropped_words`` their words.  ``kept`` is false for under 50 words, for
    more than half of the words in repeated three-word windows, and when less
    than ``kept_words`` of the words are left.

    Null and empty texts have no words and are not kept.  A null source is the
    host "".  Repeated rows give the same result each.  Very long texts count
    whole; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"))
    rows = materialise(texts.mapInArrow(_count, _COUNTS), "line-counts")
    parts = rows.select("doc_id", "host", "print", F.explode(F.arrays_zip("lines", "sizes")).alias("l")).select(
        "doc_id", "host", "print", F.col("l.lines").alias("line"), F.col("l.sizes").alias("_words"))
    counts = parts.groupBy("host", "line").agg(F.countDistinct("print").alias("_in"))
    frequent = materialise(counts.filter(F.col("_in") >= line_documents).select("host", "line"), "frequent-lines")
    hit = left_join_unique(parts, frequent, ["host", "line"], F.col("doc_id"), "inner").select(
        "doc_id", "host", "print", "line", "_words").distinct()
    gone = hit.groupBy("doc_id", "host", "print").agg(F.sum("_words").alias("n_dropped_words"),
                                                      F.array_sort(F.collect_list("line")).alias("dropped"))
    small = fits_broadcast(gone)
    # null ids have to meet their own rows
    out = rows.drop("lines", "sizes").alias("r").join(
        (F.broadcast(gone) if small else gone).alias("g"),
        F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.print") == F.col("g.print")) &
        (F.col("r.host") == F.col("g.host")), "left").select("r.*", "n_dropped_words", "dropped")
    out = out.withColumn("n_dropped_words", F.coalesce("n_dropped_words", F.lit(0).cast("bigint")))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                         (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    left = (F.col("n_words") - F.col("n_dropped_words")) >= kept_words * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & left)


def without_lines(docs: DataFrame, rules: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the documents that ``rules`` keeps, without their boilerplate lines."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kept = rules.filter("kept").select("doc_id", "dropped").dropDuplicates(["doc_id"])
    return left_join_unique(texts, kept, ["doc_id"], F.xxhash64("text"), "inner").mapInArrow(
        _without, "doc_id bigint, text string")
