"""How quality filters overlap: what each removes in every order they can be applied in.

A document is reduced to a mask of the filters it fails.  In min-plus algebra
the mask is a row with 0 at the filters it fails and infinity elsewhere, an
order is a column with the step at which each filter comes (the inverse
permutation), and their product is the step that removes the document: the
least step of a failed filter.  With five filters there are 32 masks and 120
orders, so the product is one small matrix, and a part of the corpus is its 32
weights, which are scattered over (order, step).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from karst.llm import kernels as K
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship

FILTERS = "ABCDE"
#: A: words at least; B: distinct words at least, of a hundred; C: capitals at most, of a hundred characters
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
#: D: characters that no kept text holds
SYMBOLS = b"#$%&*|"

_MASK = "doc_id bigint, part string, h1 bigint, h2 bigint, mask int"
_AUDIT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def removal_steps(filters: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of ``filters`` filters, and the step (from 1) at which each mask goes in each order.

    A mask that fails nothing has the step ``filters + 1``.
    """
    orders = list(permutations(range(filters)))
    # the position matrix holds the inverse of each order
    positions = np.argsort(np.array(orders), axis=1).T + 1
    fails = np.arange(1 << filters)[:, None] >> np.arange(filters) & 1
    costs = np.where(fails == 1, 0, filters + 1)
    steps = np.min(costs[:, :, None] + positions[None, :, :], axis=1)
    return orders, np.minimum(steps, filters + 1)


def _text_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters A to D of each text as the bits 0 to 3."""
    table = np.zeros(256, dtype=bool)
    table[list(SYMBOLS)] = True
    for batch in batches:
        data, offsets = K.utf8(batch.column("text"))
        masks = np.zeros(batch.num_rows, dtype=np.int32)
        for first, end, part, bounds in K.chunks(data, offsets):
            starts, ends, edges = K.words(part, bounds)
            n_words = np.diff(edges)
            _, head = K.repeats_within(K.span_hashes(part, starts, ends), np.repeat(np.arange(end - first), n_words))
            distinct = K.count_in(head, edges)
            points = K.count_in((part & 0xC0) != 0x80, bounds)
            capitals = K.count_in((part >= 65) & (part <= 90), bounds)
            masks[first:end] = ((n_words < LEAST_WORDS) * 1 + (100 * distinct < LEAST_DISTINCT * n_words) * 2
                                + (100 * capitals > MOST_CAPITALS * points) * 4 + (K.count_in(table[part], bounds) > 0) * 8)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "h1", "h2")), pa.array(masks)],
                                         ["doc_id", "part", "h1", "h2", "mask"])


def mask_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each source by the filters they fail.

    Bits 0 to 4 of ``mask`` are the filters A to E.  E looks at the whole
    table: a text fails that a smaller doc_id has too.  Only text hashes (128
    bits) and ids are shuffled, and copies are counted before they meet.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"), text.alias("text"))
    rows = materialise(rows.mapInArrow(_text_masks, _MASK), "masks")
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # repeated rows are one row with a count
    counted = rows.filter("doc_id is not null").groupBy("doc_id", "part", "h1", "h2", "mask").agg(F.count("*").alias("c"))
    marked = left_join_unique(counted, marks, ["doc_id"], F.xxhash64("h1", "part"), small=False).withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # a text of a part: its rows, and its smallest id with the rows that hold it
    groups = marked.groupBy("h1", "h2", "part", "mask", "good", "toxic").agg(
        F.sum("c").alias("n"), F.min(F.struct("doc_id", "c")).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("h1", "h2"))
    first = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.c")).otherwise(F.lit(0))
    split = groups.withColumn("least", least).select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", first.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - first).alias("n")))).alias("m"))
    # a row without an id is after no other and before none
    alone = rows.filter("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n")).select(
        "part", F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.struct("mask", "n").alias("m"))
    weights = split.union(alone).filter("m.n > 0").groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum("m.n").alias("n"), F.sum(F.col("m.n") * F.col("good")).alias("good"),
        F.sum(F.col("m.n") * F.col("toxic")).alias("toxic"))
    return weights


def interactions(weights: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the ``filters`` and step, from ``weights(part, mask, n, good, toxic)``.

    A part's weights are one small row (a number per mask), and a task works
    on many parts at once.
    """
    count = len(filters)
    orders, steps = removal_steps(count)
    names = ["".join(filters[f] for f in order) for order in orders]
    sequence = np.array(orders)                                   # filter at each step
    bits = np.arange(1 << count)
    fails = (bits[:, None] >> np.arange(count) & 1).astype(bool)  # mask, filter

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_at = np.broadcast_to(np.arange(len(orders)), steps.shape)
        # of a mask that fails the filter of a step: gone before that step
        late = fails[:, sequence] & (steps[:, :, None] < np.arange(1, count + 1))
        for batch in batches:
            for row, part in enumerate(batch.column("part").to_pylist()):
                held = batch.column("weights")[row].as_py()
                weight = np.zeros((3, 1 << count), dtype=np.int64)
                for w in held:
                    weight[:, w["mask"]] += (w["n"], w["good"], w["toxic"])
                lost = np.zeros((3, len(orders), count + 2), dtype=np.int64)
                for kind in range(3):
                    np.add.at(lost[kind], (order_at, steps), weight[kind][:, None])
                removed, good, toxic = lost[:, :, 1:count + 1]
                redundant = np.tensordot(weight[0], late, axes=1)
                kept = weight[0].sum() - np.cumsum(removed, axis=1)
                unique = weight[0][1 << sequence]
                shapley = np.zeros(count, dtype=np.int64)
                np.add.at(shapley, sequence, removed)
                size = len(orders) * count
                columns = [pa.array(x.ravel().astype(np.int64)) for x in (
                    kept, removed, redundant, unique, good, toxic, shapley[sequence])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * size, pa.string()), pa.array(np.repeat(np.array(names, dtype=object), count), pa.string()),
                     pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(orders))), *columns],
                    [f.split(" ")[0] for f in _AUDIT.split(", ")])

    held = weights.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("weights"))
    return held.mapInArrow(audit, _AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters on ``docs(doc_id, text, source)`` in all 120 orders, for each source.

    Per source, order and step: documents ``kept`` after the step, ``removed``
    by it, ``redundant`` (they fail its filter but went earlier),
    ``unique_fails`` (they fail its filter alone), good and toxic ones lost, and
    its filter's removals over all orders (``shapley``).

    Null texts are empty, null sources are the part ''.  Repeated rows count as
    often as they stand there; rows with one id and one text are no copies of
    each other.  A row without doc_id never fails filter E and has no label.
    Of repeated labels the larger counts, null labels are 0.  Long texts are
    whole; an empty table has no parts and no rows; other columns are ignored.
    """
    return interactions(mask_weights(docs, labels))
