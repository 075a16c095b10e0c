"""Mixing of sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from karst.operators.bounds import fits_broadcast

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: a source gives no more than so many times its size
REPEATS = 3
#: rows of one bin, and bins of one group, whose running totals one task computes
BIN, GROUP = 4096, 4096


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, source_size)``, a row per source.

    Sources in code-point order, null last, take the weights in turn and share
    the sum of all sizes.  A target stops at ``repeats`` times its source's
    size; what is left is shared by the others.  The common level is found
    directly: in the order of size per weight, the sources before it are full.
    """
    listed = sizes.withColumn("_at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    turn = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_at") % len(weights) + 1).cast("int"))
    listed = listed.select("source", "source_size", "_at", turn.alias("_w"),
                           (F.col("source_size") * repeats).cast("double").alias("_most"))
    order = Window.orderBy(F.col("_most") / F.col("_w"), "_at")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    rest = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(every) - full) / rest
    ranked = listed.withColumn("_level", level).withColumn("_rank", F.row_number().over(order))
    fits = F.when(F.col("_level") <= F.col("_most") / F.col("_w"), F.struct("_rank", "_level"))
    common = F.min(fits).over(Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # no level: every source is full
    share = F.coalesce(F.least(F.col("_most"), common.getField("_level") * F.col("_w")), F.col("_most"))
    return ranked.select("source", "source_size", share.alias("target"))


def _before(sums: DataFrame) -> DataFrame:
    """Running totals over the bins of each source, up to but without each bin."""
    grouped = sums.withColumn("_group", F.floor(F.col("_bin") / GROUP))
    groups = grouped.groupBy("source", "_group").agg(F.sum("_sum").alias("_all"))
    earlier = Window.partitionBy("source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("source", "_group", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source", "_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = grouped.withColumn("_in", F.coalesce(F.sum("_sum").over(inside), F.lit(0)))
    same = F.col("b.source").eqNullSafe(F.col("g.source")) & (F.col("b._group") == F.col("g._group"))
    return bins.alias("b").join(groups.alias("g"), same).select(
        "b.source", "b._bin", (F.col("_in") + F.col("_base")).alias("_before"))


def fair_mix(docs: DataFrame, size: Column, order: Column, weights: Sequence[float] = WEIGHTS,
             repeats: int = REPEATS) -> DataFrame:
    """Plan of a mix: a row ``(row, source, size, source_size, target, finish, taken)`` per document, by finish time.

    ``docs`` has a column ``source``; ``row`` is a struct of all its columns.
    ``order`` is a hash that shuffles the documents of a source.  A document's
    virtual finish time is the number of its source's words up to and with it,
    divided by the source's target.  Sources are served by finish time, and
    begin anew when they end.  At time 1 each source has given its target and
    all have given the budget, so the queue is cut there; ``taken`` counts the
    words a document gave by then, repeats included.  A document at the cut
    gives its first words only.

    Running totals come from hash bins of about 4,096 rows, so no task sees a
    whole source.  A null source is a source of its own; a size of null or 0 is
    served and gives nothing.  Repeated rows queue each.  No rows: no plan.
    Very long documents are taken in part if the cut falls inside them; columns
    of any other name go along in ``row``.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"),
                       F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), order.cast("bigint").alias("_hash"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    total = sizes.agg(F.sum("_rows")).first()[0] or 0
    bins = max(1, math.ceil(total / BIN))
    # bins follow the order of the hash: the first one holds the smallest values
    place = F.floor((F.shiftrightunsigned(F.col("_hash"), 11).cast("double") / float(1 << 53)) * bins)
    rows = rows.withColumn("_bin", F.least(place, F.lit(bins - 1)).cast("bigint"))
    queue = Window.partitionBy("source", "_bin").orderBy(
        F.shiftrightunsigned(F.col("_hash"), 11), "_hash", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_cum", F.sum("size").over(queue))
    offsets = _before(docs.select(F.col("source").cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
                                  order.cast("bigint").alias("_hash")).withColumn(
        "_bin", F.least(place, F.lit(bins - 1)).cast("bigint")).groupBy("source", "_bin").agg(F.sum("size").alias("_sum")))
    targets = source_targets(sizes.drop("_rows"), weights, repeats)
    targets = F.broadcast(targets) if fits_broadcast(targets) else targets
    same = F.col("o.source").eqNullSafe(F.col("t.source"))
    facts = offsets.alias("o").join(targets.alias("t"), same).select("o.source", "_bin", "_before", "source_size", "target")
    facts = F.broadcast(facts) if fits_broadcast(facts) else facts
    joined = rows.alias("r").join(
        facts.alias("f"), F.col("r.source").eqNullSafe(F.col("f.source")) & (F.col("r._bin") == F.col("f._bin")))
    start = F.col("_before") + F.col("_cum") - F.col("size")
    end = F.round("target").cast("bigint")
    given = [F.least(F.col("size"), F.greatest(F.lit(0).cast("bigint"), end - start - F.lit(turn) * F.col("source_size")))
             for turn in range(repeats)]
    taken = given[0]
    for more in given[1:]:
        taken = taken + more
    plan = joined.select("row", F.col("r.source").alias("source"), "size", "source_size", "target",
                         F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target")).otherwise(
                             F.lit(float("inf"))).alias("finish"), taken.alias("taken"), "_hash")
    return plan.orderBy("finish", "_hash").drop("_hash")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word and the white space after it."""
    parts = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    lead = F.when(text.rlike(r"\A[\x20\x09-\x0D]"), 1).otherwise(0)
    return F.array_join(F.slice(parts, F.lit(1), (words + lead).cast("int")), "")


def mixed(docs: DataFrame, plan: DataFrame, text: str = "text") -> DataFrame:
    """The documents of ``plan`` as often as they are taken, the one at the cut shortened; columns of ``docs``.

    Null and empty texts have no words and are not taken.  Repeated rows come
    as often as each was taken; an empty plan gives no rows.
    """
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(1))
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(F.lit(0))
    turns = F.sequence(F.lit(1), whole + F.when(rest > 0, 1).otherwise(0))
    rows = plan.filter("taken > 0").withColumn("_turn", F.explode(turns))
    cut = F.when(F.col("_turn") > whole, first_words(F.col(f"row.{text}"), rest)).otherwise(F.col(f"row.{text}"))
    return rows.select(*[cut.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
