"""Dense global row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from karst.operators.bounds import quoted
from karst.session import materialise

TOP_N = 100_000      # rows one task may collect for a top-k
ANY_N = 10_000       # rows one task may collect for rows in no stated order


def number_rows(df: DataFrame, order: Sequence[str], name: str = "pos", start: int = 1,
                keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with a dense position ``name`` in the order of the ``order`` columns.

    One range shuffle sorts the rows into ordered partitions.  The position
    inside a partition is taken in the same stage and written out; the number
    of rows per partition (a handful of integers) then gives each partition its
    starting point.  ``order`` should end with a unique column.
    """
    columns = [F.col(quoted(c)) for c in order]
    # no partition count: adaptive execution merges small neighbours, which keeps their order
    ordered = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    kept = [F.col(quoted(c)) for c in (keep if keep is not None else df.columns)]
    slots = ordered.select(*kept, F.monotonically_increasing_id().alias("_slot"))
    return _from_slots(materialise(slots, "numbering"), name, start)


def _from_slots(written: DataFrame, name: str, start: int) -> DataFrame:
    part = F.shiftright("_slot", 33)
    counts = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # one row per partition, so this window is small whatever the table holds
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (written.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + local + F.lit(start))
            .drop("_part", "_slot", "_before"))


def any_rows(df: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """``limit`` rows after ``offset`` others, in no stated order, without one task that meets them all.

    A partition writes at most the rows that could be asked of it; the counts
    of the partitions then say how many of each are taken.
    """
    slots = df.withColumn("_slot", F.monotonically_increasing_id())
    local = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = _from_slots(materialise(slots.filter(local < limit + offset), "page"), "_place", 1)
    return numbered.filter((F.col("_place") > offset) & (F.col("_place") <= offset + limit)).drop("_place")


def smallest(df: DataFrame, order: Sequence[str], limit: int, offset: int = 0) -> DataFrame:
    """The rows after the first ``offset`` and up to ``limit`` more, in the order of some columns.

    A small prefix is a top-k that every task cuts first.  A prefix of millions
    is numbered by a range shuffle instead, so no single task holds it.
    """
    columns: list[Column] = [F.col(quoted(c)) for c in order]
    if limit + offset <= TOP_N:
        top = df.orderBy(*columns)
        return (top.offset(offset) if offset else top).limit(limit)
    numbered = number_rows(df, order, "_place")
    return (numbered.filter((F.col("_place") > offset) & (F.col("_place") <= offset + limit))
            .orderBy("_place").drop("_place"))
