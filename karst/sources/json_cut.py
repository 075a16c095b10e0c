"""Records of JSON documents of any size, cut in parallel.

Spark's text reader splits a file at commas, so a byte range of it is a
partition whose fragments come in order.  Whether a range begins inside a
string, and how deep, depends on everything before it; but a range maps any
state to another in a way that two numbers tell (does it flip the quotes, and
how far do brackets go up or down if it begins outside or inside a string).
One pass takes those for every range, a window sum over the ranges of a file
composes them, and a second pass cuts at the commas of the wanted depth.
Records that lie across ranges come out in parts and are joined again; items
that follow each other inside a range travel together, as one row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from karst.operators.bounds import fits_broadcast
from karst.session import materialise, ship, short_batches

_RANGE = "file string, start bigint, flips int, outside bigint, inside bigint, opening string"
_PART = "file string, start bigint, seq bigint, part int, kind string, col bigint, at bigint, fresh boolean, ends string, size bigint, values array<string>"
#: fragments and bytes that a task is given at once, and rows of their items that a reader holds at once
BATCH_ROWS, BATCH_BYTES, GROUP_ROWS = 10_000, 4 << 20, 32
#: rows of a column document that are put together at once, and about how many bytes of them
BLOCK_ROWS, BLOCK_BYTES = 8192, 2 << 20
#: a part of a record: all of it, its end, its beginning, or neither
WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
_SPACE = " \t\r\n"


def fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of the files between commas, each with its file and the byte range it was read in, in order within a range."""
    return spark.read.text(path, lineSep=",").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.Array]]:
    """(file, start, first of its range, fragments) in the order of the files."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("file").dictionary_encode()
        files, starts = names.indices.to_numpy(), batch.column("start").to_numpy()
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            key = (names.dictionary[int(files[lo])].as_py(), int(starts[lo]))
            yield *key, key != last, batch.column("value").slice(lo, hi - lo)
            last = key


def marks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte lies in a string if the bytes begin outside one, and what it adds to the depth out of strings."""
    quote = raw == 34
    slash = raw == 92
    if slash.any():
        # a quote after an odd run of backslashes does not count
        at = np.arange(len(raw))
        run_start = np.maximum.accumulate(np.where(slash, -1, at))
        quote &= ~np.concatenate([[False], ((at[:-1] - run_start[:-1]) & 1).astype(bool)])
    inside = (np.cumsum(quote) & 1).astype(bool)
    step = ((raw == 91) | (raw == 123)).astype(np.int8) - ((raw == 93) | (raw == 125)).astype(np.int8)
    return inside, step


def _bytes(values: pa.Array) -> np.ndarray:
    """The fragments with a comma after each."""
    values = values.cast(pa.large_string())
    listed = pa.LargeListArray.from_arrays(pa.array([0, len(values)], pa.int64()), values)
    return np.frombuffer(pc.binary_join(listed, pa.scalar(",", pa.large_string()))[0].as_buffer().to_pybytes() + b",", dtype=np.uint8)


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each byte range does to the state it begins in."""
    held: list | None = None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(held, (
            pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            [f.split(" ")[0] for f in _RANGE.split(", ")])

    for file, start, fresh, values in _ranges(batches):
        if fresh:
            if held is not None:
                yield row()
            held = [file, start, 0, 0, 0, None]
        raw = _bytes(values)
        inside, step = marks(raw)
        one, two = int(step[~inside].sum()), int(step[inside].sum())
        if held[2]:
            one, two = two, one
        held[3], held[4] = held[3] + one, held[4] + two
        held[2] ^= int(inside[-1])
        if start == 0 and not held[5]:
            text = raw[:-1].tobytes().decode().lstrip("﻿" + _SPACE)
            held[5] = text[0] if text else None
    if held is not None:
        yield row()


class _Cutter:
    """Cuts one byte range at the commas and brackets of the lists at ``depth``: 1 for rows, 2 for column arrays.

    A record is an ``item``, or the text ``between`` lists: keys, and what
    stands before and after everything.  Items are numbered from the last list
    that begins in this range, lists from the range's begin.  Whole items that
    end at commas, one after another, are one row with all their values.
    """

    def __init__(self, file: str, start: int, quoted: bool, level: int, depth: int):
        self.file, self.start, self.quoted, self.level, self.depth = file, start, quoted, level, depth
        self.open: list[str] = []            # of the record that has not ended
        self.inherited = start > 0           # the open record began in an earlier range
        self.kind, self.fresh = ("item", False) if self.inherited else ("between", False)
        self.seq = self.lists = self.items = 0
        self.rows: list[tuple] = []
        self.values: list[pa.Array] = []

    def _emit(self, part: int, ends: str | None) -> None:
        own = part in (WHOLE, TAIL)
        text = "".join(self.open)
        self.rows.append((self.file, self.start, self.seq, part, self.kind if own else None, self.lists if own else None,
                          self.items if own else None, self.fresh if own else None, ends, len(text.encode())))
        self.values.append(pa.array([text], pa.string()))
        self.seq += 1

    def _run(self, raw: np.ndarray, commas: np.ndarray) -> None:
        """Whole items: what stands between the first of ``commas`` and the last."""
        lo, size = int(commas[0]) + 1, len(commas) - 1
        kept = np.ones(int(commas[-1]) - lo, dtype=bool)
        kept[commas[1:-1] - lo] = False
        data = raw[lo:int(commas[-1])][kept]
        edges = np.concatenate([[0], commas[1:] - lo - np.arange(size)]).astype(np.int32)
        self.rows.append((self.file, self.start, self.seq, WHOLE, self.kind, self.lists, self.items, False, ",", len(data)))
        self.values.append(pa.StringArray.from_buffers(size, pa.py_buffer(edges), pa.py_buffer(data)))
        self.seq, self.items = self.seq + 1, self.items + size

    def taken(self) -> pa.RecordBatch:
        """The rows since the last call."""
        sizes = np.concatenate([[0], np.cumsum([len(v) for v in self.values])]).astype(np.int32)
        columns = [pa.array(c, k) for c, k in zip(zip(*self.rows), _KINDS)]
        values = pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays(self.values))
        self.rows, self.values = [], []
        return pa.RecordBatch.from_arrays([*columns, values], [f.split(" ")[0] for f in _PART.split(", ")])

    def _end(self, ends: str) -> None:
        self._emit(HEAD if self.inherited else WHOLE, ends)
        if not self.inherited and self.kind == "item":
            self.items += 1
        if ends in "[{":
            self.lists, self.items = self.lists + 1, 0
        self.kind, self.fresh = ("between" if ends in "]}" else "item"), ends in "[{"
        self.open, self.inherited = [], False

    def add(self, values: pa.Array) -> None:
        raw = _bytes(values)
        inside, step = marks(raw)
        if self.quoted:
            inside = ~inside
        step = np.where(inside, 0, step)
        level = self.level + np.cumsum(step, dtype=np.int64)
        ends = np.flatnonzero(((raw == 44) & ~inside & (level == self.depth)) | ((step > 0) & (level == self.depth))
                              | ((step < 0) & (level == self.depth - 1)))
        # after a comma comes a whole item up to the next one; the first of a run of commas may end something else
        comma = raw[ends] == 44
        first = np.flatnonzero(~(comma & np.concatenate([[False], comma[:-1]])))
        lo = 0
        for i, until in zip(first.tolist(), [*first[1:].tolist(), len(ends)]):
            end = int(ends[i])
            self.open.append(raw[lo:end].tobytes().decode())
            self._end(chr(raw[end]))
            if until > i + 1:
                self._run(raw, ends[i:until])
            lo = int(ends[until - 1]) + 1
        self.open.append(raw[lo:].tobytes().decode())
        self.quoted, self.level = bool(inside[-1]), int(level[-1])

    def finish(self) -> None:
        self._emit(MIDDLE if self.inherited else TAIL, None)
        if not self.inherited and self.kind == "item":
            self.items += 1


_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64()]


def _cut(states, depth: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter = None
    for file, start, fresh, values in _ranges(batches):
        if fresh:
            if cutter is not None:
                cutter.finish()
                yield cutter.taken()
            cutter = _Cutter(file, start, *states.value[file, start], depth)
        cutter.add(values)
        if cutter.rows:
            yield cutter.taken()
    if cutter is not None:
        cutter.finish()
        yield cutter.taken()


def _states(ranges: DataFrame, malformed) -> tuple[str, dict]:
    """The documents' opening character, and (in a string, depth) at the begin of each byte range: one row for each that a task reads."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2
    states = ranges.withColumn("quoted", quoted).withColumn(
        "change", F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside")))
    found = states.withColumn("level", F.coalesce(F.sum("change").over(before), F.lit(0))).collect()
    openings = {r.opening for r in found if r.start == 0}
    if openings not in ({"["}, {"{"}):
        raise malformed("the text must begin with [ (rows) or { (columns)")
    last = {}
    for r in sorted(found, key=lambda r: r.start):
        last[r.file] = (int(r.level + r.change), int(r.quoted + r.flips) % 2)
    if any(state != (0, 0) for state in last.values()):
        raise malformed("a document does not end where its brackets do")
    return openings.pop(), {(r.file, r.start): (bool(r.quoted), int(r.level)) for r in found}


def records(spark: SparkSession, path: str | list[str], malformed) -> tuple[str, DataFrame]:
    """The documents' opening character, and their records ``(file, start, seq, kind, col, at, fresh, ends, size, values)``.

    A row has the values of one record or of several items that follow each
    other; ``at`` is the first one's number.  ``col`` and ``at`` number the lists
    of a file and the items of a list from 0, where the documents are objects;
    those of arrays need no numbers.
    """
    ship(spark)
    pieces = fragments(spark, path)
    with short_batches(spark, BATCH_ROWS, BATCH_BYTES):
        ranges = materialise(pieces.mapInArrow(_transitions, _RANGE), "json-ranges")
    opening, states = _states(ranges, malformed)
    shared = spark.sparkContext.broadcast(states)
    depth = 1 if opening == "[" else 2
    with short_batches(spark, BATCH_ROWS, BATCH_BYTES):
        parts = materialise(pieces.mapInArrow(lambda batches: _cut(shared, depth, batches), _PART), "json-parts", group_rows=GROUP_ROWS)
    columns = ["file", "start", "seq", "kind", "col", "at", "fresh", "ends", "size", "values"]
    # a record that lies across ranges: its begin, ranges without an end of it, its end
    chain = F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("start", "seq"))
    broken = parts.filter(F.col("part") != WHOLE).withColumn("record", chain).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "seq", "kind", "col", "at", "fresh", "ends", "size",
                                                    F.col("values")[0].alias("value")))).alias("p"))
    first, last = F.element_at("p", 1), F.element_at("p", -1)
    broken = broken.select("file", *[first[c].alias(c) for c in ("start", "seq", "kind", "col", "at", "fresh")], last["ends"].alias("ends"),
                           F.aggregate("p", F.lit(0).cast("bigint"), lambda n, x: n + x["size"]).alias("size"),
                           F.array(F.concat_ws("", F.transform("p", lambda x: x["value"]))).alias("values"))
    every = parts.filter(F.col("part") == WHOLE).select(*columns).unionByName(broken)
    # what an empty list holds is no item
    blank = F.col("fresh") & (F.trim(F.regexp_replace(F.col("values")[0], r"\s", "")) == "") & (F.col("ends") != ",")
    every = every.filter(~((F.col("kind") == "item") & blank))
    return (opening, every) if opening == "[" else (opening, _numbered(parts, every))


def _numbered(parts: DataFrame, every: DataFrame) -> DataFrame:
    """``every`` record with the numbers of its list and of its place there, counted over the whole file."""
    # numbers that a range inherits from those before it
    own = parts.filter(F.col("part").isin(WHOLE, TAIL))
    item = F.col("kind") == "item"
    opens = F.col("ends").isin("[", "{")
    facts = parts.groupBy("file", "start").agg(F.count_if(opens).alias("lists"), F.coalesce(F.sum(F.when(
        item & F.col("part").isin(WHOLE, TAIL), F.size("values"))), F.lit(0)).alias("items"))
    # items of the last list that begins in the range
    latest = own.filter(item).join(facts.select("file", "start", "lists"), ["file", "start"]).filter("col = lists").groupBy(
        "file", "start").agg(F.sum(F.size("values")).alias("latest"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    facts = facts.join(latest, ["file", "start"], "left").withColumn("latest", F.coalesce("latest", F.lit(0)))
    facts = facts.withColumns({"lists_before": F.coalesce(F.sum("lists").over(before), F.lit(0)),
                               "items_before": F.coalesce(F.sum("items").over(before), F.lit(0))})
    base = F.when(F.col("lists") > 0, F.col("items_before") + F.col("items") - F.col("latest"))
    facts = facts.withColumn("base", base).withColumn("carried", F.col("items_before") - F.coalesce(
        F.last("base", ignorenulls=True).over(before), F.lit(0)))
    facts = materialise(facts.select("file", "start", "lists_before", "carried"), "json-facts")
    # a row for each range, as the states that the tasks had
    return every.join(F.broadcast(facts), ["file", "start"]).select(
        "file", "start", "seq", "kind", (F.col("lists_before") + F.col("col") - 1).alias("col"),
        (F.col("at") + F.when(F.col("col") == 0, F.col("carried")).otherwise(0)).alias("at"), "fresh", "ends", "size", "values")


def row_texts(spark: SparkSession, found: DataFrame, malformed) -> DataFrame:
    """Row objects (text ``value``) of documents that are arrays."""
    between = found.filter("kind = 'between'").groupBy("file").agg(
        F.count_if(F.col("ends") == "[").alias("lists"), F.count_if(~F.col("values")[0].rlike(r"\A[\x{FEFF}\s,]*\z")).alias("text"))
    if not between.filter("lists <> 1 or text > 0").isEmpty():
        raise malformed("a document holds more than one array")
    return found.filter("kind = 'item'").select(F.explode("values").alias("value"))


def _block(group: pa.Table) -> pa.Table:
    """Row objects of a block of a column document, from pieces of its columns."""
    group = group.take(pc.sort_indices(group, [("col", "ascending"), ("at", "ascending")]))
    cols = group.column("col").to_numpy()
    first = [0, *(np.flatnonzero(cols[1:] != cols[:-1]) + 1).tolist(), len(cols)]
    texts = []
    for i, j in zip(first[:-1], first[1:]):
        texts += [f"{',' if i else '{'}{group.column('key')[i].as_py()}:",
                  pa.concat_arrays([c.flatten() for c in group.column("values").slice(i, j - i).chunks])]
    whole = [pa.scalar(t, pa.large_string()) if isinstance(t, str) else t.cast(pa.large_string()) for t in [*texts, "}", ""]]
    return pa.table({"value": pc.binary_join_element_wise(*whole).cast(pa.string())})


def column_rows(spark: SparkSession, found: DataFrame, malformed) -> tuple[DataFrame, list[str]]:
    """Row objects (text ``value``) of documents that are objects of column arrays, and the names of the columns."""
    keys = found.filter("kind = 'between'").select("file", (F.col("col") + 1).alias("col"), "ends", F.col("values")[0].alias("value"))
    key = F.regexp_extract("value", r'\A[\x{FEFF}\s]*[{,]\s*("(?:[^"\\]|\\.)*+")\s*:\s*\z', 1)
    keys = materialise(keys.withColumn("key", key), "json-keys")
    if not keys.filter("ends = '[' and key = '' or ends = '{'").isEmpty():
        raise malformed("each field of a column document has to be a list")
    if not keys.filter(~F.coalesce("ends", F.lit("")).isin("[") & ~F.col("value").rlike(r"\A\s*\}[\s,]*\z")).isEmpty():
        raise malformed("each field of a column document has to be a list")
    names = keys.filter("ends = '['").select("file", "col", "key")
    cells = found.filter("kind = 'item'").select("file", "col", "at", "size", "values")
    sizes = names.join(cells.groupBy("file", "col").agg(F.sum(F.size("values")).alias("n"), F.sum("size").alias("size")), ["file", "col"], "left")
    sizes = sizes.groupBy("file").agg(F.min(F.coalesce("n", F.lit(0))).alias("lo"), F.max(F.coalesce("n", F.lit(0))).alias("hi"), F.sum("size").alias("size"))
    uneven, width = sizes.agg(F.count_if(F.col("lo") != F.col("hi")), F.max(F.col("size") / F.col("hi"))).first()
    if uneven:
        raise malformed("the lists of a column document differ in length")
    # pieces of all columns meet by blocks of rows
    rows = int(min(BLOCK_ROWS, max(1, BLOCK_BYTES // max(width or 1, 1))))
    begin = F.greatest(F.col("block") * rows, F.col("at"))
    end = F.least((F.col("block") + 1) * rows, F.col("at") + F.size("values"))
    cells = cells.withColumn("block", F.explode(F.expr(f"sequence(at div {rows}, (at + size(values) - 1) div {rows})"))).select(
        "file", "block", "col", begin.alias("at"), F.slice("values", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int")).alias("values"))
    cells = cells.join(F.broadcast(names) if fits_broadcast(names) else names, ["file", "col"])
    text = cells.groupBy("file", "block").applyInArrow(_block, "value string")
    return text, [json.loads(r[0]) for r in names.select("key").distinct().collect()]
