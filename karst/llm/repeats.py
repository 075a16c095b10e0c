"""Removal of byte strings that another document already holds, by suffix arrays.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts in a
document with a smaller id.

Shards have to hold all places of a string, so strings are dealt by content:
the least hash among the 20-byte grams of a string names its group, and
neighbouring strings with the same least gram travel as one region (about 18
strings).  Equal regions are told by their hash: only the region and its owner,
the smallest id, go on, and within a task before anything is shuffled.  Groups
with several different regions may share strings inside them: their bytes are
fetched, each shard's suffix array is built by induced sorting, and adjacent
suffixes with a common prefix of ``LENGTH`` bytes form one class whose smallest
id owns it.  Groups too large for one shard are cut, and classes of the cuts
meet by their content hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.llm.suffixes import permuted_prefixes, suffix_array
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship

LENGTH = 50
GRAM = 20
#: bytes of text a shard's suffix array covers, and regions of a group beyond which it is cut
SHARD_BYTES = 1 << 20
GROUP_REGIONS = 4096
#: bytes of documents looked at together; longer documents are cut into overlapping pieces
PIECE = 1 << 20
#: places are (tag of the text) * 2^40 + offset, so that rows that share an id but not the text stay apart
PLACE = 1 << 40

#: a region on its way: the code holds tag, offset and number of strings, 0 for a span to remove, whose size is in ``region``.
#: What differs from row to row stands side by side, between zeros, which the shuffle's compression takes away.
_CODED = "doc_id bigint, key bigint, region bigint, code bigint"
_KEY = np.uint64((1 << 64) - (1 << 16))
_COUNT_BITS = (LENGTH - GRAM + 1).bit_length()
_OFFSET_BITS = 31
_REGION = "key bigint, region bigint, doc_id bigint, at bigint, size int"
_FOUND = "key bigint, doc_id bigint, at bigint, size int"
_SPAN = "doc_id bigint, at bigint, size int"


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    names, arrays = [], []
    for field, values in zip(schema.split(", "), columns):
        name, kind = field.split(" ")
        names.append(name)
        dtype = np.int32 if kind == "int" else np.int64
        values = values.view(np.int64) if values.dtype == np.uint64 else values
        arrays.append(pa.array(values.astype(dtype)))
    return pa.RecordBatch.from_arrays(arrays, names)


def _pieces(data: np.ndarray, offsets: np.ndarray, tags: np.ndarray):
    """Chunks of documents: bytes, offsets, document number and place of each."""
    for first, end, part, bounds in K.chunks(data, offsets, PIECE):
        if len(part) <= 2 * PIECE:
            yield part, bounds, np.arange(first, end), tags[first:end] * PLACE
            continue
        for at in range(0, max(1, len(part) - LENGTH + 1), PIECE):
            piece = part[at:at + PIECE + LENGTH - 1]
            yield piece, np.array([0, len(piece)]), np.array([first]), tags[first:first + 1] * PLACE + at


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all byte strings of ``GRAM`` bytes."""
    up, down = K.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:-1], out=sums[1:])
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= down[:len(grams)]
    return K.mix(grams)


def regions(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with the same least gram: group, content hash, start, end."""
    size = len(data)
    if size < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = _grams(data)
    low = np.uint64((1 << 23) - 1)
    # the place breaks ties inside a string, to the left
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, LENGTH - GRAM + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    limits = np.repeat(offsets[1:].astype(np.int32), np.diff(offsets))
    starts = np.flatnonzero(limits[:len(least)] - np.arange(len(least), dtype=np.int32) >= LENGTH)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = (least[starts] & low).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    begin = starts[cuts]
    end = starts[np.append(cuts[1:] - 1, len(starts) - 1)] + LENGTH
    return grams[place[cuts]], K.span_hashes(data, begin, end), begin, end


def _merged(doc: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans, in order of document and place."""
    if not len(doc):
        return doc, at, size
    order = np.lexsort((at, doc))
    doc, at, stop = doc[order], at[order], at[order] + size[order]
    fresh = np.concatenate([[True], doc[1:] != doc[:-1]])
    groups = np.cumsum(fresh) - 1
    # a running maximum within each document: places are below 2^63 / groups once ranked
    base = np.concatenate([at, stop])
    values, rank = np.unique(base, return_inverse=True)
    high = np.maximum.accumulate(rank[len(at):] + groups * np.int64(len(values)))
    reach = values[high - groups * np.int64(len(values))]
    new = fresh.copy()
    new[1:] |= at[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(doc) - 1)
    return doc[first], at[first], reach[last] - at[first]


def _coded(key: np.ndarray, region: np.ndarray, doc: np.ndarray, at: np.ndarray, strings: np.ndarray | int) -> pa.RecordBatch:
    # groups are told by 48 bits of their gram: two that share them form one group of several regions
    place = (at // PLACE << _OFFSET_BITS) | at % PLACE
    code = (place << _COUNT_BITS) | strings
    return _batch(_CODED, doc, key & _KEY, region, code)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_CODED`` as ``_REGION``; size < 0: a span to remove."""
    for batch in batches:
        doc, key, region, code = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        strings, place = code & ((1 << _COUNT_BITS) - 1), code >> _COUNT_BITS
        at = (place >> _OFFSET_BITS) * PLACE + (place & ((1 << _OFFSET_BITS) - 1))
        yield _batch(_REGION, key, region, doc, at, np.where(strings == 0, -region, strings + LENGTH - 1))


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions of each document, and spans that another document of the same piece already covers."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        tags = batch.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
        data, offsets = K.utf8(batch.column("text"))
        for part, bounds, docs, places in _pieces(data, offsets, tags):
            key, region, begin, end = regions(part, bounds)
            if not len(key):
                continue
            own = np.searchsorted(bounds, begin, side="right") - 1
            doc, at, size = ids[docs[own]], places[own] + begin - bounds[own], end - begin
            _, group = np.unique(region, return_inverse=True)
            owner = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(owner, group, doc)
            later = doc > owner[group]
            keep = ~later
            yield _coded(key[keep], region[keep], doc[keep], at[keep], size[keep] - LENGTH + 1)
            doc, at, size = _merged(doc[later], at[later], size[later])
            if len(doc):
                yield _coded(K.mix(doc.astype(np.uint64) ^ at.astype(np.uint64)), size, doc, at, 0)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of regions owned by a smaller id (size < 0), and owners in groups of several regions.

    Rows come sorted by group, region, id; of the rows before a batch only the
    last region's are kept that its owner holds, one for each time it repeats.
    """
    held = None      # the last region's rows of its owner: key, region, doc, at, size
    open_ = False    # its group is known to have several regions
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        ready = rows[4] < 0
        if ready.any():
            yield _batch(_REGION, *(c[ready] for c in rows))
            rows = [c[~ready] for c in rows]
        if held is not None:
            rows = [np.concatenate([h, c]) for h, c in zip(held, rows)]
        key, region, doc, at, size = rows
        if not len(key):
            continue
        same_key = np.concatenate([[False], key[1:] == key[:-1]])
        head = ~same_key | np.concatenate([[False], region[1:] != region[:-1]])
        first = np.flatnonzero(head)
        lead = first[np.cumsum(head) - 1]
        later = doc > doc[lead]
        if later.any():
            yield _batch(_REGION, *(c[later] for c in (key, region, doc, at)), -size[later])
        # a group has several regions when one head follows another within it
        follows = same_key[first]
        several = follows.copy()
        several[:-1] |= follows[1:]
        several[0] |= open_
        last = first[-1]
        owners = ~later & several[np.cumsum(head) - 1]
        owners[last:] = False
        if owners.any():
            yield _batch(_REGION, *(c[owners] for c in rows))
        held, open_ = [c[last:][~later[last:]] for c in rows], bool(several[-1])
    if held is not None and open_:
        yield _batch(_REGION, *held)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_settle`` tells of coded rows, without the hashes that nobody asks for any more."""
    for batch in _settle(_decoded(batches)):
        key, _, doc, at, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        yield _batch(_FOUND, np.where(size > 0, key, 0), doc, at, size)


def _cut_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted regions of each document."""
    names, kinds = ["shard", "doc_id", "at", "piece"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for batch in batches:
        out = []
        for doc, tag, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "text", "wanted"))):
            raw = (text or "").encode()
            for w in wanted:
                if w["at"] // PLACE == tag:
                    start = w["at"] % PLACE
                    out.append((w["shard"], doc, w["at"], raw[start:start + w["size"]]))
            if len(out) > 20_000:
                yield rows(out)
                out = []
        if out:
            yield rows(out)


def _owned_strings(doc: np.ndarray, pieces: list[bytes], strings: bool):
    """Strings shared by the pieces: start places that a smaller id owns, and owners' strings.

    Returns the concatenated text's piece starts, the covered byte mask and,
    if asked for, (place, content hash) of each class at its owners.
    """
    sizes = np.array([len(p) for p in pieces])
    joined = np.frombuffer(b"\0".join(pieces) + b"\0\0", dtype=np.uint8).astype(np.int16) + 2
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    joined[begins + sizes] = 1  # between pieces
    joined[-1] = 0
    order = suffix_array(joined, 258, LENGTH)
    _, common = permuted_prefixes(joined, order, LENGTH)
    number = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes + 1)
    number = np.append(number, np.int32(len(pieces) - 1))
    fits = (begins + sizes)[number] - np.arange(len(joined)) >= LENGTH
    owner = doc[number[order]]
    breaks = np.concatenate([[True], common[order][1:] < LENGTH])
    first = np.flatnonzero(breaks)
    least = np.minimum.reduceat(owner, first)[np.cumsum(breaks) - 1]
    covered = np.zeros(len(joined), dtype=bool)
    covered[order[(owner > least)]] = True
    covered &= fits
    edge = np.zeros(len(joined) + LENGTH + 1, dtype=np.int8)
    hit = np.flatnonzero(covered)
    # a place is the start of one string and the end of one at most
    edge[hit] += 1
    edge[hit + LENGTH] -= 1
    mask = np.cumsum(edge, dtype=np.int32)[:len(joined)] > 0
    if not strings:
        return begins, number, mask, None, None
    at = np.flatnonzero(fits & ~covered)
    return begins, number, mask, at, K.span_hashes((joined - 2).astype(np.uint8), at, at + LENGTH)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole shards, as many at once as fit.  size < 0: covered; size > 0: an owner's string."""
    held: list[tuple] = []
    weight = 0

    def work() -> Iterator[pa.RecordBatch]:
        shard = np.array([h[0] for h in held], dtype=np.int64)
        doc = np.array([h[1] for h in held], dtype=np.int64)
        at = np.array([h[2] for h in held], dtype=np.int64)
        cut = (shard & 1) == 1  # a part of a group that was too large for one shard
        begins, number, mask, place, content = _owned_strings(doc, [h[3] for h in held], bool(cut.any()))
        step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
        start, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(start):
            own = number[start]
            d, a, s = _merged(doc[own], at[own] + start - begins[own], stop - start)
            yield _batch(_REGION, np.zeros(len(d), np.int64), np.zeros(len(d), np.int64), d, a, -s)
        if place is not None and len(place):
            own = number[place]
            place, content, own = place[cut[own]], content[cut[own]], own[cut[own]]
            yield _batch(_REGION, content, content, doc[own], at[own] + place - begins[own], np.full(len(own), LENGTH))

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "at", "piece"))):
            if held and weight > SHARD_BYTES and row[0] != held[-1][0]:
                yield from work()
                held, weight = [], 0
            held.append(row)
            weight += len(row[3])
    if held:
        yield from work()


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and text with its removed spans; rows come sorted by document and place."""
    held = None

    def rows(doc: np.ndarray, at: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        doc, at, size = _merged(doc, at, size)
        tag = at // PLACE
        cuts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]))
        edges = np.append(cuts, len(doc))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[cuts]), pa.array(tag[cuts]), K.long_lists(at % PLACE, edges),
             K.long_lists(at % PLACE + size, edges)], ["doc_id", "tag", "starts", "ends"])

    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        if not len(columns[0]):
            continue
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        held = [c[cut:] for c in columns]
        # of the last document only the union is kept, so that its many spans don't pile up
        held = list(_merged(*held))
        if cut:
            yield rows(*(c[:cut] for c in columns))
    if held is not None and len(held[0]):
        yield rows(*held)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.utf8(batch.column("text"))
        raw = memoryview(np.ascontiguousarray(data))
        starts, ends = batch.column("starts").to_pylist(), batch.column("ends").to_pylist()
        sizes, removed, spans, digests, kept = np.diff(offsets), [], [], [], []
        for i, size in enumerate(sizes):
            text, at, digest, rest = raw[offsets[i]:offsets[i + 1]], 0, hashlib.sha256(), []
            for a, b in zip(starts[i] or (), ends[i] or ()):
                rest.append(text[at:a])
                at = b
            rest.append(text[at:])
            for part in rest:
                digest.update(part)
            removed.append(int(size) - sum(map(len, rest)))
            spans.append(len(starts[i] or ()))
            digests.append(digest.hexdigest())
            kept.append(b"".join(rest))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, tag, starts, ends)``: disjoint byte spans to remove, for documents that have some.

    ``tag`` is a hash of the text; rows that share a doc_id but not the text
    are told apart by it.  Rows of the same doc_id never remove each other's
    bytes.  Rows without a doc_id take no part.
    """
    ship(docs.sparkSession)
    texts = docs.filter("doc_id is not null")
    dealt = texts.mapInArrow(_deal, _CODED).repartition("key").sortWithinPartitions("key", "region", "doc_id")
    settled = materialise(dealt.mapInArrow(_found, _FOUND), "regions", release=True)
    owners = settled.filter("size > 0")
    # a shard is a group, or a part of one that has too many regions; odd numbers mark parts
    large = owners.groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > GROUP_REGIONS)
    large = materialise(large, "large", release=True)
    owners = left_join_unique(owners, large, ["key"], F.col("doc_id"))
    part = F.pmod(F.xxhash64("at", "doc_id"), F.ceil(F.col("_n") / GROUP_REGIONS))
    shard = F.when(F.col("_n").isNull(), F.col("key").bitwiseAND(F.lit(-2))).otherwise(
        F.xxhash64("key", part).bitwiseOR(F.lit(1)))
    wanted = owners.withColumn("shard", shard).groupBy("doc_id").agg(
        F.collect_list(F.struct("at", "size", "shard")).alias("wanted"))
    # about one row for each document, so it grows with the texts and both sides shuffle at any size
    pieces = texts.join(wanted.hint("merge"), "doc_id").mapInArrow(_cut_bytes, "shard bigint, doc_id bigint, at bigint, piece binary")
    sorted_ = pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(_shards, _REGION)
    sorted_ = materialise(sorted_, "shards", release=True)
    strings = sorted_.filter("size > 0")
    owned = strings.groupBy("key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last")
    crossed = strings.join(owned, "key").filter("doc_id > owner").select("doc_id", "at", "size")
    covered = settled.unionByName(sorted_.drop("region")).filter("size < 0").select("doc_id", "at", (-F.col("size")).alias("size"))
    spans = covered.union(crossed).repartition("doc_id").sortWithinPartitions("doc_id", "at")
    return spans.mapInArrow(_union, "doc_id bigint, tag bigint, starts array<bigint>, ends array<bigint>")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` without bytes that a smaller doc_id already holds.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (binary)
    for every row.  Equal regions are told by their hash; suffix arrays, by
    induced sorting, are built where a group holds several different ones.

    A null text is empty; texts under 50 bytes and rows without doc_id stay
    whole.  Repeated rows give the same result each; texts that share a doc_id
    never remove each other's bytes.  Very long texts are looked at in
    overlapping pieces; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # 22 bits, so that a place stays below 2^62
    texts = texts.withColumn("tag", F.pmod(F.xxhash64("text"), F.lit(1 << 22)))
    spans = materialise(repeated_spans(texts), "spans", release=True)
    joined = left_join_unique(texts, spans, ["doc_id", "tag"], F.xxhash64("text"))
    return joined.select("doc_id", "text", "starts", "ends").mapInArrow(
        _apply, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
