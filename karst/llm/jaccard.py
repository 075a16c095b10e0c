"""N-gram Jaccard join: all documents whose word-shingle sets are similar, as links and components.

Exact set-similarity join that skips work by relations between sets:

1. Equal sets are one set (a fingerprint group), so copies are never compared.
2. Sets that agree on a few min-hash triples are compared with one pivot of
   their group.  Members that link with their pivot are its family.
3. What is left is found by inverted lists over the rarest shingles of each set
   (prefix filter).  Shingles of a single document cannot join anything and are
   dropped before a list is made.  Lists are sorted by size and position and
   read in blocks: a pair of blocks is skipped if the least positions in them
   leave too few shingles for any pair, and pairs inside a family are skipped.
   Lists of frequent shingles are cut into square cells of bounded size.
4. Candidates between families are first answered for the pivots.  With those
   overlaps and the differences of each member to its pivot, a member's answer
   is bounded from both sides; only where the bounds do not decide, the whole
   sets are compared.

Every plan is the same at any size: tables that grow with the documents meet by
sorted shuffles, and the only broadcast is a table of ``KNOWN`` counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.llm.components import components
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship

#: similarity as a fraction, 3/4
SHARE, WHOLE = 3, 4
#: min-hash pairs a set is grouped by, before the exact join
FAMILY_KEYS = 8
#: cells of a set's histogram, which bounds what two sets have in common
CELLS = 256
#: entries of one cell of a frequent shingle's list
CELL = 1024
#: shingles whose frequency rules their order; the order of the others is their hash
KNOWN = 200_000
#: occurrences within one task's block that make a shingle worth reporting
SEEN, BLOCK = 4, 3_000_000

_SKETCH = "kind int, doc_id bigint, n bigint, f1 bigint, f2 bigint, keys array<bigint>, cells binary"
_ENTRY = "token bigint, doc_id bigint, pos int"
_LISTED = "token bigint, node bigint, label bigint, n bigint, pos bigint, before bigint, earlier bigint"
_SHIPPED = "centre bigint, salt int, role int, node bigint, items array<bigint>"
_OVERLAP = "a bigint, b bigint, common bigint, na bigint, nb bigint"
_LINKED = f"common * {WHOLE} >= (na + nb - common) * {SHARE}"
#: entries of a list that are skipped or compared together
STEP = 64
#: members of one pivot that a task compares
STAR = 4096


def _doc_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray, np.ndarray]]:
    data, offsets = K.utf8(batch.column("text"))
    for first, end, part, bounds in K.chunks(data, offsets):
        hashes, edges = K.shingles(part, bounds)
        yield first, end, [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])], hashes, edges


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((2, len(sets)), dtype=np.uint64)
    for i, values in enumerate(sets):
        if len(values):
            out[0, i] = np.add.reduce(K.mix(values ^ np.uint64(0x5851F42D4C957F2D)))
            out[1, i] = np.add.reduce(K.mix(values + np.uint64(0x14057B7EF767814F)))
    return out[0], out[1]


def _families(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Min-hash pairs of each document; documents without shingles are left out by the caller."""
    filled = np.flatnonzero(np.diff(edges))
    keys = np.zeros((len(edges) - 1, FAMILY_KEYS), dtype=np.uint64)
    if not len(filled):
        return keys
    for k in range(FAMILY_KEYS):
        for half in range(2):
            seed = np.uint64((2 * (2 * k + half) + 1) * 0xA24BAED4963EE407 % (1 << 64))
            least = np.minimum.reduceat(K.mix(hashes ^ seed), edges[filled])
            keys[filled, k] = K.mix(keys[filled, k] * np.uint64(3) + least + np.uint64(k))
    return keys


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (kind 0) and a row per shingle frequent in a block (kind 1)."""
    names = [field.split(" ")[0] for field in _SKETCH.split(", ")]
    pending: list[np.ndarray] = []
    waiting = 0

    def frequent() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(pending), return_counts=True)
        values, counts = values[counts >= SEEN], counts[counts >= SEEN]
        zeros = pa.array(np.zeros(len(values), np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(values), np.int32)), zeros, pa.array(counts.astype(np.int64)),
             pa.array(K.signed(values)), zeros, pa.nulls(len(values), pa.list_(pa.int64())), pa.nulls(len(values), pa.binary())],
            names)

    for batch in batches:
        ids = batch.column("doc_id")
        for first, end, sets, hashes, edges in _doc_sets(batch):
            one, two = _fingerprints(sets)
            count = end - first
            keys = _families(hashes, edges)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(count, np.int32)), ids.slice(first, count),
                 pa.array(np.array([len(s) for s in sets], dtype=np.int64)), pa.array(K.signed(one)),
                 pa.array(K.signed(two)), K.long_lists(keys.ravel(), np.arange(count + 1) * FAMILY_KEYS),
                 pa.array([np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=CELLS), 255)
                           .astype(np.uint8).tobytes() for s in sets], pa.binary())], names)
            pending += sets
            waiting += len(hashes)
            if waiting > BLOCK:
                yield frequent()
                pending, waiting = [], 0
    if pending:
        yield frequent()


def _prefixes(known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of every set, as many as a similar set must share one of.  Of equal sets of a batch one is listed.

    ``pos`` is the shingle's place in the order of its set; of a shingle known
    to be frequent, and so shared for sure, it is -1 - place.
    """
    values, counts = known.value
    for batch in batches:
        ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        for first, end, sets, _, _ in _doc_sets(batch):
            one, _ = _fingerprints(sets)
            least: dict[int, int] = {}
            for i in np.argsort(ids[first:end], kind="stable").tolist():
                if len(sets[i]) and not missing[first + i]:
                    least.setdefault(int(one[i]), i)
            tokens, places, owner = [], [], []
            for i in sorted(least.values()):
                s = sets[i]
                at = np.minimum(np.searchsorted(values, s), max(len(values) - 1, 0))
                often = np.where(values[at] == s, counts[at], 0) if len(values) else np.zeros(len(s), np.int64)
                take = len(s) - (-(-SHARE * len(s) // WHOLE)) + 1
                order = np.argsort(often, kind="stable")[:take]
                tokens.append(s[order])
                places.append(np.where(often[order] > 0, -1 - np.arange(take), np.arange(take)))
                owner.append(np.full(take, ids[first + i]))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(np.concatenate(tokens))), pa.array(np.concatenate(owner)),
                     pa.array(np.concatenate(places).astype(np.int32))], ["token", "doc_id", "pos"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of shingles that stand in several documents; rows come sorted by shingle."""
    held, given = None, False

    def out(token: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(doc), pa.array(np.where(pos < 0, -1 - pos, pos).astype(np.int32))],
                                          ["token", "node", "pos"])

    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        if held is not None:
            rows = [np.concatenate([h, c]) for h, c in zip(held, rows)]
        token, _, pos = rows
        if not len(token):
            continue
        same = token[1:] == token[:-1]
        several = (pos < 0) | np.concatenate([same, [False]]) | np.concatenate([[False], same])
        # the last row waits for its next one, unless it is known to be shared
        last = bool(several[-1])
        several[0] &= not given or held is None
        several[-1] &= last and not (given and len(token) == 1)
        if several.any():
            yield out(*(c[several] for c in rows))
        held, given = [c[-1:] for c in rows], last or (given and len(token) == 1)


def _cut_lists(known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """List entries; a frequent shingle's list is a triangle of cells, and a set goes to the cells of its row.

    Rows come sorted by set and position.  ``before`` and ``earlier`` are
    the two listed shingles of the set that come before it, 0 where there is none.
    """
    values, counts = known.value
    last = np.zeros((2, 0), np.int64)
    for batch in batches:
        token, node, label, n, pos = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("token", "node", "label", "n", "pos"))
        if not len(token):
            continue
        # the last two rows of the batch before come first
        kept = last.shape[1]
        owners, words = np.concatenate([last[0], node]), np.concatenate([last[1], token])
        place = np.arange(kept, len(owners))
        previous = []
        for step in (1, 2):
            at = np.maximum(place - step, 0)
            previous.append(np.where((place >= step) & (owners[at] == node), words[at], 0))
        last = np.stack([owners[-2:], words[-2:]])
        word = token.view(np.uint64)
        at = np.minimum(np.searchsorted(values, word), max(len(values) - 1, 0))
        often = np.where(values[at] == word, counts[at], 0) if len(values) else np.zeros(len(word), np.int64)
        grid = np.maximum(-(-often // CELL), 1)
        row = (K.mix(node.astype(np.uint64)) % grid.astype(np.uint64)).astype(np.int64)
        entry = np.repeat(np.arange(len(token)), grid)
        cell = np.arange(len(entry)) - np.repeat(np.cumsum(grid) - grid, grid)
        low, high = np.minimum(row[entry], cell).astype(np.uint64), np.maximum(row[entry], cell).astype(np.uint64)
        name = np.where(grid[entry] > 1, K.mix(word[entry] ^ K.mix(low * np.uint64(1 << 32) + high + np.uint64(1))), word[entry])
        yield pa.RecordBatch.from_arrays([pa.array(K.signed(name)), *(pa.array(c[entry]) for c in (node, label, n, pos, *previous))],
                                         [field.split(" ")[0] for field in _LISTED.split(", ")])


def _block_pairs(label: np.ndarray, size: np.ndarray, place: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one long list, block by block; entries are sorted by size and position."""
    cuts = np.arange(0, len(size), STEP)
    low, high = size[cuts], size[np.minimum(cuts + STEP, len(size)) - 1]
    # the most that a set of the block can share from its position on
    room = np.maximum.reduceat(size - place, cuts)
    found = []
    for i in range(len(cuts)):
        x = np.arange(cuts[i], min(cuts[i] + STEP, len(size)))
        for j in range(i, len(cuts)):
            if WHOLE * high[i] < SHARE * low[j]:
                break
            if min(room[i], room[j]) * (SHARE + WHOLE) < SHARE * (low[i] + low[j]):
                continue
            y = np.arange(cuts[j], min(cuts[j] + STEP, len(size)))
            a, b = x[:, None], y[None, :]
            reach = np.minimum((size - place)[a], (size - place)[b])
            good = ((a < b) & (WHOLE * size[a] >= SHARE * size[b]) & (reach * (SHARE + WHOLE) >= SHARE * (size[a] + size[b]))
                    & (label[a] != label[b]))
            at = np.nonzero(good)
            if len(at[0]):
                found.append((x[at[0]], y[at[1]]))
    return found


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of list entries that can still reach the threshold.

    Entries come sorted by list, size and position.  In a short list an entry
    is compared with the one at distance 1, 2 and so on, while that one is not
    too large.  A long list is read in pairs of blocks.  The bound on positions
    is that of a pair's first common shingle, where it is found.

    A pair that shares one of the two shingles before an entry met in that
    shingle's list already, at smaller places and so with more room, and is not
    given again: similar sets share long runs of shingles.
    """
    carry: list[np.ndarray] | None = None

    def pairs(columns: list[np.ndarray]) -> pa.RecordBatch | None:
        token, node, label, size, place, before, earlier = columns
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        lengths = np.diff(np.append(starts, len(token)))
        live, step, found = np.flatnonzero(np.repeat(lengths <= STEP, lengths)), 0, []
        while len(live):
            step += 1
            live = live[live + step < len(token)]
            other = live + step
            near = (token[live] == token[other]) & (WHOLE * size[live] >= SHARE * size[other])
            live, other = live[near], other[near]
            reach = np.minimum(size[live] - place[live], size[other] - place[other])
            good = (reach * (SHARE + WHOLE) >= SHARE * (size[live] + size[other])) & (label[live] != label[other])
            found.append((live[good], other[good]))
        for at in np.flatnonzero(lengths > STEP):
            own = slice(starts[at], starts[at] + lengths[at])
            found += [(x + starts[at], y + starts[at]) for x, y in _block_pairs(label[own], size[own], place[own])]
        new = []
        for x, y in found:
            met = (before[x] == before[y]) & (before[x] != 0)
            for one, two in ((before, earlier), (earlier, before), (earlier, earlier)):
                met |= (one[x] == two[y]) & (one[x] != 0)
            new.append((x[~met], y[~met]))
        if not any(len(x) for x, _ in new):
            return None
        x, y = (node[np.concatenate([f[k] for f in new])] for k in (0, 1))
        x, y = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        first = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        return pa.RecordBatch.from_arrays([pa.array(x[first]), pa.array(y[first])], ["a", "b"])

    names = [field.split(" ")[0] for field in _LISTED.split(", ")]
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]
        if carry is not None:
            columns = [np.concatenate([old, new]) for old, new in zip(carry, columns)]
        cut = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
        carry = [c[cut:] for c in columns]
        if cut and (out := pairs([c[:cut] for c in columns])) is not None:
            yield out
    if carry is not None and len(carry[0]) and (out := pairs(carry)) is not None:
        yield out


def _ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole set of each text, once for every star that it is part of."""
    names = [field.split(" ")[0] for field in _SHIPPED.split(", ")]
    for batch in batches:
        ids, wanted = batch.column("doc_id"), batch.column("f1").to_numpy(zero_copy_only=False)
        stars = batch.column("stars")
        for first, end, sets, _, _ in _doc_sets(batch):
            one, _ = _fingerprints(sets)
            right = K.signed(one) == wanted[first:end]
            own = stars.slice(first, end - first)
            sizes = own.value_lengths().to_numpy(zero_copy_only=False) * right
            flat = pa.StructArray.from_arrays(own.flatten().flatten(), ["centre", "salt", "role"]).filter(
                pa.array(np.repeat(right, own.value_lengths().to_numpy(zero_copy_only=False))))
            row = np.repeat(np.arange(end - first), sizes)
            for lo in range(0, len(row), 512):
                part = row[lo:lo + 512]
                edges = np.concatenate([[0], np.cumsum([len(sets[i]) for i in part])])
                piece = flat.slice(lo, len(part))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.field(k) for k in range(3)), ids.slice(first, end - first).take(pa.array(part)),
                     K.long_lists(np.concatenate([sets[i] for i in part]), edges)], names)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of each star's members with its centre; rows come sorted by star, the centre first."""
    star, held, node = None, None, None
    for batch in batches:
        centre, salt, role, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        items = batch.column("items")
        flat = items.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        edges = np.concatenate([[0], np.cumsum(items.value_lengths().to_numpy(zero_copy_only=False))])
        rows = []
        for i in range(batch.num_rows):
            values = flat[edges[i]:edges[i + 1]]
            if role[i] == 0:
                if star != (centre[i], salt[i]):
                    star, held, node = (centre[i], salt[i]), values.copy(), own[i]
            elif star == (centre[i], salt[i]) and own[i] != node:
                at = np.minimum(np.searchsorted(held, values), len(held) - 1)
                rows.append((centre[i], own[i], int((held[at] == values).sum()), len(held), len(values)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b", "common", "na", "nb"])


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose histograms allow the threshold: equal shingles lie in equal cells."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, CELLS).astype(np.int64)
                for c in ("_x", "_y"))
        na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_na", "_nb"))
        common = np.where((x == 255) & (y == 255), np.minimum(na, nb)[:, None], np.minimum(x, y)).sum(axis=1)
        common = np.minimum(common, np.minimum(na, nb))
        good = pa.array(common * WHOLE >= (na + nb - common) * SHARE)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], ["a", "b"])


def _plausible(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` that their histograms do not rule out."""
    side = lambda end, n, cells: sets.select(F.col("node").alias(end), F.col("n").alias(n), F.col("cells").alias(cells)).hint("merge")
    checked = pairs.join(side("a", "_na", "_x"), "a").join(side("b", "_nb", "_y"), "b").mapInArrow(_possible, "a bigint, b bigint")
    return materialise(checked.distinct(), "plausible")


def _overlaps(texts: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b, common, na, nb)``: what the whole sets of the written, distinct ``pairs(a, b)`` share.

    ``a`` is the centre of a star; its set is sent once for ``STAR`` members,
    theirs once for each star.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    dealt = left_join_unique(pairs, materialise(parts, "stars"), ["a"], F.col("b"), small=False)
    members = dealt.select(F.col("b").alias("doc_id"), F.struct(F.col("a").alias("centre"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"),
                                                               F.lit(1).alias("role")).alias("star"))
    centres = parts.select(F.col("a").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")).select(
        "doc_id", F.struct(F.col("doc_id").alias("centre"), "salt", F.lit(0).alias("role")).alias("star"))
    asked = members.union(centres).groupBy("doc_id").agg(F.collect_list("star").alias("stars"))
    asked = asked.join(sets.select(F.col("node").alias("doc_id"), "f1").hint("merge"), "doc_id")
    shipped = texts.join(asked.hint("merge"), "doc_id").mapInArrow(_ship, _SHIPPED)
    stars = shipped.repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role").mapInArrow(_compare, _OVERLAP)
    return materialise(stars.dropDuplicates(["a", "b"]), "overlaps")


def _near_pivots(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """Overlaps of linked sets with a pivot of theirs: one comparison for each set and family key, with the smallest set."""
    keyed = sets.select("node", "n", F.posexplode("keys").alias("slot", "key"))
    pivots = keyed.groupBy("slot", "key").agg(F.min(F.struct("node", "n")).alias("p"), F.count("*").alias("c")).filter("c > 1")
    # a family with many members: its one pivot row is repeated for each part
    close = left_join_unique(keyed, materialise(pivots.drop("c"), "pivots"), ["slot", "key"], F.col("node"), "inner", small=False)
    close = close.filter(f"node <> p.node and {WHOLE} * least(n, p.n) >= {SHARE} * greatest(n, p.n)")
    close = materialise(close.select(F.col("p.node").alias("a"), F.col("node").alias("b")).distinct(), "close")
    return _overlaps(texts, sets, close).filter(_LINKED)


def _families_of(sets: DataFrame, near: DataFrame) -> DataFrame:
    """``(node, n, label, pivot, common, n_pivot)``: each set's family and what it shares with its pivot; a set without one is its own."""
    labels = materialise(components(near.select("a", "b")), "families")
    chosen = near.groupBy("b").agg(F.min(F.struct("a", "common", "na")).alias("p"))
    families = sets.select("node", "n").join(labels.hint("merge"), "node", "left").join(
        chosen.select(F.col("b").alias("node"), "p").hint("merge"), "node", "left")
    return materialise(families.select(
        "node", "n", F.coalesce("component", "node").alias("label"), F.coalesce("p.a", "node").alias("pivot"),
        F.coalesce("p.common", "n").alias("common"), F.coalesce("p.na", "n").alias("n_pivot")), "labelled")


def _listed_pairs(texts: DataFrame, families: DataFrame, known) -> DataFrame:
    """Distinct pairs between families that the inverted lists allow."""
    entries = texts.mapInArrow(lambda batches: _prefixes(known, batches), _ENTRY)
    # shingles known to be shared need not meet here, so they go by document
    entries = entries.repartition(F.when(F.col("pos") < 0, F.xxhash64("doc_id")).otherwise(F.col("token"))).sortWithinPartitions("token")
    # copies end here: only the least document of a set is a node
    shared = entries.mapInArrow(_shared, "token bigint, node bigint, pos int").join(
        families.select("node", "label", "n").hint("merge"), "node")
    # the join left the rows by node
    ordered = shared.select("token", "node", "label", "n", "pos").sortWithinPartitions("node", "pos")
    lists = ordered.mapInArrow(lambda batches: _cut_lists(known, batches), _LISTED)
    lists = lists.repartition("token").sortWithinPartitions("token", "n", "pos")
    return materialise(lists.mapInArrow(_candidates, "a bigint, b bigint").distinct(), "candidates")


def _derived(texts: DataFrame, sets: DataFrame, families: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of the pivots of ``pairs(a, b)``, and ``(a, b, verdict)``: 1 linked, -1 not, 0 not decided by what the pivots share."""
    side = lambda x: families.select(F.col("node").alias(x), F.struct("pivot", "n", "common", "n_pivot").alias(f"_{x}")).hint("merge")
    asked = materialise(pairs.join(side("a"), "a").join(side("b"), "b").withColumns({
        "p": F.least("_a.pivot", "_b.pivot"), "q": F.greatest("_a.pivot", "_b.pivot")}), "asked")
    first = asked.filter("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()
    answers = _overlaps(texts, sets, materialise(first, "pivot-pairs"))
    told = left_join_unique(asked, answers.select(F.col("a").alias("p"), F.col("b").alias("q"), F.col("common").alias("c")), ["p", "q"],
                            F.xxhash64("a", "b"), small=False)
    # what a pair shares differs from what its pivots share by no more than the members differ from them
    most = F.col("c") + (F.col("_a.n") - F.col("_a.common")) + (F.col("_b.n") - F.col("_b.common"))
    least = F.col("c") - (F.col("_a.n_pivot") - F.col("_a.common")) - (F.col("_b.n_pivot") - F.col("_b.common"))
    total = F.col("_a.n") + F.col("_b.n")
    links = lambda shared: shared * WHOLE >= (total - shared) * SHARE
    verdict = F.when(links(least), 1).when(links(most) | F.col("c").isNull(), 0).otherwise(-1)
    return answers.filter(_LINKED).select("a", "b"), materialise(told.select("a", "b", verdict.alias("verdict")), "told")


def similar_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, distinct sets and links of ``docs(doc_id, text)``.

    Rows are ``(doc_id, n, f1, f2)``, sets ``(f1, f2, node, n)`` with the least
    doc_id of a set as its node, links ``(a, b)`` of nodes: families are linked
    through their pivots, and every link between different families is there.

    Each step is a function that returns a written table, so that Spark can
    let go of a step's shuffles once it is over.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    ship(spark)
    sketch = materialise(texts.mapInArrow(_sketch, _SKETCH), "sketch")
    filled = sketch.filter("kind = 0 and n > 0 and doc_id is not null")
    sets = materialise(filled.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("cells").alias("cells")), "distinct-sets")
    often = (sketch.filter("kind = 1").groupBy(F.col("f1").alias("token")).agg(F.sum("n").alias("often"))
             .orderBy(F.desc("often"), "token").limit(KNOWN).toPandas())
    values = often["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    known = spark.sparkContext.broadcast((values[order], often["often"].to_numpy(dtype=np.int64)[order]))

    near = _near_pivots(texts, sets)
    families = _families_of(sets, near)
    pairs = _plausible(sets, _listed_pairs(texts, families, known))
    answers, told = _derived(texts, sets, families, pairs)
    rest = _overlaps(texts, sets, materialise(told.filter("verdict = 0").select("a", "b").distinct(), "undecided"))
    found = near.select("a", "b").union(answers).union(told.filter("verdict = 1").select("a", "b")).union(
        rest.filter(_LINKED).select("a", "b"))
    rows = sketch.filter("kind = 0").select("doc_id", "n", "f1", "f2")
    return rows, sets.select("f1", "f2", "node", "n"), materialise(found.distinct(), "verified")


def similar_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    A document's set holds its distinct lower-cased five-word shingles; fewer
    words are one shingle.  Two documents link at a Jaccard similarity of 3/4
    or more; ``component_id`` is the smallest doc_id reachable by links.

    Null and empty texts have no shingles and stand alone.  Repeated rows come
    back as often as they came in, with the same component.  Rows that share a
    doc_id but not the text each get the component of their own text.  A row
    without doc_id takes part through its copies only and has a null component
    when it has none.  Very long texts are sets like others; an empty table
    gives no rows; other columns are ignored.
    """
    rows, sets, links = similar_links(docs)
    reps = sets.join(components(links).hint("merge"), "node", "left").select(
        "f1", "f2", F.coalesce("component", "node").alias("component_id"))
    out = left_join_unique(rows, materialise(reps, "representatives"), ["f1", "f2"], F.col("doc_id"), small=False)
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
