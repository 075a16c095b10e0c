"""Which tokens of two tokenizers stand for the same text, over a whole corpus.

A chunk of documents is one set of Arrow arrays: ids are nested lists that are
flattened with their parent indices, byte ends are cumulative sums within each
document, and an Acero hash join on (document, end) finds the places where both
tokenizers end a token.  Between two such places lies a group, and every id of
one side is linked with every id of the other.

``Table.group_by`` counts the links of each document and the documents of each
pair of ids within a chunk; Spark adds those partial counts up over the corpus.
They come back to a chunk through its dictionary of distinct pairs, so a
document's links are never shuffled one by one.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship, short_batches

#: bytes of text whose tokens are aligned at once
CHUNK = 1 << 20
#: rows and bytes of text that a task is given at once: some chunks
BATCH_ROWS, BATCH_BYTES = 2_000, 4 * CHUNK
#: chunks that a reader holds at once
GROUP_ROWS = 8
#: links of a group from which on its distinct ids are paired instead of its tokens
WIDE = 4096
#: a pair of ids is one number: the second tokenizer's id in the low bits
LOW = 1 << 20

_CHUNK = ("chunk bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
          "digests array<string>, edges array<int>, refs array<int>, times array<bigint>, pairs array<bigint>, n_docs array<bigint>")
_RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
           "groups_sha256 string")


#: how byte-level definitions cut a text (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters outside the blocks whose letters and digits have long been settled; engines may class newer ones differently
_NEW = re.compile("[^\x00-\u052f\u2000-\u2bff\u3000-\u30ff\u4e00-\u9fcc\uac00-\ud7a3\U0001f110-\U0001faff]")


def _byte_letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer definition; encodes a space and the text.

    Where the ids are the ranks of the merges, an encoder that works on ranks
    gives the same ids in a quarter of the time; texts with characters that
    the two might class differently go to the definition's own library.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        # special tokens in a text are plain text
        self.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.pieces = pa.array(pieces, pa.large_binary())
        self.ranks = self._ranked(json.loads(definition), pieces)

    @staticmethod
    def _ranked(raw: dict, pieces: list[bytes]):
        """The rank encoder of a definition, or None if its ids are not the ranks of its merges."""
        model, cut = raw["model"], raw["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        plain = (model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and raw["normalizer"] is None
                 and cut is not None and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"])
        if not plain or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) \
                or sorted(pieces[:256]) != [bytes([b]) for b in range(256)]:
            return None
        import tiktoken
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces[:256 + len(merges)])},
                                 special_tokens={})

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.ranks is not None and not _NEW.search(text):
                out[i] = self.ranks.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int32)
            else:
                slow.append(i)
        if slow:
            found = self.tokenizer.encode_batch_fast([" " + texts[i] for i in slow], add_special_tokens=False)
            for i, encoding in zip(slow, found):
                out[i] = np.array(encoding.ids, dtype=np.int32)
        return out


class Pieces:
    """A sentence-piece model; it puts the space before the text itself."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.pieces = pa.array(pieces, pa.large_binary())

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(own, dtype=np.int32) for own in self.model.encode(texts, num_threads=1)]


@functools.lru_cache(maxsize=1)
def _models(first: str, second: bytes) -> tuple[ByteLevel, Pieces, _Writer]:
    """The tokenizers and the table of written ids, made once in a worker: those of its earlier tasks would stand beside them."""
    one, two = ByteLevel(first), Pieces(second)
    return one, two, _Writer(max(len(one.pieces), len(two.pieces)))


def _nested(ids: list[np.ndarray]) -> pa.ListArray:
    edges = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))


def _same_bytes(flat: pa.Array, parents: np.ndarray, pieces: pa.Array, raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether each document's token bytes, joined, are its bytes in ``raw``."""
    sizes = pc.binary_length(pieces).take(flat).to_numpy().astype(np.int64)
    good = np.bincount(parents, weights=sizes, minlength=len(edges) - 1).astype(np.int64) == np.diff(edges)
    # of documents of the right length the bytes lie at the same places
    fits = good[parents]
    joined = pieces.take(flat.filter(pa.array(fits)))
    joined = np.frombuffer(joined.buffers()[2], dtype=np.uint8)[:int(sizes[fits].sum())] if len(joined) else np.zeros(0, np.uint8)
    own = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    right = good[own]
    unequal = own[right][joined != raw[right]]
    good[unequal] = False
    return good


def _ends(ids: pa.ListArray, pieces: pa.Array) -> pa.Table:
    """Document, byte end within it and number of every token."""
    flat, parents = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.binary_length(pieces).take(flat).cast(pa.int64()))
    # a sum that starts again at each document: less what stood before the document
    first = ids.offsets.to_numpy()[:-1]
    sums = np.concatenate([[0], total.to_numpy(zero_copy_only=False)])
    before = pa.array(sums[first])
    return pa.table({"doc": parents.cast(pa.int64()), "end": pc.subtract(total, before.take(parents)),
                     "at": pa.array(np.arange(len(flat)))})


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each of ``sum(sizes)`` rows, and the row's number within it."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _links(a: np.ndarray, b: np.ndarray, a_edges: np.ndarray, b_edges: np.ndarray, doc: np.ndarray) -> pa.Table:
    """``(doc, pair, times)`` of the links of all groups, not yet added up."""
    n_a, n_b = np.diff(a_edges), np.diff(b_edges)
    wide = n_a * n_b > WIDE
    group, at = _spread(np.where(wide, 0, n_a * n_b))
    left, right = a[a_edges[group] + at // n_b[group]], b[b_edges[group] + at % n_b[group]]
    tables = [pa.table({"doc": doc[group], "pair": left.astype(np.int64) * LOW + right, "times": np.ones(len(group), np.int64)})]
    for g in np.flatnonzero(wide):
        x, nx = np.unique(a[a_edges[g]:a_edges[g + 1]], return_counts=True)
        y, ny = np.unique(b[b_edges[g]:b_edges[g + 1]], return_counts=True)
        pair = (x.astype(np.int64)[:, None] * LOW + y[None, :]).ravel()
        tables.append(pa.table({"doc": np.full(len(pair), doc[g]), "pair": pair, "times": np.outer(nx, ny).ravel().astype(np.int64)}))
    return pa.concat_tables(tables)


class _Writer:
    """Groups as text: a table of every id with each mark that can follow it, so the taken strings lie in a row."""

    def __init__(self, size: int):
        self.size = size
        self.table = pa.concat_arrays([pa.array([f"{i}{mark}" for i in range(size)], pa.large_string()) for mark in ",|;"]
                                      + [pa.array([str(i) for i in range(size)], pa.large_string())])

    def digests(self, a: np.ndarray, b: np.ndarray, a_edges: np.ndarray, b_edges: np.ndarray, doc: np.ndarray, count: int) -> list[str]:
        n_a, n_b = np.diff(a_edges), np.diff(b_edges)
        last = np.ones(len(doc), dtype=bool)
        last[:-1] = doc[1:] != doc[:-1]
        out = np.zeros(len(a) + len(b), dtype=np.int64)
        for ids, edges, other, sizes, final in ((a, a_edges, b_edges[:-1], n_a, np.ones(len(doc), np.int64)),
                                                (b, b_edges, a_edges[1:], n_b, np.where(last, 3, 2))):
            group, at = _spread(sizes)
            mark = np.where(at == sizes[group] - 1, final[group], 0)
            out[edges[group] + at + other[group]] = ids + mark * self.size
        taken = self.table.take(pa.array(out))
        offsets = np.frombuffer(taken.buffers()[1], dtype=np.int64)[:len(out) + 1]
        raw = memoryview(taken.buffers()[2]) if len(out) else memoryview(b"")
        tokens = np.searchsorted(doc, np.arange(count + 1))
        cuts = offsets[(a_edges + b_edges)[tokens]]
        return [hashlib.sha256(raw[x:y]).hexdigest() if y > x else "" for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _list(values, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def aligned_chunk(texts: list[str], first: ByteLevel, second: Pieces, writer: _Writer) -> dict:
    """Token groups of some documents: numbers per document, and the links of each by a dictionary of pairs."""
    raw = np.frombuffer("".join(" " + t for t in texts if t).encode(), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(t.encode()) + 1 if t else 0 for t in texts])])
    lists, good = [], np.array([bool(t) for t in texts])
    for tokenizer in (first, second):
        ids = _nested([own if t else own[:0] for own, t in zip(tokenizer.ids(texts), texts)])
        parents = pc.list_parent_indices(ids).to_numpy()
        good &= _same_bytes(pc.list_flatten(ids), parents, tokenizer.pieces, raw, edges)
        lists.append(ids)
    if not good.all():
        lists = [pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.where(good, ids.value_lengths().to_numpy(), 0))]).astype(np.int32)),
            pc.list_flatten(ids).filter(pa.array(good[pc.list_parent_indices(ids).to_numpy()]))) for ids in lists]
    ends_a, ends_b = (_ends(ids, t.pieces) for ids, t in zip(lists, (first, second)))
    cuts = ends_a.join(ends_b, keys=["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    cuts = cuts.take(pc.sort_indices(cuts, [("at", "ascending")]))
    a, b = (pc.list_flatten(ids).to_numpy(zero_copy_only=False).astype(np.int64) for ids in lists)
    a_edges = np.concatenate([[0], cuts["at"].to_numpy() + 1])
    b_edges = np.concatenate([[0], cuts["at_b"].to_numpy() + 1])
    doc = cuts["doc"].to_numpy()
    count = len(texts)
    sizes = np.diff(a_edges) * np.diff(b_edges)
    # links of each document, then documents of each pair
    links = _links(a, b, a_edges, b_edges, doc).group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    pairs = links.group_by(["pair"], use_threads=False).aggregate([("doc", "count")]).sort_by("pair")
    links = links.take(pc.sort_indices(links, [("doc", "ascending"), ("pair", "ascending")]))
    words = pairs["pair"].to_numpy()
    return {
        "n_a": np.diff(lists[0].offsets.to_numpy()), "n_b": np.diff(lists[1].offsets.to_numpy()),
        "n_groups": np.bincount(doc, minlength=count), "n_links": np.bincount(doc, weights=sizes, minlength=count).astype(np.int64),
        "digests": writer.digests(a, b, a_edges, b_edges, doc, count),
        "edges": np.searchsorted(links["doc"].to_numpy(), np.arange(count + 1)),
        "refs": np.searchsorted(words, links["pair"].to_numpy()), "times": links["times_sum"].to_numpy(),
        "pairs": words, "n_docs": pairs["doc_count"].to_numpy(),
    }


def _scored(chunk: pa.Table, known: pa.Table) -> pa.Table:
    """A row per document of a chunk: its links, with the corpus counts of their pairs."""
    value = lambda name: chunk.column(name)[0].values
    order = np.argsort(known.column("pair").to_numpy(), kind="stable")
    edges, refs, times = (value(c).to_numpy() for c in ("edges", "refs", "times"))
    sums = []
    for name in ("best", "n"):
        weight = known.column(name).to_numpy()[order].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(weight[refs] * times)]) if len(refs) else np.zeros(1, np.int64)
        sums.append(pa.array(total[edges[1:]] - total[edges[:-1]], pa.int64()))
    return pa.Table.from_arrays([value("doc_ids"), *(value(c) for c in ("n_a", "n_b", "n_groups", "n_links")), *sums, value("digests")],
                                [f.split(" ")[0] for f in _RESULT.split(", ")])


def token_alignment(docs: DataFrame, first: str, second: bytes) -> DataFrame:
    """Aligned tokens of every row of ``docs(doc_id, text)`` under two tokenizers.

    ``first`` is the text of a byte-level definition, ``second`` a
    sentence-piece model; they go to the tasks with the job.  Returns
    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.
    A pair's count is the number of documents that hold it linked, and a link
    is best if no other pair of its first id has a larger count.

    A null or empty text, and one that a tokenizer does not give back byte for
    byte, has no tokens: zeros and an empty string.  Repeated rows count as
    documents of their own, as do rows without doc_id.  A very long text is a
    chunk of its own; an empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((first, second))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, writer = _models(*shared.value)
        made = 0
        for batch in batches:
            _, offsets = K.utf8(batch.column("text"))
            for start, end, _, _ in K.chunks(np.zeros(0, np.uint8), offsets, CHUNK):
                texts = [t or "" for t in batch.column("text").slice(start, end - start).to_pylist()]
                found = aligned_chunk(texts, one, two, writer)
                number = pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64())
                made += 1
                kinds = {"digests": pa.string(), "edges": pa.int32(), "refs": pa.int32()}
                yield pa.RecordBatch.from_arrays(
                    [number, pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), batch.column("doc_id").slice(start, end - start)),
                     *(_list(v if k == "digests" else v.astype(np.int32 if k in kinds else np.int64), kinds.get(k, pa.int64()))
                       for k, v in found.items())],
                    [f.split(" ")[0] for f in _CHUNK.split(", ")])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with short_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        chunks = materialise(texts.mapInArrow(align, _CHUNK), "aligned", group_rows=GROUP_ROWS)
    partial = chunks.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p"))
    counts = partial.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.n_docs").alias("n"))
    counts = materialise(counts, "pair-counts")
    owner = F.shiftright("pair", 20)
    # no more rows than the first vocabulary has ids
    most = counts.groupBy(owner.alias("a")).agg(F.max("n").alias("most"))
    known = counts.withColumn("a", owner).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    asked = chunks.select("chunk", F.explode("pairs").alias("pair"))
    told = left_join_unique(asked, known, ["pair"], F.xxhash64("chunk"), "inner", small=False)
    told = told.select(F.col("chunk").alias("asker"), "pair", "n", "best")
    # a task holds one chunk and the counts of its pairs, however many chunks it is given
    return chunks.drop("pairs", "n_docs").groupBy("chunk").cogroup(told.groupBy("asker")).applyInArrow(_scored, _RESULT)
