"""Difference-cover dedup, token alignment and the filter audit against plain versions."""

import hashlib
import os
import re
from collections import Counter
from itertools import permutations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from karst.llm import anchors
from karst.llm.alignment import ByteLevel, Pieces, _Writer, aligned_chunk, token_alignment
from karst.llm.anchors import COVER, PERIOD, without_windows
from karst.llm.filters import filter_audit, removal_steps
from karst.llm.queries import ORACLES, QUERIES, alignment_models
from karst.session import materialise

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, key int, at int, chunk string, part string, tag int, n int"
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(40_000))
SHARED = " ".join(f"shared{i}" for i in range(60))
TAIL = " ".join(f"t{i}" for i in range(19))
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two", "a"), (5, LONG, "b"), (6, LONG + " tail", "b"), (7, SHARED, "b"),
    (7, SHARED, "b"), (7, "other " + SHARED, ""), (8, "Unique start here " + SHARED, "c"), (9, SHARED.upper(), None), (10, "aaaa" * 400, "c"),
    (11, "x " * 500, "c"), (12, "é ß 日本語 \U0001f600 " * 30, "c"), (None, SHARED, "b"), (None, None, None), (13, "one two", "a"),
    (14, "a▁b <|endoftext|> <s> <0x41> \x00 ﬁ  ", "d"), (15, TAIL, "d"), (16, TAIL, "d"), (17, f"{TAIL} end {TAIL} end", "d"),
    (18, f"{TAIL} end", "e"), (20, "The CAPS & More " * 20, "e"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", s, 1, 2, "c", "p", 3, 4) for i, t, s in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# difference-cover anchors

def plain_windows(rows, width=20):
    """(id, text) of distinct texts to (words, removed, hash of the rest); ids may be shared by different texts."""
    first, out = {}, {}
    split = {(i, t): [w.group() for w in WORD.finditer(t or "")] for i, t in rows}
    for key in sorted((k for k in split if k[0] is not None), key=lambda k: k[0]):
        for at in range(len(split[key]) - width + 1):
            window = tuple(split[key][at:at + width])
            first.setdefault(window, {}).setdefault(key, at)
    least = {w: min(k[0] for k in held) for w, held in first.items()}
    for key, words in split.items():
        gone = set()
        for at in range(len(words) - width + 1) if key[0] is not None else ():
            window = tuple(words[at:at + width])
            if least[window] < key[0] or first[window][key] < at:
                gone.update(range(at, at + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[key] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_cover_meets_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))
    assert anchors.ANCHOR + PERIOD - 1 == anchors.WINDOW


@pytest.mark.parametrize("batch", [3, 10_000])
def test_windows_like_plain_removal(spark, docs, odd, empty, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        plain = {k[0]: v[:3] for k, v in plain_windows(rows).items()}
        found = without_windows(docs.repartition(4), text=False).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == plain and len(found) == len(rows)
        assert any(v[1] for v in plain.values())
        plain = plain_windows([(i, t) for i, t, _ in ODD])
        wanted = Counter((i, *plain[i, t][:3]) for i, t, _ in ODD)
        found = without_windows(odd).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == wanted
        texts = {hashlib.sha256(v[3].encode()).hexdigest(): v[3] for v in plain.values()}
        assert all(bytes(r.kept).decode() == texts[r.kept_sha256] if r.n_removed else r.kept is None for r in found)
        assert without_windows(empty).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_windows_of_random_texts(spark):
    """Few words, so matches of all lengths at all shifts, within and across documents."""
    random = np.random.default_rng(3)
    base = [str(w) for w in random.integers(0, 50, 400)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(random.integers(1, 6)):
            at = int(random.integers(0, 360))
            parts += base[at:at + int(random.integers(5, 40))] + [f"u{random.integers(0, 9)}"] * int(random.integers(0, 3))
        rows.append((i, " ".join(parts)))
    plain = {k[0]: v[:3] for k, v in plain_windows(rows).items()}
    found = without_windows(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == plain


# alignment

def plain_alignment(texts):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    from tokenizers.decoders import ByteLevel as Decoder
    piece = lambda i: bytes([int(two.id_to_piece(i)[3:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    plain_letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain_letters}
    letters.update((chr(256 + n), b) for n, b in enumerate(b for b in range(256) if b not in plain_letters))
    assert Decoder().decode([one.id_to_token(464)]) == "The"
    groups, holds = [], Counter()
    for text in texts:
        own = []
        if text:
            a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, piece(i)) for i in two.encode(text)]
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) == raw and b"".join(x for _, x in b) == raw:
                ends = [list(np.cumsum([len(x) for _, x in side])) for side in (a, b)]
                at = [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    new = [ends[s].index(cut, at[s]) + 1 for s in (0, 1)]
                    own.append(([i for i, _ in a[at[0]:new[0]]], [i for i, _ in b[at[1]:new[1]]]))
                    at = new
        groups.append(own)
        holds.update({(x, y) for left, right in own for x in left for y in right})
    best = {}
    for (x, _), n in holds.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for own in groups:
        links = [(x, y) for left, right in own for x in left for y in right]
        line = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in own)
        out.append((sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(links), sum(holds[p] == best[p[0]] for p in links),
                    sum(holds[p] for p in links), hashlib.sha256(line.encode()).hexdigest() if own else ""))
    return out


def test_alignment_holds_a_chunk_at_a_time(spark, monkeypatch):
    """Many chunks in one partition: none of the steps is given all of them at once."""
    import glob

    import pyarrow.parquet as pq

    from karst.llm import alignment
    from karst.session import ARROW_BYTES, ARROW_ROWS, posix_path, short_batches
    monkeypatch.setattr(alignment, "CHUNK", 100)
    texts = [f"Text number {i}, of some words and {i * 7919} more." for i in range(100)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    written = []
    monkeypatch.setattr(alignment, "materialise", lambda df, label, **how: written.append(materialise(df, label, **how)) or written[-1])
    found = token_alignment(rows, *alignment_models())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan.replace("FlatMapCoGroupsInArrow", "")
    groups = [pq.ParquetFile(f).metadata for path in written[0].inputFiles() for f in glob.glob(posix_path(path))]
    assert sum(g.num_rows for g in groups) > 20
    assert all(g.row_group(i).num_rows <= alignment.GROUP_ROWS for g in groups for i in range(g.num_row_groups))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r[c] for c in columns) for r in found.collect()} == dict(enumerate(plain_alignment(texts)))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    wide = spark.range(0, 600, 1, 1).selectExpr("repeat('x', 10000 * int(id >= 300)) AS text")
    before = [spark.conf.get(key, None) for key in (ARROW_ROWS, ARROW_BYTES)]
    with short_batches(spark, 100, 200_000):
        held = materialise(wide.mapInArrow(sizes, "n bigint, size bigint"), "sizes").collect()
    assert sum(r.n for r in held) == 600 and max(r.n for r in held) == 100 and max(r["size"] for r in held) < 400_000
    assert [spark.conf.get(key, None) for key in (ARROW_ROWS, ARROW_BYTES)] == before


def test_alignment_like_plain_version(spark, docs, odd, empty):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = docs.select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r[c] for c in columns) for r in token_alignment(docs.repartition(3), *alignment_models()).collect()}
    assert found == {r.doc_id: p for r, p in zip(rows, plain_alignment([r.text for r in rows]))}
    plain = Counter((i, *p) for (i, _, _), p in zip(ODD, plain_alignment([t for _, t, _ in ODD])))
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in token_alignment(odd, *alignment_models()).collect()) == plain
    assert token_alignment(empty, *alignment_models()).count() == 0


def test_rank_encoder_like_the_definition():
    """Every character of the settled blocks, in runs and beside letters, digits and spaces; long runs."""
    from karst.llm.alignment import _NEW
    one = ByteLevel(alignment_models()[0])
    settled = [chr(c) for c in range(0x1fb00) if not 0xd800 <= c < 0xe000 and not _NEW.match(chr(c))]
    texts = ["".join(f"a{c}b {c}{c} 1{c}?" for c in settled[i:i + 300]) for i in range(0, len(settled), 300)]
    texts += ["a" * 3000, " " * 3000 + "x", "ab1!" * 900, "<|endoftext|> it's", "\t\n  \r x", "ꯍ new 🯳"]
    own = one.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert one.ranks is not None and [list(i) for i in one.ids(texts)] == [e.ids for e in own]
    assert ByteLevel(alignment_models()[0].replace('"add_prefix_space":false', '"add_prefix_space":true')).ranks is None


def test_wide_groups_pair_distinct_ids(monkeypatch):
    from karst.llm import alignment
    one, two = (kind(model) for kind, model in zip((ByteLevel, Pieces), alignment_models()))
    texts = ["日本語テキスト" * 20, "", "naïve café \U0001f600\U0001f600 words"]
    writer = _Writer(max(len(one.pieces), len(two.pieces)))
    narrow = aligned_chunk(texts, one, two, writer)
    monkeypatch.setattr(alignment, "WIDE", 0)
    wide = aligned_chunk(texts, one, two, writer)
    assert all(list(narrow[k]) == list(wide[k]) for k in narrow) and narrow["n_links"][0] > 0


# filter audit

def plain_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails, parts = [], sorted({s or "" for _, _, s in rows})
    for i, t, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        fails.append({"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                      "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                      "E": i is not None and first[t] < i})
    out = {}
    for part in parts:
        own = [(f, *labels.get(i, (0, 0))) for (i, _, s), f in zip(rows, fails) if (s or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, name in enumerate(order, 1):
                gone = [x for x in left if x[0][name]]
                redundant = sum(x[0][name] for x in own) - len(gone)
                left = [x for x in left if not x[0][name]]
                shapley[name] += len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(x[0][name] and sum(x[0].values()) == 1 for x in own),
                                          sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_removal_step_is_the_first_failed_filter():
    orders, steps = removal_steps(5)
    assert len(orders) == 120 and steps.shape == (32, 120) and (steps[0] == 6).all()
    for mask in range(1, 32):
        assert [int(s) for s in steps[mask]] == [min(o.index(f) + 1 for f in range(5) if mask >> f & 1) for o in orders]


def test_audit_like_plain_version(spark, docs, odd, empty):
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    labels = spark.createDataFrame([(i, None if i == 9 else i % 2, i % 3 == 0) for i in range(1, 21)] + [(5, 0, False), (None, 1, True)],
                                   "doc_id bigint, quality int, toxic boolean").selectExpr("doc_id", "quality", "int(toxic) as toxic")
    marks = {r.doc_id: (int(r.q == 1), r.t) for r in labels.groupBy("doc_id").agg({"quality": "max", "toxic": "max"}).toDF("doc_id", *(
        ("q", "t") if labels.groupBy("doc_id").agg({"quality": "max", "toxic": "max"}).columns[1] == "max(quality)" else ("t", "q"))).collect()}
    marks.pop(None)
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in filter_audit(odd, labels).collect()}
    assert found == plain_audit(ODD, marks)
    assert filter_audit(empty, labels).count() == 0
    assert filter_audit(odd, labels.limit(0)).count() == len(found)


@pytest.mark.parametrize("name", ["op13_filter_audit"])
def test_sql(spark, name):
    from compare import connect, difference
    assert difference(spark, connect(SF), QUERIES[name], ORACLES[name], SF) is None


# suffix arrays in bounded memory

def test_a_shard_stays_small():
    import tracemalloc
    from karst.llm import repeats
    random = np.random.default_rng(5)
    base = random.integers(97, 101, 5000).astype(np.uint8).tobytes()
    pieces, size = [], 0
    while size < repeats.SHARD_BYTES:
        at = int(random.integers(0, 4900))
        pieces.append(base[at:at + 90] + random.integers(97, 123, 20).astype(np.uint8).tobytes())
        size += len(pieces[-1])
    doc = np.arange(len(pieces))
    repeats.K.powers(10)
    tracemalloc.start()
    repeats._owned_strings(doc, pieces, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    text = random.integers(97, 123, repeats.PIECE).astype(np.uint8)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "tag": [1, 2], "text": [text.tobytes().decode()] * 2})
    rows = sum(b.num_rows for b in repeats._deal(iter([batch])))
    assert rows and peak < 150 << 20 and tracemalloc.get_traced_memory()[1] < 150 << 20, (peak, tracemalloc.get_traced_memory())
    tracemalloc.stop()


def test_regions_on_their_way():
    from karst.llm import repeats
    places = np.array([0, 5, (1 << 31) - 60, 7, (1 << 31) - 1]) + np.array([0, 1, (1 << 22) - 1, 3, 9]) * repeats.PLACE
    doc, hashes = np.array([3, -4, 1 << 62, 0, 9]), np.array([1 << 63, (1 << 64) - 1, 5 << 16, 1 << 16, 7 << 16], dtype=np.uint64)
    coded = [repeats._coded(hashes[:3], hashes[:3], doc[:3], places[:3], np.array([1, 17, 31])),
             repeats._coded(hashes[3:], np.array([60, (1 << 31) - 1]), doc[3:], places[3:], 0)]
    rows = [list(r.values()) for b in repeats._decoded(iter(coded)) for r in b.to_pylist()]
    assert [r[2:] for r in rows] == [list(r) for r in zip(doc.tolist(), places.tolist(), [50, 66, 80, -60, 1 - (1 << 31)])]
    assert [r[1] for r in rows[:3]] == hashes[:3].view(np.int64).tolist()
    # 48 bits of a key are left, the longest region has 31 strings
    assert [r[0] for r in rows[:3]] == [-1 << 63, -1 << 16, 5 << 16]
    text = np.frombuffer(bytes(range(256)) * 8, dtype=np.uint8)
    _, _, begin, end = repeats.regions(text, np.array([0, len(text)]))
    assert (end - begin).max() <= 80 and repeats._COUNT_BITS == 5


def test_suffixes_in_order_up_to_a_depth():
    from karst.llm.suffixes import permuted_prefixes, suffix_array
    random = np.random.default_rng(11)
    for depth in (1, 2, 5, 16, 50):
        text = np.append(np.tile(random.integers(1, 3, 23), 8), [*random.integers(1, 4, 90), 0]).astype(np.int16)
        order = suffix_array(text, 258, depth)
        cut = [text[i:i + depth].tolist() for i in order]
        assert cut == sorted(cut) and sorted(order) == list(range(len(text)))
        ahead, common = permuted_prefixes(text, order, depth)
        for i, j in zip(order[1:], order):
            wanted = next((k for k in range(depth) if text[i + k:i + k + 1].tolist() != text[j + k:j + k + 1].tolist()), depth)
            assert ahead[i] == j and common[i] == wanted


def test_shuffles_go_once_written(spark, docs, monkeypatch):
    import os
    import time
    from karst.llm import repeats
    from karst.session import SHUFFLE_CLEANUP
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    write, left, setting = repeats.materialise, {}, spark.conf.get(SHUFFLE_CLEANUP)

    def shuffled():
        files = [os.path.join(top, f) for d in folders for top, _, names in os.walk(d) for f in names if f.startswith("shuffle_")]
        return {f: os.path.getsize(f) for f in files if os.path.exists(f)}

    def watched(df, label, **options):
        before, out = shuffled(), write(df, label, **options)
        for _ in range(10):
            left[label] = sum(size for f, size in shuffled().items() if f not in before)
            if not left[label]:
                break
            time.sleep(0.2)
        return out

    monkeypatch.setattr(repeats, "materialise", watched)
    assert repeats.without_repeats(docs).count() == docs.count()
    assert left == {"regions": 0, "large": 0, "shards": 0, "spans": 0} and spark.conf.get(SHUFFLE_CLEANUP) == setting


# set-relation skipping

def test_shared_shingles_across_batches():
    from karst.llm import jaccard
    rows = [(1, 5, 0), (2, 5, 1), (2, 6, 4), (2, 7, 9), (3, 1, 0), (4, 1, -3), (5, 2, 7), (6, 2, 1), (6, 3, 0), (7, 9, -1)]
    wanted = [(2, 5, 1), (2, 6, 4), (2, 7, 9), (4, 1, 2), (6, 2, 1), (6, 3, 0), (7, 9, 0)]
    for step in range(1, len(rows) + 1):
        batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + step])], ["token", "doc_id", "pos"])
                   for i in range(0, len(rows), step))
        assert sorted(tuple(r.values()) for b in jaccard._shared(batches) for r in b.to_pylist()) == wanted, step


def test_block_pairs_like_all_pairs():
    from karst.llm import jaccard
    random = np.random.default_rng(2)
    size = np.sort(random.integers(20, 90, 400))
    place = random.integers(0, 20, 400)
    order = np.lexsort((place, size))
    size, place, label = size[order], place[order], random.integers(0, 40, 400)
    found = {(int(i), int(j)) for x, y in jaccard._block_pairs(label, size, place) for i, j in zip(x, y)}
    wanted = {(i, j) for i in range(400) for j in range(i + 1, 400) if label[i] != label[j] and 4 * size[i] >= 3 * size[j]
              and 7 * min(size[i] - place[i], size[j] - place[j]) >= 3 * (size[i] + size[j])}
    assert found == wanted and found


def test_pairs_of_a_run_of_shingles_are_given_once():
    from karst.llm import jaccard
    random = np.random.default_rng(9)
    rows = []
    for node in range(120):
        base = [int(t) for t in np.unique(random.integers(1, 400, 40) + 1000 * (node % 12))]
        own = sorted(t for t in {*base, *range(50_000 + node % 12, 50_400 + node % 12, 12), 7} if random.random() < (0.9 if t > 7 else 0.1))
        rows += [(token, node, node // 2, len(own) * 10, pos) for pos, token in enumerate(own)]
    known = SimpleNamespace(value=(np.array([7], np.uint64), np.array([3000])))
    held = {}
    for token, node, label, n, pos in rows:
        held.setdefault(node, (label, n, {}))[2][token] = pos
    wanted = set()
    for a in held:
        for b in held:
            (la, na, x), (lb, nb, y) = held[a], held[b]
            if a < b and la != lb and 4 * min(na, nb) >= 3 * max(na, nb):
                if any(7 * min(na - x[t], nb - y[t]) >= 3 * (na + nb) for t in x.keys() & y.keys()):
                    wanted.add((a, b))
    names = ["token", "node", "label", "n", "pos"]
    for step in (1, 7, 1000, len(rows)):
        batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + step])], names) for i in range(0, len(rows), step))
        lists = pa.Table.from_batches(list(jaccard._cut_lists(known, batches))).sort_by(
            [("token", "ascending"), ("n", "ascending"), ("pos", "ascending")])
        found = [tuple(r.values()) for b in jaccard._candidates(iter(lists.combine_chunks().to_batches(max_chunksize=step)))
                 for r in b.to_pylist()]
        assert set(found) == wanted and len(found) < 4 * len(wanted), (step, len(found), len(wanted))


def test_answers_of_members_derived_from_their_pivots(spark):
    """Families of edited texts around bases that overlap more and less than the threshold."""
    from karst.llm.jaccard import similar_groups
    random = np.random.default_rng(6)
    base = [f"b{i}" for i in range(160)]
    rows, number = [], 0
    for shift in (0, 8, 16, 30, 60):
        text = base[shift:] + [f"s{shift}x{i}" for i in range(shift)]
        for copy in range(14):
            own = list(text)
            for _ in range(copy % 4):
                own[int(random.integers(0, len(own)))] = f"e{number}"
            rows.append((number, " ".join(own)))
            number += 1
    sets = {i: frozenset(zip(*(t.split()[k:] for k in range(5)))) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    found = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: root(i) for i in sets}
