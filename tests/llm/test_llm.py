"""The ten operators against plain versions, and on rows that tables may hold by accident."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from karst.llm import kernels as K
from karst.llm import repeats
from karst.llm.classifier import isotonic, quality_scores
from karst.llm.components import components
from karst.llm.extraction import main_text, page_texts
from karst.llm.jaccard import similar_groups
from karst.llm.licenses import TEMPLATES, TEXTS, bands_for, license_scan
from karst.llm.lines import line_rules, without_lines
from karst.llm.mixing import fair_mix, mixed, word_count
from karst.llm.packing import best_fit, pack_documents
from karst.llm.privacy import find_personal, redacted, written
from karst.llm.queries import ORACLES, QUERIES, tokenizer
from karst.llm.suffixes import permuted_prefixes, suffix_array
from karst.llm.topk import scaled, top_k

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, _salt int, node int"
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(40_000))
SHARED = " ".join(f"shared{i}" for i in range(60))
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 0), (4, "one two", "en", "a", 7),
    (5, LONG, "en", "b", len(LONG)), (6, LONG + " tail", "en", "b", 1), (7, SHARED, "en", "b", 1), (7, SHARED, "en", "b", 1),
    (8, "Unique start here " + SHARED, None, "c", 1), (9, SHARED.upper(), "en", None, 1), (10, "aaaa" * 400, "en", "c", 1),
    (11, "x " * 500, "en", "c", 1), (12, "é ß 日本語 \U0001f600 " * 30, "fr", "c", 1),
    (None, SHARED, "en", "b", 1), (None, None, None, None, None), (13, "one two", "en", "a", 7),
    (14, "mail a.b@example.org, 10.0.0.1 or 4111 1111 1111 1111 and +1 (206) 555-0100 or 999.1.1.1", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text):
    words = WORD.findall(lowered(text))
    return frozenset(zip(*(words[i:] for i in range(5)))) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def plain_groups(rows):
    """Components over (id, text) rows by comparing every pair that shares a shingle."""
    sets, parent, lists, common = {}, {}, defaultdict(list), Counter()
    for i, text in rows:
        sets[i], parent[i] = shingle_set(text or ""), i
    for i in sorted(sets):
        for item in sets[i]:
            common.update((j, i) for j in lists[item])
            lists[item].append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), n in common.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def plain_removal(rows):
    owner, out = {}, {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        for at in range(len(raw) - 49):
            owner.setdefault(raw[at:at + 50], i)
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 49):
            if owner[raw[at:at + 50]] < i:
                gone[at:at + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), hashlib.sha256(kept).hexdigest())
    return out


def test_kernels_cut_words_and_lines():
    import pyarrow as pa
    data, offsets = K.utf8(pa.array(["a bb\n\nccc ", None, "", "é x\nq"]))
    starts, ends, bounds = K.words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["a", "bb", "ccc", "é x", "q"]
    assert bounds.tolist() == [0, 3, 3, 3, 5]
    starts, ends, bounds = K.lines(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["a bb", "", "ccc ", "", "", "é x", "q"]
    assert bounds.tolist() == [0, 3, 4, 5, 7]


@pytest.mark.parametrize("symbols", [2, 3, 26])
def test_suffix_array_is_sorted(symbols):
    random = np.random.default_rng(symbols)
    for size in (1, 2, 40, 3000):
        text = np.append(random.integers(1, symbols, size), 0).astype(np.int32)
        raw = bytes(text.astype(np.uint8))
        order = suffix_array(text, symbols + 1)
        assert order.tolist() == sorted(range(size + 1), key=lambda i: raw[i:])
        ahead, common = permuted_prefixes(text, order, 50)
        for i in range(0, size + 1, 37):
            if ahead[i] >= 0:
                a, b = raw[i:], raw[ahead[i]:]
                n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert common[i] == min(50, n)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# licences

def test_license_scan(docs, texts):
    plain = str.maketrans({c: " " for c in map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])})
    found = {(r.doc_id, r.license_id) for r in license_scan(docs).collect()}
    for name, template in TEMPLATES.items():
        wanted = f" {' '.join(WORD.findall(lowered(template).translate(plain)))} "
        for i, text in texts.items():
            if wanted in f" {' '.join(WORD.findall(lowered(text).translate(plain)))} ":
                assert (i, name) in found


def test_license_scan_odd_rows(spark, odd, empty):
    assert license_scan(empty).count() == 0
    assert license_scan(odd, {}).count() == 0
    assert license_scan(odd).count() == 0
    text = "Before it. " * 30 + TEMPLATES["MIT-grant"].replace("free of charge", "free of any charge") + " after " * 50
    rows = spark.createDataFrame([(1, text), (1, text), (None, TEMPLATES["GPL-3.0-notice"]), (2, "Licensed under CC BY 3.0")],
                                 "doc_id bigint, text string")
    out = license_scan(rows).collect()
    assert Counter((r.doc_id, r.license_id) for r in out) == {(1, "MIT-grant"): 2, (None, "GPL-3.0-notice"): 1}
    near = next(r for r in out if r.doc_id == 1)
    assert 0.75 <= near.containment < 1 and text[near.start:near.end].startswith("Permission is hereby")
    assert (1 - 0.3) ** bands_for(0.3) <= 1e-6


def test_license_texts_and_versions(spark):
    whole = {p.stem: p.read_text(encoding="utf-8") for p in TEXTS.glob("*.txt")}
    named = "This work is licensed under the GNU General Public License, version {}."
    rows = [(name, "Before it. " * 9 + text) for name, text in whole.items()]
    rows += [(f"v{i}", named.format(i)) for i in (1, 2, 3)]
    docs = spark.createDataFrame(list(enumerate(t for _, t in rows)), "doc_id bigint, text string")
    found = defaultdict(set)
    for r in license_scan(docs).collect():
        found[rows[r.doc_id][0]].add(r.license_id)
    assert all(name in found[name] for name in whole) and len(whole) >= 14
    assert found["v1"] == set() and found["v2"] == {"GPL-2.0-notice"} and found["v3"] == {"GPL-3.0-notice"}
    assert "LGPL-2" not in found["LGPL-2.1"] and "LGPL-2.1" not in found["LGPL-2"] and "GFDL-1.2" not in found["GFDL-1.3"]


# line rules

def test_line_counts(docs, texts):
    for r in line_rules(docs).collect():
        text = texts[r.doc_id]
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        again = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
        lines = text.split("\n")
        doubled = sum(bool(WORD.search(line)) and line in lines[:i] for i, line in enumerate(lines))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), doubled, len(again))
        assert r.base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words))


def test_boilerplate_lines(spark, odd, empty):
    letters = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    body = [" ".join(a + b for b in letters) for a in letters[:40]]
    rows = [(i, f"{body[i]}\nSubscribe to  page {i}", "h") for i in range(40)]
    mostly = "\n".join([body[39], *["subscribe TO page 7"] * 30])
    rows += [(90, mostly, "h"), (91, f"{body[1]}\nSubscribe to page 3", "other")]
    found = {r.doc_id: r for r in line_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert all(found[i].kept and found[i].n_dropped_words == 4 for i in range(40))
    assert not found[90].kept and found[91].kept and found[91].n_dropped_words == 0
    out = line_rules(odd)
    assert out.count() == len(ODD) and line_rules(empty).count() == 0
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.text for r in without_lines(docs, line_rules(docs)).collect()}
    assert kept[3] == body[3] and 90 not in kept


def test_boilerplate_limit_does_not_grow_with_the_host(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    named = [f"{a}{b} {c}{d}" for a in letters[:10] for b in letters[:10] for c in letters[:10] for d in letters[:2]]
    body = " ".join(f"w{a}{b}" for a in letters[:4] for b in letters[:20])
    rows = [(i, f"{n}\n{n} {body}" + ("\nAll rights are reserved" if i < 6 else "") + ("\nonly in five" if i < 5 else ""), host)
            for host, n_docs in (("large", 1900), ("small", 50)) for i, n in enumerate(named[:n_docs])]
    found = line_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert all(r.n_dropped_words == (4 if r.doc_id < 6 else 0) for r in found) and len(found) == 1950


# pages

def test_page_texts(spark):
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><div class='top-menu'><a href=x>Home</a></div>"
            "<div id='content'><h1>T{0}</h1><p>A &amp; b{0}\n  c<p>Second <b>bold</b><br>line {0}</p><ul><li>one<li>two</ul>"
            "<p>Subscribe now</p></div><div class='comments'><p>first!</p></div><footer>f</footer></body></html>")
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(8)]
    rows += [(20, None, None), (21, "http://h.example/x", ""), (22, "u", "<p>Lone &lt;text&gt;"), (0, "http://h.example/0", page.format(0))]
    found = page_texts(spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string"))
    out = {r.page_id: r.text for r in found.collect()}
    assert found.count() == len(rows)
    assert out[3] == "T3\nA & b3 c\nSecond bold line 3"  # one, two and the call stand on every page: template
    assert (out[20], out[21], out[22]) == ("", "", "Lone <text>")
    assert page_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
    assert main_text("<nav>n</nav><article><h1>H</h1>x<aside>y</aside></article><p>z</p>", frozenset()) == "H\nx"


@pytest.mark.parametrize("source, text", [
    ("<body><form id=f><input name=a><label>q</label><h1>T</h1><p>Long text of the page</p></form></body>", "T\nLong text of the page"),
    ("<body><form action=/s>Search <input name=q><button>Go</button></form><p>Only this</p></body>", "Only this"),
    ("<body><div class='has-sidebar'><p>Kept here</p></div></body>", "Kept here"),
    ("<article><p title='a hidden gem'>One</p><p>Two</p></article>", "One\nTwo"),
    ("<article><section class='social-history'><p>A</p></section><p id='social-contract'>B</p></article>", "A\nB"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>Yes</p></article>", "Yes"),
    ("<div class='site-footer'>no</div><div class='cookie_banner'>no</div><div id=left-sidebar>no</div><p>Text of it</p>", "Text of it"),
    ("<article><h1>H</h1><p>" + "word " * 40 + "</p><article><p>a reader's comment</p></article></article><article><p>teaser</p></article>",
     "H\n" + "word " * 39 + "word"),
    ("<div><a href=x>one</a> <a href=y>two</a></div><div><p>Some text of the page</p><p><a href=z>All of it a link</a></p></div>", "Some text of the page"),
    ("a < b and <3 c <p a='x>y'>d", "a < b and <3 c\nd"), ("<p a='unclosed>text", "text"), ("<p", "<p"), ("<!-- x", ""), ("", ""),
])
def test_what_a_page_holds(source, text):
    assert main_text(source, frozenset()) == text


def test_pages_in_linear_time():
    import time
    for source in ("<p " * 350_000, "<p a='" * 170_000, "<p a=\"'>" * 120_000, "<" * 1_000_000, "<!--" * 250_000, "<center>" * 60_000 + "x",
                   "<center>" * 20_000 + "<p>x</q>" * 20_000, "<div>" * 20_000 + "</b></div>" * 20_000):
        started = time.process_time()
        main_text(source, frozenset())
        assert time.process_time() - started < 5, source[:20]


def test_template_decides_without_article_tags(spark):
    """The table's pages with their articles turned into plain containers, several to a host: the same text by the template."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    notice = "<div><p>" + "This site keeps what you read in mind. Learn how we use it, and what you can do. " * 12 + "</p></div>"
    rows, wanted = [], {}
    for i, source in enumerate(pages):
        wanted[i] = main_text(source, frozenset())
        plain = re.sub(r"<(/?)article>", r"<\1div>", source)
        rows.append((i, f"http://host{i % 3}.example/{i}", re.sub(r"(<body[^>]*>)", r"\1" + notice, plain)))
    found = page_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == wanted
    # without a template the notice stays
    assert sum(main_text(r[2], frozenset()) != wanted[r[0]] for r in rows) > len(rows) / 2


def test_pages_without_article_keep_every_slot(spark):
    page = ("<body><div class='box'><p>{1}</p></div><div id=content><h1>Title {0}</h1>Lead {0}<div class=part-a><p>First {0}</div>"
            "<div class=part-b><p>Second {0}</div></div><div class=sidebar>aside {0}</div></body>")
    rows = [(i, f"http://h.example/{i}", page.format(i, "The same long words on each of the pages. " * 20)) for i in range(8)]
    rows += [(20, "http://lone.example/", page.format(20, "Only here"))]
    out = {r.page_id: r.text for r in page_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out == {i: ("Only here\n" if i == 20 else "") + f"Title {i}\nLead {i}\nFirst {i}\nSecond {i}" for i in [*range(8), 20]}


def _texts_of(spark, bodies):
    rows = [(i, f"http://h.example/{i}", f"<body><div id=top>Same words here</div><div id=content>{b}</div></body>") for i, b in enumerate(bodies)]
    found = page_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    return [r.text for r in found.orderBy("page_id").collect()]


def _blocks(words):
    return "".join(f"<p>{w}</p>" for w in words.split())


def test_classes_that_cross_are_no_template(spark):
    """x1 x2 and y1 y2 keep their order, but neither stands in one gap of the other; z1 z2 mesh with x1 x2 in one way."""
    ways = ["x1 y1 x2 y2", "y1 x1 y2 x2", "x1 y1 y2 x2", "x1 x2 y1 y2"]
    bodies = [_blocks(f"t{i} " + (ways[i % 4] if i < 12 else "x1 x2" if i < 14 else "")) for i in range(16)]
    assert _texts_of(spark, bodies) == [f"t{i}" + ("\ny1\ny2" if i < 12 else "") for i in range(16)]
    meshed = [_blocks(f"t{i} " + ("x1 z1 x2 z2" if i < 12 else "x1 x2" if i < 14 else "")) for i in range(16)]
    assert _texts_of(spark, meshed) == [f"t{i}" for i in range(16)]
    nested = [_blocks(f"t{i} " + ("x1 z1 z2 x2" if i < 12 else "x1 x2" if i < 14 else "")) for i in range(16)]
    assert _texts_of(spark, nested) == [f"t{i}" for i in range(16)]


def test_a_token_out_of_order_leaves_its_class(spark):
    """One text that wanders does not undo the order of the others."""
    bodies = [_blocks(" ".join([f"t{i}", *["a", "b", "c"][:i % 4], "wanders", *["a", "b", "c"][i % 4:]])) for i in range(12)]
    assert _texts_of(spark, bodies) == [f"t{i}\nwanders" for i in range(12)]


def test_crossing_of_classes():
    from collections import Counter
    from karst.llm.extraction import _rising, crossing

    def pairs(kinds):
        points = [(i, int(k), 0, i) for i, k in enumerate(kinds)]
        return crossing(points, Counter((k, 0) for _, k, _, _ in points))

    assert pairs("1122") == pairs("1221") == pairs("122133") == pairs("1232331") - {(2, 3)} == set()
    assert pairs("1212") == {(1, 2)} and pairs("123123") == {(1, 2), (1, 3), (2, 3)} and pairs("1223132") == {(1, 2), (1, 3)}
    assert _rising([1, 2, 9, 3, 4]) == {0, 1, 3, 4} and _rising([2, 1]) in ({0}, {1}) and _rising([]) == set()


def test_pages_of_the_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    import html
    for r in QUERIES["op3_page_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# search

def test_top_k(spark):
    from compare import connect, difference
    assert difference(spark, connect(SF), QUERIES["op4_top_k"], ORACLES["op4_top_k"], SF) is None


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [1.0, None]), (5, [inf, 0.0]),
            (6, [-1.0, 0.5]), (7, []), (8, [3.0]), (None, [9.0, 9.0]), (9, [1e17, 0.0])]
    vectors = scaled(spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, score int"), 1.0)
    out = [(r.query_id, r.rank, r.vec_id, r.score) for r in top_k(vectors.filter("vec_id in (0, 2, 8)"), vectors, 3).collect()]
    assert sorted(out) == [(0, 1, 9, 10 ** 17), (0, 2, 1, 5), (0, 3, 1, 5)]
    assert top_k(vectors.filter("false"), vectors, 3).count() == 0
    assert top_k(vectors, vectors.filter("false"), 3).count() == 0


# similarity join

def test_similar_groups(docs, texts):
    wanted = plain_groups(texts.items())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(docs).collect()} == wanted


def test_similar_groups_around_the_threshold(spark):
    words = [f"t{i}" for i in range(44)]
    rows = []
    for i in range(60):  # cuts of one text: neighbours link, the ends do not
        rows.append((i, " ".join(words[i % 12:] + [f"v{i}x{j}" for j in range(i % 5)])))
    found = similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain_groups(rows)


def test_similar_groups_odd_rows(odd, empty):
    out = similar_groups(odd).collect()
    assert len(out) == len(ODD) and similar_groups(empty).count() == 0
    groups = {r.doc_id: r.component_id for r in out if r.doc_id is not None}
    assert groups[9] == groups[7] == 7 and groups[6] == groups[5] == 5 and groups[13] == 4 and groups[2] == 2
    assert Counter(r.component_id for r in out if r.doc_id is None) == {7: 1, None: 1}


# suffix arrays

@pytest.mark.parametrize("group", [repeats.GROUP_REGIONS, 2])
def test_without_repeats(docs, texts, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP_REGIONS", group)
    out = repeats.without_repeats(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()} == plain_removal(texts.items())


def test_without_repeats_odd_rows(odd, empty, spark):
    wanted = plain_removal({r[0]: r[1] for r in ODD if r[0] is not None}.items())
    out = repeats.without_repeats(odd).collect()
    assert len(out) == len(ODD) and repeats.without_repeats(empty).count() == 0
    for r in out:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == wanted[r.doc_id]
        else:
            assert r.n_removed == 0
    # the same id with two texts
    rows = spark.createDataFrame([(1, "z" * 60), (2, SHARED), (3, "y" + SHARED), (3, SHARED + "y")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.kept) for r in repeats.without_repeats(rows).collect() if r.doc_id == 3) == [(3, b"y"), (3, b"y")]


# packing

@pytest.mark.parametrize("size", [1, 2, 3])
def test_regions_settle_across_batches(size):
    rows = [(1, 10, 5, 0), (1, 10, 5, 100), (1, 10, 5, 200), (1, 10, 7, 4), (1, 11, 3, 7), (1, 11, 3, 90), (2, 12, 4, 0), (2, 12, 4, 9),
            (2, 12, 6, 1), (3, 13, 1, 0), (3, 14, 2, 0), (3, 15, 2, 60), (3, 15, 2, 80)]

    def settled(step):
        batches = (repeats._batch(repeats._REGION, *np.array([(*r, 50) for r in rows[i:i + step]]).T) for i in range(0, len(rows), step))
        return sorted(tuple(r.values()) for b in repeats._settle(batches) for r in b.to_pylist())

    owners = [(*r, 50) for r in rows if r[0] != 2 and r[2] != 7]
    assert settled(size) == settled(len(rows)) == sorted([*owners, (1, 10, 7, 4, -50), (2, 12, 6, 1, -50)])


def check_packing(rows, out):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for i, text in rows:
        ids[i].append(np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4"))
    windows, lengths = defaultdict(list), Counter()
    for r in out:
        assert any(zlib.crc32(a[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and len(a) == r.doc_tokens for a in ids[r.doc_id])
        windows[r.sequence_id].append((r.offset, r.length))
        lengths[r.doc_id] += r.length
    assert lengths == {i: sum(map(len, a)) for i, a in ids.items()}
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return sum(lengths.values()) / (4096 * len(windows))


def test_packing(docs, texts, odd, empty):
    assert check_packing(texts.items(), pack_documents(docs, tokenizer()).collect()) > 0.97
    check_packing([(r[0], r[1]) for r in ODD], pack_documents(odd, tokenizer()).collect())
    assert pack_documents(empty, tokenizer()).count() == 0


def test_packing_of_marks_and_special_tokens(spark):
    rows = [(1, "a \x01 b !\x01"), (2, "Stop <|ENDOFTEXT|> x<|endoftext|>Y"), (3, "ÀB a\u0300 A\u0300 İ's DON'T"), (4, "STOP stop \x01")]
    for some in (rows, rows[1:3], rows[:1]):
        out = pack_documents(spark.createDataFrame(some, "doc_id bigint, text string").coalesce(1), tokenizer()).collect()
        check_packing(some, out)


def test_best_fit_takes_the_tightest_window():
    windows, offsets = best_fit([6, 5, 4, 3, 3, 2, 1], 8)
    assert (windows, offsets) == ([0, 1, 2, 1, 2, 0, 2], [0, 0, 0, 5, 4, 6, 7])


# mixing

def test_mix(spark, docs, texts):
    out = QUERIES["op8_source_mix"](spark, SF).collect()
    sources = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    taken, size, target = Counter(), Counter(), {}
    for r in out:
        assert r.size == len(WORD.findall(texts[r.doc_id])) and 0 <= r.taken <= 3 * r.size
        taken[sources[r.doc_id]] += r.taken
        size[sources[r.doc_id]] += r.size
        target[sources[r.doc_id]] = r.target
    assert len(out) == len(texts)
    for i, s in enumerate(sorted(size)):
        assert abs(taken[s] - target[s]) <= 1
    again = QUERIES["op8_source_mix"](spark, SF).collect()
    assert sorted(out) == sorted(again)


def test_mix_full_and_odd_sources(spark, odd, empty):
    rows = [(i, "w " * 10, "small") for i in range(2)] + [(10 + i, "w " * 10, "large") for i in range(50)] + [(99, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = fair_mix(docs, word_count(docs["text"]), docs["doc_id"])
    facts = {r.source: (r.source_size, r.target) for r in plan.collect()}
    # weights: large 5, small 2, null 1; small stops at three times its size, null has nothing to give
    assert facts == {"small": (20, 60.0), "large": (500, 460.0), None: (0, 0.0)}
    out = mixed(docs, plan)
    counts = Counter()
    for r in out.collect():
        counts[r.source] += len(WORD.findall(r.text))
    assert counts == {"small": 60, "large": 460} and out.columns == docs.columns
    assert fair_mix(odd, word_count(odd["text"]), odd["doc_id"]).count() == len(ODD)
    assert fair_mix(empty, word_count(empty["text"]), empty["doc_id"]).count() == 0


# classifier

def test_quality(spark, docs, empty, odd):
    big = os.path.join(os.path.dirname(SF), "sf0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    found = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    held = [(found[r.doc_id].predicted, r.quality) for r in labels.collect() if found[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert sum(a == b for a, b in held) / len(held) > 0.97
    out = quality_scores(odd, labels.limit(0)).collect()
    assert len(out) == len(ODD) and {r.score for r in out} == {0.5}
    out = quality_scores(odd, spark.createDataFrame([(1, 1), (5, 0), (5, None), (7, 1), (77, 1), (None, 0)], "doc_id bigint, quality int"))
    assert all(0 <= r.score <= 1 for r in out.collect()) and quality_scores(empty, labels).count() == 0


def test_isotonic():
    assert isotonic(np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 1, 1])).round(3).tolist() == [0, 0.667, 0.667, 1]


# personal data

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_personal_data(spark, docs, texts, odd, empty):
    found = find_personal(docs)
    for r in found.select("doc_id", written(found["base"]).alias("b")).collect():
        assert r.b == plain_spans(texts[r.doc_id])
    hard = ["a@b.c._x@d.e a@b.c%y@f.g", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1", "é\U0001f600 4111-1111-1111-1111 " * 2, "5" * 5000,
            "a." * 20000 + "@x", "+1 " + "(" * 5000 + "2", "+12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "x@y.z@w.v", "4111 1111 1111 1112", ""]
    rows = spark.createDataFrame(list(enumerate(hard)), "doc_id bigint, text string")
    found = find_personal(rows)
    for r in found.select("doc_id", written(found["base"]).alias("b")).collect():
        assert r.b == plain_spans(hard[r.doc_id])
    assert find_personal(odd).count() == len(ODD) and find_personal(empty).count() == 0
    masked = {r.doc_id: r.text for r in redacted(odd, find_personal(odd)).collect()}
    assert masked[14] == "mail [email], [ip] or [card] and [phone] or 999.1.1.1" and masked[4] == "one two"


def test_telling_terms(spark):
    rows = [(i, f"note {i} for Zorblax at z@x.org on day {i}") for i in range(5)] + [(10 + i, f"note on day {i} for all") for i in range(40)]
    found = find_personal(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found.collect()}
    assert spans[0] == [("email", 22, 29), ("term", 11, 18), ("term", 19, 21)] and spans[12] == []


def test_terms_of_an_entity_in_one_text(spark):
    """One text is no evidence for its words, but parts of the value and a name before it are, wherever they stand."""
    far = "note on day " * 40
    rows = [(i, f"note on day {i % 7}") for i in range(40)] + [(50, f"Zorblax {far}at zorblax.k@x.org {far}for ZORBLAX"), (50, None)]
    rows += [(51, rows[40][1]), (None, rows[40][1]), (60, f"{far}ask Quuxley at +1 206 555 0100 {far}rarely"), (61, "unrelated rarity")]
    found = find_personal(spark.createDataFrame(rows, "doc_id bigint, text string"))
    text = dict(rows)
    told = {50: ["Zorblax", "ZORBLAX"], 51: ["Zorblax", "ZORBLAX"], 60: ["Quuxley"]}
    for r in found.collect():
        own = text.get(r.doc_id) or rows[40][1]
        assert [own[s.start:s.end] for s in r.spans if s.kind == "term"] == (told.get(r.doc_id, told[50]) if r.base else [])
        assert r.base or not r.spans
    assert found.filter("size(base) > 0").count() == 4


def test_secrets(spark):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    rows = [(1, f'token = "{key}" here'), (2, "a-very-long-word-made-of-words-2020-edition"), (3, "x" * 60), (4, "0" * 40 + "a"), (5, key[:12])]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in find_personal(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == {1: [("secret", 9, 49)], 2: [], 3: [], 4: [], 5: []}


def plain_terms(rows):
    """Term spans of (id, text) rows, with counts in dictionaries; for texts that are no near copies of each other."""
    word, part = re.compile(r"[^\W_][\w'’-]*"), re.compile(r"[^\W\d_]+")
    words = {t: [(m.start(), m.end(), m.group().lower()) for m in word.finditer(t) if "_" not in m.group()] for _, t in rows}
    entities = {t: [(k, *map(int, (a, b)), t[int(a):int(b)].lower()) for k, a, b in (s.split(":") for s in plain_spans(t).split(",") if s)]
                for t in words}
    holds, n_t = defaultdict(set), Counter()
    for t in words:
        for k, _, _, v in entities[t]:
            holds[k, v].add(t)
    for _, t in rows if rows else ():
        n_t.update({w for _, _, w in words[t]})
    for t in words:
        if entities[t]:
            copies = sum(u == t for _, u in rows) - 1
            n_t.subtract({w: copies for w in {w for _, _, w in words[t]}})
    size, out = len(words), {}
    for t in words:
        told = set()
        for k, a, _, v in entities[t]:
            own = {p for p in part.findall(v) + word.findall(v) if len(p) >= 3} if k == "email" else set()
            names = re.search(r"((?:[A-Z][^\W\d_]+\s+){1,3})(?:at\s+|is\s+|[<(:,-]\s*)*$", t[max(0, a - 80):a])
            own |= {w.lower() for w in word.findall(names.group(1))} if names else set()
            n_e = len(holds[k, v])
            for w in {w for _, _, w in words[t]}:
                seen = sum(any(x == w for _, _, x in words[u]) for u in holds[k, v]) - 1 + (w in own)
                if seen > 0 and n_e < size and math.log(seen * size / ((n_t[w] + 0.5) * n_e)) >= 0.8 * math.log(size / n_e) - 1e-12:
                    told.add(w)
        out[t] = [(a, b) for a, b, w in words[t] if w in told and not any(x < b and a < y for _, x, y, _ in entities[t])]
    return out


def test_terms_like_plain_version(spark, texts):
    """Counts of the real table, with people planted in texts that have nothing else in common."""
    rows = [(i, t) for i, t in texts.items() if "_" not in t]
    people = [("Zorblax", "zorblax.q@mail.example.org"), ("Quuxley", "+1 206 555 0199"), ("Mirvane", "mv@x.example")]
    plain = [t for _, t in rows if len(t) > 900 and not plain_spans(t)]
    for n, (name, value) in enumerate(people):
        for k in range(4):
            body = plain[4 * n + k]
            rows.append((10**6 + 10 * n + k, f"{body[:400]} {'' if k == 3 else name} wrote {body[400:500]} to {value} {body[500:800]}"))
    rows.append((2 * 10**6, rows[-1][1]))
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in
             find_personal(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    wanted = plain_terms(rows)
    assert found == {i: wanted[t] for i, t in rows}
    assert sum(map(bool, found.values())) >= 9


# pipeline

def test_pipeline_stages(spark, docs, texts):
    import corpus_pipeline as P
    stages = dict(P.STAGES)
    assert list(stages) == [s[0] for s in P.STAGES] and 4 <= len(stages) <= 5
    columns = docs.columns
    deduped = stages["n-gram Jaccard join"](spark, docs, SF)
    wanted = {i for i, (_, c) in plain_groups(texts.items()).items() if i == c}
    assert {r.doc_id for r in deduped.collect()} == wanted and deduped.columns == columns
    cleaned = stages["PII"](spark, docs, SF)
    assert cleaned.count() == len(texts) and cleaned.columns == columns
    for name in ("quality classifier", "mixing to target weights"):
        assert stages[name](spark, docs, SF).columns == columns
    assert P.run(spark, SF).count() > 0


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
