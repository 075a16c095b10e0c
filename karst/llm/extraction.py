"""Main text of web pages by template deduction over the pages of a host.

1. Every page becomes a sequence of tokens: structural tags with their place in
   the element tree, and whole text blocks.
2. Tokens whose occurrence vectors over the host's pages are equal form an
   equivalence class.  Vectors are not stored: sums of hashes of (page, count)
   identify them, so counting is an ordinary aggregation.
3. A class is valid if it covers most pages, its tokens come in one order on
   them, and it nests with the others: it stands in one gap of another class,
   or around it.  Tokens out of order leave their class.  Of two classes that
   cross, the weaker is dropped, unless they mesh in one way: then its tokens
   stand at fixed places of the stronger.  The classes left are the template.
4. Template text is dropped first.  Of the slots that are left, those of menus,
   adverts and the like go by their element, or by a class, id or role that is
   such a name as a whole.  The page's text is what remains in its article, or
   else in the lowest container that holds the unlinked text.

A page is read in one pass, in time linear in its length.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship

#: distinct pages, and share of a host's, that a template class must cover; share of them in one order and nested
PAGES, COVERAGE, ORDERED = 5, 0.6, 0.9

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp".split())
ASIDE = frozenset("head nav footer aside menu script style noscript template textarea title select option button "
                  "iframe object svg canvas dialog datalist legend label input".split())
# an element that makes what it stands in more than a form
CONTENT = frozenset("article main h1 h2 h3 p".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
          "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = frozenset("ul ol dl table select article section div body html".split())
# Names of parts that are no article text, as a whole class, id or role: anywhere, and outside an article.
ALWAYS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner comment "
                   "comments reply replies respond disqus cookie cookies consent gdpr notice notices alert popup modal "
                   "newsletter subscribe subscription share sharing social related recommended sidebar widget breadcrumb "
                   "breadcrumbs pagination pager login signup nav navigation navbar menu footer toolbar contentinfo "
                   "complementary".split())
OUTSIDE = frozenset("header masthead top bottom search legal copyright skip tags meta".split())
# Words that such a name may be joined with, as in site-footer or left_sidebar.
BESIDE = frozenset("site main page top bottom left right global primary secondary box block wrapper wrap container inner outer "
                   "bar list section area panel links link items item text widget bar js".split())
#: share of the unlinked text that a container holds to stand for the page, share of a block's text that is links,
#: and share of the largest article's text that makes another one more than a teaser
HELD, LINKED, TEASER = 0.9, 0.5, 0.33

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)

_TOKENS = "host string, print bigint, token bigint, block boolean, places array<int>"


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), a or b or c)
    return found


def _named(value: str, names: frozenset[str]) -> bool:
    """Whether a class, id or role is one of the names: alone, or joined with words that only say where it stands."""
    words = re.split(r"[-_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower())
    return any(w in names for w in words) and all(w in names or w in BESIDE or not w for w in words)


@functools.lru_cache(maxsize=1 << 15)
def _element(parent: int, aside: bool, article: bool, tag: str, raw: str) -> tuple[int, bool, bool, int, int]:
    """Place of an element, whether it is no article text, whether it is in an article, and its two tokens."""
    attributes = _attributes(raw) if raw else {}
    values = [w for n in ("class", "id", "role") for w in attributes.get(n, "").split()]
    root, inside = tag in ("html", "body"), article or tag in ("article", "main")
    named = not root and tag not in ("article", "main") and (
        any(_named(v, ALWAYS) for v in values) or (not inside and any(_named(v, OUTSIDE) for v in values)))
    hidden = ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
              or bool(_NOT_SHOWN.search(attributes.get("style", ""))))
    # an article in another one is a comment on it
    aside = (aside or tag in ASIDE or (tag == "header" and not article) or (tag == "article" and article) or named or hidden)
    place = _hash("place", str(parent), tag, *sorted(values)[:4])
    return place, aside, inside, _hash("open", str(place)), _hash("close", str(place))


class Block:
    """A text block: where it stands, and how much of it is links."""

    __slots__ = ("text", "place", "aside", "element", "article", "form", "linked")

    def __init__(self, text: str, place: int, aside: bool, element: int, article: int, form: int, linked: int):
        self.text, self.place, self.aside, self.element = text, place, aside, element
        self.article, self.form, self.linked = article, form, linked


class Page:
    """Blocks and tokens of a page in order, read in one pass."""

    def __init__(self, source: str):
        self.tokens: list[int] = []
        #: tokens that are text blocks
        self.texts: set[int] = set()
        self.blocks: list[Block] = []
        #: the element that each element stands in, and forms that hold more than fields
        self.parents, self.content_forms = [0], set()
        # (tag, place, aside, article, closing token, element, form); article and form are elements or 0
        self._stack: list[tuple[str, int, bool, int, int, int, int]] = [("", 0, False, 0, 0, 0, 0)]
        self._open_tags: dict[str, int] = {}
        self._text: list[str] = []
        self._linked = self._links = 0
        self._parse(source)

    def _flush(self) -> None:
        raw = "".join(self._text)
        text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
        if text:
            _, place, aside, article, _, element, form = self._stack[-1]
            self.blocks.append(Block(text, place, aside, element, article, form, self._linked))
            self.tokens.append(_hash("text", str(place), text))
            self.texts.add(self.tokens[-1])
        self._text, self._linked = [], 0

    def _open(self, tag: str, raw: str) -> None:
        self._flush()
        if tag in CLOSES_P:
            self._close_to(("p",), SCOPE)
        if tag in CLOSES:
            self._close_to(CLOSES[tag], SCOPE)
        _, place, aside, article, _, element, form = self._stack[-1]
        place, aside, _, opening, closing = _element(place, aside, article > 0, tag, raw)
        self.tokens.append(opening)
        if form and tag in CONTENT:
            self.content_forms.add(form)
        if tag not in VOID:
            self.parents.append(element)
            own = len(self.parents) - 1
            self._stack.append((tag, place, aside, article or (own if tag in ("article", "main") else 0), closing, own,
                                own if tag == "form" else form))
            self._open_tags[tag] = self._open_tags.get(tag, 0) + 1

    def _pop(self) -> None:
        tag, _, _, _, closing, _, _ = self._stack.pop()
        self._open_tags[tag] -= 1
        self.tokens.append(closing)

    def _close_to(self, tags: tuple[str, ...], scope: frozenset[str]) -> None:
        """Close the open elements of these names, up to an element that bounds them."""
        while any(self._open_tags.get(t) for t in tags):
            depth = len(self._stack) - 1
            while depth and self._stack[depth][0] not in tags and self._stack[depth][0] not in scope:
                depth -= 1
            if not depth or self._stack[depth][0] not in tags:
                return
            while len(self._stack) > depth:
                self._pop()

    def _tag_end(self, source: str, at: int) -> int:
        """Place of the > that ends a tag, quotes in mind; -1 if none follows.

        Once quotes turn out not to close before the page ends, the rest of it
        is read without them, so no stretch is looked at again and again.
        """
        place = at
        while self._quotes:
            found = _STOP.search(source, place)
            if not found:
                break
            if found[0] == ">":
                return found.start()
            place = source.find(found[0], found.end()) + 1
            if not place:
                break
        self._quotes = False
        return source.find(">", at)

    def _parse(self, source: str) -> None:
        at, text, size = 0, 0, len(source)
        self._quotes = True

        def keep(end: int) -> None:
            self._text.append(source[text:end])
            if self._links:
                self._linked += end - text

        while True:
            at = source.find("<", at)
            if at < 0:
                break
            if source.startswith("<!--", at):
                keep(at)
                end = source.find("-->", at + 4)
                at = text = size if end < 0 else end + 3
                continue
            if source.startswith(("<!", "<?"), at):
                end = source.find(">", at)
                if end < 0:
                    break
                keep(at)
                at = text = end + 1
                continue
            found = _NAME.match(source, at + 1)
            if not found:
                at += 1
                continue
            end = self._tag_end(source, found.end())
            if end < 0:
                break
            keep(at)
            raw, tag = source[found.end():end], found[2].lower()
            at = text = end + 1
            if found[1]:
                if tag == "a":
                    self._links = max(0, self._links - 1)
                elif tag not in INLINE and self._open_tags.get(tag):
                    self._flush()
                    while self._stack[-1][0] != tag:
                        self._pop()
                    self._pop()
                elif tag in CLOSES_P:
                    self._flush()
                continue
            if tag in INLINE:
                if tag == "a":
                    self._links = 1
                elif tag in ("br", "img", "wbr"):
                    self._text.append(" " if tag == "br" else "")
                continue
            self._open(tag, raw)
            if tag in RAW:
                close = _CLOSING[tag].search(source, at)
                self._text.clear()
                at = text = close.end() if close else size
                self._pop()
        keep(size)
        self._flush()


_CLOSING = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page and token, with its places."""
    names = [f.split(" ")[0] for f in _TOKENS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]
    for batch in batches:
        out = []
        for host, print_, source in zip(*(batch.column(c).to_pylist() for c in ("host", "print", "html"))):
            page = Page(source or "")
            seen: dict[int, list[int]] = {}
            for place, token in enumerate(page.tokens):
                seen.setdefault(token, []).append(place)
            out += [(host, print_, token, token in page.texts, places) for token, places in seen.items()]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _rising(values: list[int]) -> set[int]:
    """Indexes of a longest rising run of ``values``, which need not be adjacent."""
    if all(a < b for a, b in zip(values, values[1:])):
        return set(range(len(values)))
    ends, at, before = [], [], []
    for i, value in enumerate(values):
        length = bisect_left(ends, value)
        before.append(at[length - 1] if length else -1)
        ends[length:length + 1], at[length:length + 1] = [value], [i]
    kept, i = set(), at[-1]
    while i >= 0:
        kept.add(i)
        i = before[i]
    return kept


def _counted(rows: Counter, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.string() if n == "host" else pa.int64()) for n, c in zip(names, zip(*((*k, v) for k, v in rows.items())))]
    return pa.RecordBatch.from_arrays(columns, names)


def _pages(batch: pa.RecordBatch) -> Iterator[tuple[str, list[tuple[int, list[tuple[int, bool, list[int]]]]]]]:
    """Host and classes of each page, with the tokens (token, whether a text block, places) that have not left them."""
    for host, classes, tokens, texts, places, moved in zip(
            *(batch.column(c).to_pylist() for c in ("host", "class", "token", "block", "places", "moved"))):
        moved = frozenset(moved or ())
        runs = groupby((i for i in range(len(classes)) if tokens[i] not in moved), classes.__getitem__)
        yield host, [(kind, [(tokens[i], texts[i], places[i]) for i in run]) for kind, run in runs]


def _displaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pages hold a token out of its class's order."""
    for batch in batches:
        out: Counter = Counter()
        for host, classes in _pages(batch):
            for _, run in classes:
                kept = _rising([places[0] for _, _, places in run])
                if len(kept) < len(run):
                    out.update((host, token) for n, (token, _, _) in enumerate(run) if n not in kept)
        if out:
            yield _counted(out, ["host", "token", "n"])


def crossing(points: list[tuple[int, int, int, int]], left: Counter) -> set[tuple[int, int]]:
    """Pairs of classes that do not nest on a page, the lesser id first.

    ``points`` are (place, class, occurrence, token) by place, ``left`` tells how
    many points each (class, occurrence) has.
    """
    pairs: set[tuple[int, int]] = set()
    stack: list[tuple[int, int]] = []
    opened: set[tuple[int, int]] = set()
    for _, kind, occurrence, _ in points:
        own = (kind, occurrence)
        if own in opened:
            # what began in a gap of this occurrence has to end there
            for other in reversed(stack):
                if other == own:
                    break
                if left[other]:
                    pairs.add((min(kind, other[0]), max(kind, other[0])))
        else:
            opened.add(own)
            stack.append(own)
        left[own] -= 1
        while stack and not left[stack[-1]]:
            stack.pop()
    return pairs


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes that cross, by the way they mesh: on how many pages.

    A tag that a page repeats nests by the element tree, and may stand for
    several parts of the template; of its class the text blocks count there.
    """
    for batch in batches:
        found: Counter = Counter()
        for host, classes in _pages(batch):
            points, left = [], Counter()
            for kind, run in classes:
                run = [(token, places) for token, block, places in run if block or len(places) == 1]
                if len(run) < 2:
                    continue
                flat = [place for occurrence in zip(*(places for _, places in run)) for place in occurrence]
                # occurrences one after the other; else the class stands on the page as a whole
                apart = all(a < b for a, b in zip(flat, flat[1:]))
                for token, places in run:
                    for n, place in enumerate(places):
                        points.append((place, kind, n if apart else 0, token))
                        left[kind, n if apart else 0] += 1
            points.sort()
            for a, b in crossing(points, left):
                found[host, a, b, _hash(*(str(token) for _, kind, _, token in points if kind in (a, b)))] += 1
        if found:
            yield _counted(found, ["host", "a", "b", "mesh", "n"])


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that cross one that stays; a host's pairs come with the stronger weak classes first."""
    for batch in batches:
        out = []
        for host, pairs in zip(*(batch.column(c).to_pylist() for c in ("host", "pairs"))):
            gone: set[int] = set()
            for pair in pairs:
                if pair["strong"] not in gone:
                    gone.add(pair["weak"])
            out += [(host, kind) for kind in gone]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64()))], ["host", "class"])


def _article(blocks: list[Block]) -> list[Block]:
    """Blocks of the page's article; of several, those that are no teasers of others."""
    sizes: dict[int, int] = {}
    for b in blocks:
        if b.article:
            sizes[b.article] = sizes.get(b.article, 0) + len(b.text) - b.linked
    if not sizes:
        return []
    least = TEASER * max(sizes.values())
    return [b for b in blocks if b.article and sizes[b.article] >= least]


def _lowest(blocks: list[Block], parents: list[int]) -> list[Block]:
    """Blocks of the lowest container that holds most of the unlinked text, less those that are mostly links."""
    weights = [0] * len(parents)
    for b in blocks:
        weights[b.element] += max(0, len(b.text) - b.linked)
    for element in range(len(parents) - 1, 0, -1):
        weights[parents[element]] += weights[element]
    # the heaviest way down, while one element holds nearly all of it
    best, container = HELD * weights[0], 0
    single = {b.element for b in blocks}
    for element in range(1, len(parents)):
        if parents[element] == container and weights[element] >= best and element not in single:
            container = element
    inside = [False] * len(parents)
    inside[container] = True
    for element in range(container + 1, len(parents)):
        inside[element] = inside[parents[element]]
    return [b for b in blocks if inside[b.element] and b.linked <= LINKED * len(b.text)]


def main_text(source: str, template: frozenset[int]) -> str:
    """Text of the page's article, or else of the container that holds its text, without what ``template`` has."""
    page = Page(source)
    blocks = [b for b in page.blocks if not b.aside and (not b.form or b.form in page.content_forms)
              and not (template and _hash("text", str(b.place), b.text) in template)]
    return "\n".join(b.text for b in _article(blocks) or _lowest(blocks, page.parents))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(source or "", frozenset(template or ())) for source, template in zip(
            *(batch.column(c).to_pylist() for c in ("html", "template")))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def templates(tokens: DataFrame) -> DataFrame:
    """``(host, template)`` from ``tokens``: hashes of the template's tokens."""
    seen = tokens.distinct()
    pages = tokens.select("host", "print").distinct().groupBy("host").agg(F.count("*").alias("_pages"))
    part = lambda seed: F.sum(F.pmod(F.xxhash64(F.lit(seed), "print", F.size("places")), F.lit(1 << 31)))
    # the tokens of a class are on the same pages, so those that come in one order there have their mean places in it
    vectors = seen.groupBy("host", "token").agg(F.count("*").alias("_support"), part(1).alias("_one"), part(2).alias("_two"),
                                                F.avg(F.element_at("places", 1)).alias("_mean"))
    vectors = vectors.filter(F.col("_support") >= PAGES)
    vectors = left_join_unique(vectors, pages, ["host"], F.col("token"), "inner").filter(
        F.col("_support") >= COVERAGE * F.col("_pages"))
    members = vectors.select("host", "token", F.xxhash64("_one", "_two", "_support").alias("class"), "_support", "_mean")
    members = materialise(members, "classes")
    # the classes of a page, their tokens in order
    placed = left_join_unique(seen, members, ["host", "token"], F.col("print"), "inner")
    laid = placed.groupBy("host", "print").agg(F.array_sort(F.collect_list(F.struct("class", "_mean", "token", "block", "places"))).alias("_o"))
    names = ["class", "token", "block", "places"]
    laid = materialise(laid.select("host", *[F.col(f"_o.{c}").alias(c) for c in names]), "laid")
    enough = lambda bad, of: F.col(of) - F.col(bad) >= ORDERED * F.col(of)
    held = laid.withColumn("moved", F.lit(None).cast("array<bigint>"))
    moved = None
    # what is out of order most leaves first, as it displaces others
    while True:
        out = held.mapInArrow(_displaced, "host string, token bigint, n bigint").groupBy("host", "token").agg(F.sum("n").alias("_n"))
        out = members.join(out, ["host", "token"]).filter(~enough("_n", "_support"))
        most = out.groupBy("host", "class").agg(F.max("_n").alias("_most"))
        out = materialise(out.join(most, ["host", "class"]).filter("2 * _n > _most").select("host", "token"), "moved")
        if out.isEmpty():
            break
        moved = out if moved is None else moved.unionByName(out)
        held = left_join_unique(laid, moved.groupBy("host").agg(F.collect_list("token").alias("moved")), ["host"], F.xxhash64("token"))
    if moved is not None:
        members = members.join(moved, ["host", "token"], "left_anti")
    # pairs of classes that cross in more than one way
    meshes = held.mapInArrow(_crossings, "host string, a bigint, b bigint, mesh bigint, n bigint")
    pairs = meshes.groupBy("host", "a", "b", "mesh").agg(F.sum("n").alias("_n")).groupBy("host", "a", "b").agg(
        (F.sum("_n") - F.max("_n")).alias("_bad")).filter("_bad > 0")
    classes = members.groupBy("host", "class").agg(F.max("_support").alias("_support"), F.count("*").alias("_size"))
    for side in ("a", "b"):
        pairs = pairs.join(classes.select("host", F.col("class").alias(side), F.col("_support").alias(f"_{side}"), F.struct(
            "_support", "_size", "class").alias(f"_of_{side}")), ["host", side])
    pairs = pairs.withColumn("_both", F.least("_a", "_b")).filter(~enough("_bad", "_both"))
    weak, strong = F.least("_of_a", "_of_b"), F.greatest("_of_a", "_of_b")
    pairs = pairs.groupBy("host").agg(F.sort_array(F.collect_list(F.struct(
        weak.alias("_weak"), weak["class"].alias("weak"), strong["class"].alias("strong"))), asc=False).alias("pairs"))
    crossed = materialise(pairs.mapInArrow(_dropped, "host string, class bigint"), "crossed")
    members = members.join(crossed, ["host", "class"], "left_anti")
    valid = members.groupBy("host", "class").agg(F.count("*").alias("_size")).filter("_size > 1").select("host", "class")
    return members.join(valid, ["host", "class"]).groupBy("host").agg(F.array_sort(F.collect_set("token")).alias("template"))


def page_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)``: the main text of every row of ``pages(page_id, url, html)``.

    Blocks are joined by a line break, white space inside a block is one space,
    character references are decoded.  A null or empty html gives an empty
    text, a null url belongs to the host "".  Copies of a page count once for
    the template; repeated rows give the same text each.  A class that fewer
    than five pages hold is no evidence, so hosts with fewer distinct pages
    have no template, and the element tree alone decides.  A host's template
    holds tokens of most of its pages, so its size follows the size of a page.
    Very long pages are read whole in linear time; an empty table gives no
    rows; other columns are ignored.
    """
    ship(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
                        host.alias("host"))
    tokens = rows.select("host", F.xxhash64("html").alias("print"), "html").mapInArrow(_tokens, _TOKENS)
    found = materialise(templates(materialise(tokens, "tokens")), "templates")
    joined = left_join_unique(rows, found, ["host"], F.xxhash64("page_id", "url"))
    return joined.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", "template").mapInArrow(
        _extract, "page_id bigint, url string, text string")
