"""Personal data: exact patterns, and terms that give protected entities away; DataFrame operations only.

What a term t tells of an entity e is estimated from corpus counts: with N
texts, n_t and n_e of them holding t and e, and k observations of both
together beyond the text at hand, the share

    log(k N / ((n_t + UNSEEN) n_e)) / log(N / n_e)

of the information that e carries.  A text is no evidence for itself, so a
term that merely is rare tells nothing.  Observations are the other texts that
hold both, unless most of these are near copies of one another, and one more
if the term is a part of the entity's own value or a name written before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from karst.operators.bounds import left_join_unique
from karst.session import materialise

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Possessive loops give the same matches as greedy ones here (what follows a
# loop never begins with what the loop takes) and need no stack.  The address
# begins at a run's first character, or where the match before ended, so a
# long run is looked at once.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"[\p{L}\p{N}][\p{L}\p{N}'’-]*+"

#: share of an entity's information that a term may give, and texts added to a term's count for those not seen yet
DISCLOSURE, UNSEEN = 0.8, 0.5
#: characters before an entity that may hold a name, and letters that a part of a value has at least
BEFORE, PART = 80, 3
NAMES = r"((?:\p{Lu}[\p{L}'’-]+\s+){1,3})(?:at\s+|is\s+|[<(:,-]\s*)*$"
#: sketches of a text, each of so many least shingle hashes; texts that share one are near copies of each other
SKETCHES, LEAST = 4, 3
#: a key or password: letters and digits in turn, with so many bits by its own letter frequencies
SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
SECRET_BITS, TURNS = 64, 5

_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, value>>, in code points.

    The pieces between matches and the matches themselves alternate, so their
    lengths give the places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["out"], F.array(F.struct(
            start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), pair["match"].alias("value")))).alias("out"))

    pairs = F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)),
                       lambda m, p: F.struct(m.alias("match"), p.alias("piece")))
    return F.when(text.rlike(pattern), F.aggregate(pairs, zero, step, lambda s: s["out"])).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(sum_: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return sum_ + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weighed) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(r"\A0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])\z"))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of all four kinds in their listed order, then by start: array<struct<kind, start, end, value>>."""
    def of(kind: str) -> Column:
        spans = F.filter(located(text, PATTERNS[kind]), lambda s: _holds(kind, s["value"]))
        return F.transform(spans, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    return F.concat(*map(of, KINDS))


def secret_spans(text: Column) -> Column:
    """Strings of high information that are no words: at least ``SECRET_BITS``, and a turn from letter to digit in ``TURNS`` places."""
    def bits(value: Column) -> Column:
        size = F.length(value)
        each = F.transform(F.array_distinct(F.split(value, "")), lambda c: size - F.length(F.replace(value, c, F.lit(""))))
        return F.aggregate(each, F.lit(0.0), lambda a, n: a - F.when(n > 0, n * F.log2(n / size)).otherwise(0.0))

    turn = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"
    found = F.filter(located(text, SECRET), lambda s: (F.size(F.split(s["value"], turn)) - 1) * TURNS >= F.length(s["value"]))
    return F.transform(F.filter(found, lambda s: bits(s["value"]) >= SECRET_BITS), lambda s: F.struct(
        F.lit("secret").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _terms(text: Column) -> Column:
    """The distinct terms of a text; lower case is taken per word, as where terms are marked."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def _places(texts: DataFrame) -> DataFrame:
    """``(print, term, start, end)`` of every word of ``texts(print, text)``, in code points.

    Places are running sums over a text's words, so a long text costs no more per word.
    """
    pieces = F.split("text", WORD, -1)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    pairs = F.zip_with(words, F.slice(pieces, F.lit(1), F.size(words)), lambda w, p: F.struct(
        F.lower(w).alias("term"), F.length(w).alias("size"), (F.length(p) + F.length(w)).alias("step")))
    rows = texts.select("print", F.posexplode(pairs).alias("at", "w")).select("print", "at", "w.*")
    end = F.sum(F.col("step").cast("bigint")).over(
        Window.partitionBy("print").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("end", end).select("print", "term", (F.col("end") - F.col("size")).alias("start"), "end")


def _own_terms(text: Column, span: Column) -> Column:
    """Terms that belong to an entity by themselves: parts of an address, and names written before the value."""
    value = F.lower(span["value"])
    parts = F.filter(F.concat(F.regexp_extract_all(value, F.lit(r"\p{L}+"), F.lit(0)), F.regexp_extract_all(value, F.lit(WORD), F.lit(0))),
                     lambda p: F.length(p) >= PART)
    first = F.greatest(span["start"] - BEFORE, F.lit(0))
    before = F.substring(text, (first + 1).cast("int"), (span["start"] - first).cast("int"))
    names = F.regexp_extract_all(F.regexp_extract(before, NAMES, 1), F.lit(WORD), F.lit(0))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.when(span["kind"] == "email", parts).otherwise(none), F.transform(names, F.lower)))


def _sketched(texts: DataFrame) -> DataFrame:
    """``texts(print, text, ...)`` with ``sketches``: hashes that near copies share, from the least ones of a text's word shingles."""
    # each array is a written column before lambdas look into it, or every step would compute it anew
    words = materialise(texts.withColumn("_words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), "words")
    last = F.greatest(F.size("_words") - 4, F.lit(1))
    shingles = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("_words", i, F.lit(5))))
    hashed = materialise(words.withColumn("_shingles", shingles).drop("_words"), "shingles")

    def least(seed: int) -> Column:
        return F.array_min(F.transform("_shingles", lambda h: F.xxhash64(F.lit(seed), h)))

    sketches = F.array(*[F.xxhash64(F.lit(k), *[least(LEAST * k + j) for j in range(LEAST)]) for k in range(SKETCHES)])
    return hashed.withColumn("sketches", sketches).drop("_shingles")


def _apart(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Texts and independent texts of each key of ``rows(keys, print, sketches)``; near copies are not independent."""
    each = rows.select(*keys, "print", F.posexplode("sketches").alias("k", "sketch"))
    counts = each.groupBy(*keys, "k", "sketch").agg(F.count("*").alias("c")).groupBy(*keys, "k").agg(
        F.sum("c").alias("texts"), F.count("*").alias("apart"))
    return counts.groupBy(*keys).agg(F.max("texts").alias("texts"), F.min("apart").alias("apart"))


def _telling(texts: DataFrame, protected: DataFrame, size: int, disclosure: float) -> DataFrame:
    """Distinct ``(print, term)``: the terms of ``protected(print, copies, entities, text)`` that give an entity of their text away."""
    held = protected.select("print", F.explode(F.array_distinct(F.transform("entities", lambda s: F.concat(
        s["kind"], F.lit(":"), F.lower(s["value"]))))).alias("entity"))
    part = lambda seed: F.sum(F.pmod(F.xxhash64(F.lit(seed), "print"), F.lit(1 << 31)))
    known = held.groupBy("entity").agg(F.count("*").alias("n_e"), part(1).alias("_one"), part(2).alias("_two"))
    # entities of the same texts have the same counts with every term, so they are one
    known = known.select("entity", "n_e", F.xxhash64("n_e", "_one", "_two").alias("same"))
    groups = left_join_unique(held, known, ["entity"], F.col("print"), "inner", small=False)
    groups = materialise(groups.select("print", "entity", "same", "n_e"), "entities")

    # terms beside an entity that stands in several texts
    several = groups.filter("n_e > 1").select("print", "same").distinct().groupBy("print").agg(F.collect_list("same").alias("same"))
    shared = _sketched(protected.select("print", "text").join(several, "print"))
    shared = materialise(shared.select("print", "sketches", "same", _terms(F.col("text")).alias("terms")), "terms-beside")
    beside = materialise(shared.select("print", "sketches", "same", F.explode("terms").alias("term")).select(
        "print", "sketches", "term", F.explode("same").alias("same")), "beside")
    together = _apart(beside, ["same", "term"]).filter("texts > 1 and apart > 1 and 2 * apart >= texts")
    together = materialise(together.select("same", "term", (F.col("texts") - 1).alias("others")), "together")
    beside = left_join_unique(beside.select("print", "same", "term"), together, ["same", "term"], F.col("print"), "inner", small=False)

    # terms that are an entity's own
    own = protected.select("print", "text", F.explode("entities").alias("s")).select(
        "print", F.concat(F.col("s.kind"), F.lit(":"), F.lower("s.value")).alias("entity"),
        F.explode(_own_terms(F.col("text"), F.col("s"))).alias("term")).distinct()
    own = own.join(groups, ["print", "entity"]).select("print", "same", "term", F.lit(0).alias("others"), F.lit(1).alias("own"))
    pairs = beside.withColumn("own", F.lit(0)).select("print", "same", "term", "others", "own").union(own)
    pairs = pairs.groupBy("print", "same", "term").agg((F.max("others") + F.max("own")).alias("seen"))
    pairs = pairs.join(groups.select("print", "same", "n_e").distinct(), ["print", "same"])
    pairs = materialise(pairs, "pairs")

    # rows that hold a term; the copies of a protected text are one
    counts = texts.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    asked = pairs.select("term").distinct()
    counts = counts.join(asked.hint("merge"), "term")
    again = protected.filter("copies > 1").select((F.col("copies") - 1).alias("more"), F.explode(_terms(F.col("text"))).alias("term"))
    again = again.groupBy("term").agg(F.sum("more").alias("more"))
    counts = materialise(counts.join(again.hint("merge"), "term", "left").select(
        "term", (F.col("n") - F.coalesce("more", F.lit(0))).alias("n_t")), "terms")
    scored = left_join_unique(pairs, counts, ["term"], F.col("print"), "inner", small=False)
    all_ = F.lit(float(size))
    told = F.log(F.col("seen") * all_ / ((F.col("n_t") + UNSEEN) * F.col("n_e")))
    return scored.filter((F.col("n_e") < size) & (told >= disclosure * F.log(all_ / F.col("n_e")))).select("print", "term").distinct()


def find_personal(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """``(doc_id, print, base, spans)`` for every row of ``docs(doc_id, text)``.

    ``base`` holds the pattern spans.  ``spans`` also has keys and passwords
    (``secret``), and as ``term`` the words that reveal a protected value of
    their text: those with a share of ``disclosure`` or more of its information,
    by the estimate above, wherever they stand in that text.  ``print`` is a
    hash of the text.

    Null and empty texts have no spans.  Copies of a protected text count as
    one, and repeated rows give the same result each, as do rows with a null
    doc_id.  Very long texts are read whole, in time linear in their words; an
    empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("print", F.xxhash64("text"))
    rows = texts.withColumns({"base": base_spans(F.col("text")), "secrets": secret_spans(F.col("text"))})
    # a key that is a card or an address already is that
    rows = rows.withColumn("secrets", F.filter("secrets", lambda w: ~F.exists(
        "base", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"]))))
    entities = F.concat("base", "secrets").cast(f"array<{_SPAN}>")
    rows = rows.select("doc_id", "print", F.col("base").cast(f"array<{_SPAN}>").alias("base"), entities.alias("entities"),
                       F.when(F.size(entities) > 0, F.col("text")).alias("text"))
    rows = materialise(rows, "personal")
    held = rows.filter(F.col("text").isNotNull())
    copies = held.groupBy("print").agg(F.count("*").alias("copies"))
    protected = held.select("print", "entities", "text").dropDuplicates(["print"]).join(copies, "print")
    protected = materialise(protected, "protected")
    size = rows.select("print").distinct().count()
    telling = materialise(_telling(texts, protected, size, disclosure), "marked")
    # only texts with such a term are cut into words
    several = telling.select("print").distinct()
    places = _places(protected.select("print", "text").join(several, "print", "left_semi"))
    found = left_join_unique(places, telling, ["print", "term"], F.col("start"), "left_semi", small=False).groupBy("print").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_found"))
    # a term inside another protected span is covered anyway
    marked = protected.select("print", "entities").join(found, "print").select("print", F.filter(
        "_found", lambda w: ~F.exists("entities", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"]))).alias("_more"))
    marked = materialise(marked, "terms-of-texts")
    out = left_join_unique(held.drop("text"), marked, ["print"], F.xxhash64("doc_id"), small=False)
    more = F.transform(F.coalesce("_more", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda s: F.struct(
        F.lit(TERM).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(None).cast("string").alias("value")))
    out = out.select("doc_id", "print", "base", F.concat("entities", more).cast(f"array<{_SPAN}>").alias("spans"))
    rest = rows.filter(F.col("text").isNull()).select("doc_id", "print", "base", F.col("entities").alias("spans"))
    return out.unionByName(rest)


def marked_share(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row: texts, protected ones, and the characters of the protected ones with those that spans and terms take.

    ``found`` is the result for ``docs``; it tells how much of a table sanitising takes.
    """
    sizes = docs.select(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("print"),
                        F.length("text").alias("size")).groupBy("print").agg(F.max("size").alias("size"))
    length = lambda term: F.aggregate(F.filter("spans", lambda s: (s["kind"] == TERM) == F.lit(term)), F.lit(0).cast("bigint"),
                                      lambda a, s: a + s["end"] - s["start"])
    spans = found.dropDuplicates(["print"]).select("print", F.size("spans").alias("n"), length(False).alias("values"), length(True).alias("terms"))
    held = F.col("n") > 0
    return spans.join(sizes, "print").agg(
        F.count("*").alias("texts"), F.count_if(held).alias("protected"), F.sum(F.when(held, F.col("size"))).alias("characters"),
        F.sum("values").alias("value_characters"), F.sum("terms").alias("term_characters"))


def redacted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every span of ``found`` replaced by its kind; a term becomes ``[term]``.  Overlaps are one span.

    Rows are met by doc_id and text, so null texts, rows without a doc_id and
    those that ``found`` does not hold stay as they are, and repeated rows
    change alike.  An empty table gives no rows.
    """
    spans = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("_doc"), F.col("print").alias("_print"),
                                                     "spans").dropDuplicates(["_doc", "_print"])
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    spans = materialise(spans.select("_doc", "_print", ordered.alias("_spans")), "redactions")
    text, zero = F.col("text"), F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        put = F.struct(s["end"].alias("at"), F.concat(state["out"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("out"))
        longer = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], put).otherwise(longer)

    rest = F.aggregate("_spans", zero, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(
        text, (s["at"] + 1).cast("int"), F.length(text))))
    keyed = docs.withColumns({"_doc": F.col("doc_id").cast("bigint"), "_print": F.xxhash64(F.coalesce(text, F.lit("")))})
    joined = left_join_unique(keyed, spans, ["_doc", "_print"], F.col("_print"))
    return joined.select(*[F.when(F.col("_spans").isNull(), text).otherwise(rest).alias(c) if c == "text" else F.col(f"`{c}`")
                           for c in docs.columns])
