"""Vector, scalar and text indexes as layouts."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from karst.functions.text import PLAIN_LETTERS
from karst.operators import cells as C
from karst.operators.layouts import doc_frequency, text_postings
from karst.operators.search import knn_join
from karst.session import scratch_path
from karst.workload.registry import query, read
from karst.workload.search import _COSINE, _L2, _top, first_vector, rounded
from karst.workload.tables import new_database


def _table(spark, sf, **index):
    table = new_database(spark).create_table("embeddings", read(spark, sf, "embeddings"))
    if index:
        table.create_vector_index("embedding", **index)
    return table


def _layout(spark, sf, metric="l2", codec=None):
    rows = read(spark, sf, "embeddings")
    cells = C.train_cells(rows, "embedding", metric)
    assigned = C.assign_cells(rows, "embedding", cells)
    codes = None
    if codec is not None:
        codes = codec(assigned, "embedding", cells)
        assigned = C.add_codes(assigned, "embedding", cells, codes)
    path = scratch_path(spark, "cells")
    C.write_cells(assigned, cells, path)
    return spark.read.parquet(path), cells, codes


@query("ivf_flat_build", "SELECT vec_id, label, CAST(64 AS BIGINT) AS dim FROM embeddings")
def ivf_flat_build(spark, sf):
    layout, _, _ = _layout(spark, sf)
    return layout.select("vec_id", "label", F.size("embedding").cast("bigint").alias("dim"))


@query("ivf_flat_all_probes", _top(_L2))
def ivf_all(spark, sf):
    table = _table(spark, sf, type="ivf_flat")
    found = (table.vector_search(first_vector(spark, sf), "embedding").nprobes(1_000_000).limit(10)
             .select_cols("vec_id", "label").tie_break("vec_id").execute())
    return rounded(found)


@query("ivf_cosine_all_probes", _top(_COSINE, "label <> 3"))
def ivf_cosine(spark, sf):
    layout, cells, _ = _layout(spark, sf, "cosine")
    return rounded(C.ivf_search(layout, cells, first_vector(spark, sf), 10, "embedding", None, key="vec_id",
                                select=["vec_id", "label"], where="label <> 3"))


def _recall(spark, sf, search, wanted: float = 0.9):
    """Ten neighbours of the five vectors with the smallest ids: is ``wanted`` of the exact ones found, and no row out of order."""
    rows = read(spark, sf, "embeddings")
    queries = rows.orderBy("vec_id").limit(5).collect()
    found = None
    for q in queries:
        one = search(list(q.embedding)).select(F.lit(q.vec_id).alias("query_id"), "vec_id")
        found = one if found is None else found.unionByName(one)
    asked = spark.createDataFrame([(q.vec_id, list(q.embedding)) for q in queries], "query_id bigint, q array<float>")
    exact = knn_join(asked, rows, 10, "query_id", "vec_id", "q", "embedding").select("query_id", "vec_id")
    hits = exact.join(found.withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    all_five = Window.partitionBy(F.lit(1))
    return hits.groupBy("query_id").agg(F.count("*").alias("k"), F.count("hit").alias("hits")).select(
        "query_id", "k", (F.sum("hits").over(all_five) >= wanted * F.sum("k").over(all_five)).alias("recall_reached"))


_REACHED = "SELECT vec_id AS query_id, CAST(10 AS BIGINT) AS k, true AS recall_reached FROM embeddings ORDER BY vec_id LIMIT 5"


@query("ivf_flat_probe", _REACHED)
def ivf_probe(spark, sf):
    """Three quarters of the cells hold nine tenths of the neighbours, also where vectors have no clusters."""
    layout, cells, _ = _layout(spark, sf)
    probes = -(-3 * len(cells.centres) // 4)
    return _recall(spark, sf, lambda q: C.ivf_search(layout, cells, q, 10, "embedding", probes, key="vec_id", select=["vec_id"]))


@query("ivf_pq_build", "SELECT vec_id, CAST(4 AS BIGINT) AS code_bytes, true AS error_bounded FROM embeddings")
def ivf_pq_build(spark, sf):
    """Codes of all vectors; together they keep at least half of what the cells' centres leave over."""
    layout, cells, codes = _layout(spark, sf, codec=C.train_product_codes)
    errors = C.code_errors(layout, "embedding", cells, codes)
    total = errors.agg((F.sum("_error") <= 0.5 * F.sum("_energy")).alias("error_bounded"))
    return layout.select("vec_id", F.octet_length("_code").cast("bigint").alias("code_bytes")).join(F.broadcast(total))


@query("ivf_pq_search", _REACHED)
def ivf_pq_search(spark, sf):
    """Ten candidates a neighbour, or as many as nine tenths of the neighbours take by measure: a share of the rows where vectors have no clusters."""
    layout, cells, codes = _layout(spark, sf, codec=C.train_product_codes)
    factor = max(10, C.measured_refine_factor(layout, cells, codes, 10, "embedding", "vec_id"))
    return _recall(spark, sf, lambda q: C.code_search(layout, cells, codes, q, 10, "embedding", "vec_id", nprobes=None,
                                                      refine_factor=factor, select=["vec_id"]))


@query("pq_refine_full", _top(_L2))
def pq_refine(spark, sf):
    layout, cells, codes = _layout(spark, sf, codec=C.train_product_codes)
    factor = -(-layout.count() // 10)
    return rounded(C.code_search(layout, cells, codes, first_vector(spark, sf), 10, "embedding", "vec_id",
                                 nprobes=None, refine_factor=factor, select=["vec_id", "label"]))


@query("ivf_sq_search", _REACHED)
def ivf_sq_search(spark, sf):
    table = _table(spark, sf, type="ivf_sq")
    return _recall(spark, sf, lambda q: table.vector_search(q, "embedding").nprobes(1_000_000).refine_factor(4).limit(10)
                   .select_cols("vec_id").tie_break("vec_id").execute())


@query("auto_index", _top(_L2))
def auto_index(spark, sf):
    """A type chosen by the library; all cells give the exact answer."""
    table = _table(spark, sf, type="auto")
    found = (table.vector_search(first_vector(spark, sf), "embedding").nprobes(1_000_000).limit(10)
             .select_cols("vec_id", "label").tie_break("vec_id").execute())
    return rounded(found)


_SHIFT = 1_000_000
_BOTH = ("(SELECT vec_id, label, embedding FROM embeddings UNION ALL "
         f"SELECT vec_id + {_SHIFT}, label, list_reverse(embedding) FROM embeddings)")


def _grown(spark, sf):
    """Indexed table that then doubles in size by reversed vectors."""
    table = _table(spark, sf, type="ivf_flat")
    rows = read(spark, sf, "embeddings")
    return table.add(rows.select((F.col("vec_id") + _SHIFT).alias("vec_id"), F.reverse("embedding").alias("embedding"), "label"))


@query("ivf_incremental", _top(_L2, source=_BOTH, k=20))
def ivf_incremental(spark, sf):
    table = _grown(spark, sf).optimize("index")
    found = (table.vector_search(first_vector(spark, sf), "embedding").nprobes(1_000_000).limit(20)
             .select_cols("vec_id", "label").tie_break("vec_id").execute())
    return rounded(found)


@query("ivf_unindexed_delta", _top(_L2, source=_BOTH, k=20))
def ivf_delta(spark, sf):
    """Rows appended after the build are scanned next to the index."""
    found = (_grown(spark, sf).vector_search(first_vector(spark, sf), "embedding").nprobes(1_000_000).limit(20)
             .select_cols("vec_id", "label").tie_break("vec_id").execute())
    return rounded(found)


@query("index_stats", """
SELECT 'before' AS moment, count(*) AS indexed, count(*) AS unindexed, CAST(1 AS BIGINT) AS fragments FROM embeddings
UNION ALL SELECT 'after', 2 * count(*), 0, 2 FROM embeddings""")
def index_stats(spark, sf):
    table = _grown(spark, sf)
    rows = []
    for moment in ("before", "after"):
        stats = table.index_stats("embedding_idx")
        rows.append((moment, stats.num_indexed_rows, stats.num_unindexed_rows, stats.num_indices))
        table.optimize("index")
    return spark.createDataFrame(rows, "moment string, indexed bigint, unindexed bigint, fragments bigint")


@query("range_layout_lookup", """
SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01'""")
def range_lookup(spark, sf):
    table = new_database(spark).create_table("lineitem", read(spark, sf, "lineitem"))
    name = table.create_scalar_index("l_shipdate")
    return (table.query().use_index(name)
            .filter_where("l_shipdate >= TIMESTAMP_NTZ '1997-03-01' AND l_shipdate < TIMESTAMP_NTZ '1997-04-01'")
            .select_cols("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate").execute())


@query("bitmap_layout_lookup", "SELECT event_id, event_type, value FROM events WHERE event_type IN ('view', 'error')")
def bitmap_lookup(spark, sf):
    table = new_database(spark).create_table("events", read(spark, sf, "events"))
    name = table.create_scalar_index("event_type", "bitmap")
    return (table.query().use_index(name).filter_where("event_type IN ('view', 'error')")
            .select_cols("event_id", "event_type", "value").execute())


@query("label_list_lookup", """
SELECT p_partkey, p_brand FROM part WHERE list_contains(string_split(p_name, ' '), 'red')
   OR list_contains(string_split(p_name, ' '), 'ring')""")
def label_lookup(spark, sf):
    parts = read(spark, sf, "part").select("p_partkey", "p_brand", F.split("p_name", " ").alias("words"))
    table = new_database(spark).create_table("part", parts)
    name = table.create_scalar_index("words", "labellist", key="p_partkey")
    return table.indexes.rows_with_labels(name, ["red", "ring"]).select("p_partkey", "p_brand")


@query("label_list_all", """
SELECT p_partkey, p_brand FROM part WHERE list_contains(string_split(p_name, ' '), 'red')
  AND list_contains(string_split(p_name, ' '), 'ring')""")
def label_all(spark, sf):
    parts = read(spark, sf, "part").select("p_partkey", "p_brand", F.split("p_name", " ").alias("words"))
    table = new_database(spark).create_table("part", parts)
    name = table.create_scalar_index("words", "labellist", key="p_partkey")
    return table.indexes.rows_with_labels(name, ["red", "ring"], "all").select("p_partkey", "p_brand")


# ------------------------------------------------------------------------ text

_TOKENS = r"SELECT doc_id, unnest(regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+')) AS term FROM documents"

# A short English stop-word list.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no",
              "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this",
              "to", "was", "will", "with"]


def _postings_sql(text: str = "lower(text)", where: str = "true", term: str = "term") -> str:
    return (f"SELECT {term} AS term, doc_id, count(*) AS tf FROM ({_TOKENS.format(text=text)}) WHERE {where} "
            f"GROUP BY 1, 2")


def _postings(spark, sf, **options):
    return text_postings(read(spark, sf, "documents"), "text", "doc_id", **options).drop("field")


@query("fts_postings", _postings_sql())
def fts_postings(spark, sf):
    return _postings(spark, sf)


@query("fts_doc_freq", f"SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM ({_postings_sql()}) GROUP BY term")
def fts_doc_freq(spark, sf):
    postings = text_postings(read(spark, sf, "documents"), "text", "doc_id")
    return doc_frequency(postings).drop("field")


@query("fts_stop_words", _postings_sql(where="length(term) <= 12 AND term NOT IN (" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"))
def fts_stop_words(spark, sf):
    return _postings(spark, sf, remove_stop_words=True, words=STOP_WORDS, max_token_length=12)


_FOLDED = "strip_accents(term)"
for _letter, _plain in PLAIN_LETTERS.items():
    _FOLDED = f"replace({_FOLDED}, '{_letter}', '{_plain}')"


@query("fts_folded", f"SELECT term, doc_id, CAST(sum(tf) AS BIGINT) AS tf FROM ({_postings_sql(term=_FOLDED)}) GROUP BY 1, 2")
def fts_folded(spark, sf):
    return _postings(spark, sf, ascii_folding=True)


@query("fts_case_kept", _postings_sql(text="text"))
def fts_case(spark, sf):
    return _postings(spark, sf, lowercase=False)


@query("fts_stemmed")
def fts_stemmed(spark, sf):
    return _postings(spark, sf, stem=True)


@query("fts_stemmed_totals", f"SELECT doc_id, CAST(sum(tf) AS BIGINT) AS tf FROM ({_postings_sql()}) GROUP BY 1")
def fts_stemmed_totals(spark, sf):
    """Stemming merges terms of a document and loses no occurrence."""
    return _postings(spark, sf, stem=True).groupBy("doc_id").agg(F.sum("tf").alias("tf"))


@query("fts_index", _postings_sql())
def fts_index(spark, sf):
    table = new_database(spark).create_table("documents", read(spark, sf, "documents"))
    name = table.create_fts_index("text", key="doc_id")
    return table.indexes.postings(name).drop("field")
