"""Nearest-neighbour queries.  Distances are compared at four decimals."""

from __future__ import annotations

from pyspark.sql import functions as F

from karst import functions as K
from karst.operators.embed import embedding_dims, embedding_search, with_embeddings
from karst.operators.search import DISTANCE, knn, knn_join
from karst.workload.registry import query, read

_Q = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
_L2 = f"CAST(list_distance(embedding::DOUBLE[], {_Q}) AS FLOAT)"
_COSINE = f"CAST(list_cosine_distance(embedding::DOUBLE[], {_Q}) AS FLOAT)"
_DOT = f"CAST(1 - list_inner_product(embedding::DOUBLE[], {_Q}) AS FLOAT)"


def _top(distance: str, where: str = "true", k: int = 10, offset: int = 0, columns: str = "vec_id, label",
         source: str = "embeddings") -> str:
    return (f"SELECT {columns}, round(d::DOUBLE, 4) + 0.0 AS _distance FROM (SELECT *, {distance} AS d FROM {source}) "
            f"WHERE {where} ORDER BY d, vec_id LIMIT {k} OFFSET {offset}")


def rounded(df):
    return df.withColumn(DISTANCE, F.round(F.col(DISTANCE).cast("double"), 4) + F.lit(0.0))


def _embeddings(spark, sf):
    return read(spark, sf, "embeddings")


def first_vector(spark, sf):
    return _embeddings(spark, sf).filter("vec_id = 0").first().embedding


def _search(spark, sf, **options):
    options = {"select": ["vec_id", "label"], "key": "vec_id", "column": "embedding", "k": 10, **options}
    return rounded(knn(_embeddings(spark, sf), first_vector(spark, sf), **options))


@query("knn_l2", _top(_L2))
def knn_l2(spark, sf):
    return _search(spark, sf)


@query("knn_columns", _top(_L2))
def knn_columns(spark, sf):
    return _search(spark, sf, engine="columns")


@query("knn_cosine", _top(_COSINE))
def knn_cosine(spark, sf):
    return _search(spark, sf, metric="cosine")


@query("knn_dot", _top(_DOT))
def knn_dot(spark, sf):
    return _search(spark, sf, metric="dot")


_CODES = "(SELECT vec_id, label, [CASE WHEN x > 0 THEN 1 ELSE 0 END FOR x IN embedding] AS code FROM embeddings)"
_HAMMING = (f"CAST(list_sum([bit_count(xor(z[1], z[2])) FOR z IN list_zip(code, "
            f"(SELECT code FROM {_CODES} WHERE vec_id = 0))]) AS FLOAT)")


@query("knn_hamming", _top(_HAMMING, source=_CODES))
def knn_hamming(spark, sf):
    codes = _embeddings(spark, sf).select(
        "vec_id", "label", F.transform("embedding", lambda x: (x > 0).cast("int")).alias("code"))
    target = codes.filter("vec_id = 0").first().code
    return rounded(knn(codes, target, 10, "code", "hamming", "vec_id", select=["vec_id", "label"]))


@query("knn_implicit", _top(_L2))
def knn_implicit(spark, sf):
    return _search(spark, sf, column=None)


@query("knn_filter_where", _top(_L2, "label IN (1, 3, 5)"))
def knn_filter_where(spark, sf):
    return _search(spark, sf, where="label IN (1, 3, 5)")


@query("knn_filter_expr", _top(_COSINE, "label > 2 AND label <> 4"))
def knn_filter_expr(spark, sf):
    return _search(spark, sf, metric="cosine", where=(K.col("label") > K.lit(2)) & (K.col("label") != K.lit(4)))


@query("knn_postfilter", f"SELECT * FROM ({_top(_L2, k=50)}) WHERE label IN (1, 3, 5)")
def knn_postfilter(spark, sf):
    return _search(spark, sf, k=50, where="label IN (1, 3, 5)", prefilter=False)


@query("knn_select", _top(_L2, columns="label, len(embedding) AS dim", k=20))
def knn_select(spark, sf):
    found = _search(spark, sf, select=["label", "embedding"], k=20)
    return found.select("label", F.size("embedding").cast("bigint").alias("dim"), DISTANCE)


@query("knn_offset", _top(_L2, offset=10))
def knn_offset(spark, sf):
    return _search(spark, sf, offset=10)


@query("knn_join", """
SELECT qid, vec_id, round(d::DOUBLE, 4) + 0.0 AS _distance FROM (
  SELECT q.vec_id AS qid, v.vec_id, CAST(list_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS FLOAT) AS d,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY
           CAST(list_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS FLOAT), v.vec_id) AS r
  FROM embeddings q, embeddings v) WHERE r <= 5""")
def knn_of_all(spark, sf):
    """Five neighbours of every vector, itself included."""
    vectors = _embeddings(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("qid"), "embedding")
    return rounded(knn_join(queries, vectors, 5, "qid", "vec_id", "embedding", "embedding"))


@query("knn_join_cosine", """
SELECT qid, vec_id, round(d::DOUBLE, 4) + 0.0 AS _distance FROM (
  SELECT q.vec_id AS qid, v.vec_id,
         CAST(list_cosine_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS FLOAT) AS d,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY
           round(list_cosine_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6), v.vec_id) AS r
  FROM embeddings q, embeddings v) WHERE r <= 3""")
def knn_join_blocks(spark, sf):
    """The same operator with both sides split into co-grouped blocks."""
    vectors = _embeddings(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("qid"), "embedding")
    return rounded(knn_join(queries, vectors, 3, "qid", "vec_id", "embedding", "embedding", "cosine",
                            query_block=400, vector_block=400, broadcast_bytes=0))


@query("knn_join_pivots", """
SELECT qid, vec_id, round(d::DOUBLE, 4) + 0.0 AS _distance FROM (
  SELECT q.vec_id AS qid, v.vec_id, CAST(list_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS FLOAT) AS d,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY
           CAST(list_distance(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS FLOAT), v.vec_id) AS r
  FROM embeddings q, embeddings v) WHERE r <= 5""")
def knn_join_pivots(spark, sf):
    """Five neighbours of every vector, with both sides cut along a Voronoi partition."""
    vectors = _embeddings(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("qid"), "embedding")
    return rounded(knn_join(queries, vectors, 5, "qid", "vec_id", "embedding", "embedding", query_block=400, vector_block=400,
                            broadcast_bytes=0))


# ------------------------------------------------------------------ embeddings

def length_encoder(values):
    """Toy encoder: [number of characters, 1]."""
    return [[float(len(v)), 1.0] for v in values]


@query("with_embeddings", "SELECT doc_id, CAST(length(text) AS FLOAT) AS e1, CAST(1 AS FLOAT) AS e2, "
                          "CAST(2 AS BIGINT) AS dim FROM documents")
def embed_documents(spark, sf):
    out = with_embeddings(read(spark, sf, "documents").select("doc_id", "text"), "text", length_encoder)
    return out.select("doc_id", F.col("embedding")[0].alias("e1"), F.col("embedding")[1].alias("e2"),
                      F.size("embedding").cast("bigint").alias("dim"))


@query("embedding_search", """
SELECT doc_id, round(d::DOUBLE, 4) + 0.0 AS _distance FROM (
  SELECT doc_id, CAST(abs(length(text) - (SELECT length(text) FROM documents WHERE doc_id = 0)) AS FLOAT) AS d
  FROM documents) ORDER BY d, doc_id LIMIT 20""")
def search_text(spark, sf):
    documents = read(spark, sf, "documents").select("doc_id", "text")
    encoded = with_embeddings(documents, "text", length_encoder, check=False)
    value = documents.filter("doc_id = 0").first().text
    return rounded(embedding_search(encoded, value, length_encoder, 20, key="doc_id", select=["doc_id"]))


@query("embedding_dims", """
SELECT count(embedding) AS vectors, CAST(min(len(embedding)) AS BIGINT) AS min_dim,
       CAST(max(len(embedding)) AS BIGINT) AS max_dim,
       bool_and(len([x FOR x IN embedding IF NOT isfinite(x)]) = 0) AS all_finite FROM embeddings""")
def dims(spark, sf):
    out = embedding_dims(_embeddings(spark, sf), "embedding")
    return out.select("vectors", F.col("min_dim").cast("bigint").alias("min_dim"),
                      F.col("max_dim").cast("bigint").alias("max_dim"), "all_finite")
