"""Registered queries of the operators, each over its whole table, and their SQL.

A query only reads its table, calls its operator with production parameters and
derives the digest columns; the operators keep their own interfaces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from karst.llm.alignment import token_alignment
from karst.llm.anchors import without_windows
from karst.llm.classifier import quality_scores
from karst.llm.extraction import page_texts
from karst.llm.filters import filter_audit
from karst.llm.jaccard import similar_groups
from karst.llm.licenses import license_scan
from karst.llm.lines import line_rules
from karst.llm.mixing import fair_mix, word_count
from karst.llm.packing import pack_documents
from karst.llm.privacy import KINDS, count_of, find_personal, written
from karst.llm.repeats import without_repeats
from karst.llm.topk import scaled, top_k
from karst.session import ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = line_rules(_table(spark, sf_dir, "documents"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "n_dropped_words")


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(_table(spark, sf_dir, "embeddings"))
    return top_k(vectors.filter("vec_id % 20 = 0"), vectors, 20)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def tokenizer() -> str:
    """Definition of the tokenizer that packing counts in."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer())


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    plan = fair_mix(docs, F.col("words"), F.xxhash64(F.lit(42), "doc_id"))
    return plan.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "finish")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(_table(spark, sf_dir, "documents"))
    counts = [count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def op11_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_windows(_table(spark, sf_dir, "documents"), text=False).drop("kept")


def alignment_models() -> tuple[str, bytes]:
    """The two tokenizers that alignment compares: a byte-level definition and a sentence-piece model."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as one, \
            open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as two:
        return one.read(), two.read()


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(_table(spark, sf_dir, "documents"), *alignment_models())


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_line_frequency": op2_line_frequency,
    "op3_page_text": op3_page_text,
    "op4_top_k": op4_top_k,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_packing": op7_packing,
    "op8_source_mix": op8_source_mix,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_personal_data": op10_personal_data,
    "op11_cover_dedup": op11_cover_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op4_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
            FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op13_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
        l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
                 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
                 coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
            FROM w LEFT JOIN l USING (doc_id)),
        g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (
            SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
            WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
        r AS (
            SELECT g.*, filter_order, step, fails[ascii(filter_order[step]) - 64] AS failed,
                coalesce(list_filter(range(1, 6), lambda s: fails[ascii(filter_order[s]) - 64])[1], 6) AS gone
            FROM g, o, (SELECT unnest(range(1, 6)) AS step)),
        s AS (
            SELECT part, filter_order, step::INTEGER AS step, filter_order[step] AS filter,
                sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
                sum(n) FILTER (failed AND gone < step) AS redundant,
                sum(n) FILTER (failed AND len(list_filter(fails, lambda y: y)) = 1) AS unique_fails,
                sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
            FROM r GROUP BY ALL)
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
            coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
            coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
            (sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter))::BIGINT AS shapley
        FROM s""",
}
