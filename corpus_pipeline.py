"""A training corpus from ``documents``: five stages, each one operator, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from karst.llm.classifier import quality_scores
from karst.llm.jaccard import similar_groups
from karst.llm.mixing import fair_mix, mixed, word_count
from karst.llm.packing import pack_documents
from karst.llm.privacy import find_personal, redacted
from karst.llm.queries import tokenizer
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; rows without a doc_id have no verdict and go."""
    scores = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # rows that share a doc_id share the better verdict
    kept = materialise(scores.filter("predicted = 1 and doc_id is not null").select("doc_id").distinct(), "accepted")
    # the verdicts grow with the documents, so both sides shuffle at any size
    return left_join_unique(docs, kept.hint("merge"), ["doc_id"], F.xxhash64("text"), "left_semi", small=False).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest doc_id."""
    groups = similar_groups(docs)
    kept = materialise(groups.filter("doc_id = component_id").select("doc_id").distinct(), "representatives")
    joined = left_join_unique(docs, kept.hint("merge"), ["doc_id"], F.xxhash64("text"), "left_semi", small=False)
    # texts are only dealt out anew where a doc_id is stored more than once
    again = materialise(docs.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return joined.select(docs.columns)
    once, more = joined.join(again, "doc_id", "left_anti"), joined.join(again, "doc_id", "left_semi")
    return once.unionByName(more.dropDuplicates(["doc_id"])).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and telling terms replaced; ``n_chars`` follows the new text."""
    cleaned = redacted(docs, find_personal(docs))
    changes = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cleaned.withColumns(changes).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share takes them; the one at a source's cut gives its first words."""
    plan = fair_mix(docs, word_count(F.col("text")), F.xxhash64(F.lit(42), "doc_id"))
    taken = mixed(docs, plan)
    changes = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return taken.withColumns(changes).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in one piece of one sequence."""
    return pack_documents(docs, tokenizer())


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing to target weights", mixture),
    ("packing", packing),
]

#: SQL cannot express these stages; tests compare each with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result but the last is written and read again."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
