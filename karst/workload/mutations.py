"""Deletes and upserts over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from karst import functions as K
from karst.operators.mutate import delete_rows, merge_insert
from karst.workload.registry import query, read

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

# every order comes back under twice its key: half of those keys exist, half are new
_SOURCE = """(SELECT o_orderkey * 2 AS o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 0.5 AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders)"""


def _orders(spark, sf):
    return read(spark, sf, "orders")


def _source(spark, sf):
    return _orders(spark, sf).select(
        (F.col("o_orderkey") * 2).alias("o_orderkey"), "o_custkey", F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") * 0.5).alias("o_totalprice"), "o_orderdate", "o_orderpriority")


def _merge_sql(update: str = "true", insert: bool = True) -> str:
    take = f"s.o_orderkey IS NOT NULL AND coalesce({update}, false)"
    values = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in _COLUMNS)
    sql = f"SELECT {values} FROM orders t LEFT JOIN {_SOURCE} s ON t.o_orderkey = s.o_orderkey"
    if insert:
        sql += (f" UNION ALL SELECT {', '.join(_COLUMNS)} FROM {_SOURCE} s "
                "WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = s.o_orderkey)")
    return sql


@query("delete_sql", "SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders) "
                     "WHERE NOT coalesce(status = 'F' AND o_totalprice > 100000, false)")
def delete_sql(spark, sf):
    rows = _orders(spark, sf).select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice")
    return delete_rows(rows, "status = 'F' AND o_totalprice > 100000")


@query("delete_expr", "SELECT * FROM orders WHERE NOT (o_orderpriority = '1-URGENT' OR o_totalprice < 50000)")
def delete_expr(spark, sf):
    return delete_rows(_orders(spark, sf),
                       (K.col("o_orderpriority") == K.lit("1-URGENT")) | (K.col("o_totalprice") < K.lit(50000)))


@query("merge_upsert", _merge_sql())
def merge_upsert(spark, sf):
    return merge_insert(_orders(spark, sf), _source(spark, sf), "o_orderkey")


@query("merge_shuffled", _merge_sql())
def merge_shuffled(spark, sf):
    """The plan for a source too big to broadcast."""
    return merge_insert(_orders(spark, sf), _source(spark, sf), "o_orderkey", small=False)


@query("merge_insert_only", _merge_sql("false"))
def merge_insert_only(spark, sf):
    return merge_insert(_orders(spark, sf), _source(spark, sf), ["o_orderkey"], update=False)


@query("merge_update_only", _merge_sql(insert=False))
def merge_update_only(spark, sf):
    return merge_insert(_orders(spark, sf), _source(spark, sf), "o_orderkey", insert=False)


@query("merge_condition", _merge_sql("t.o_totalprice < s.o_totalprice"))
def merge_condition(spark, sf):
    return merge_insert(_orders(spark, sf), _source(spark, sf), "o_orderkey",
                        condition="target.o_totalprice < source.o_totalprice")


@query("merge_condition_expr", _merge_sql("t.o_custkey >= s.o_custkey AND nullif(t.o_orderstatus, 'P') <> s.o_orderstatus"))
def merge_condition_expr(spark, sf):
    kept = K.col("target.o_custkey") >= K.col("source.o_custkey")
    known = F.nullif(K.col("target.o_orderstatus"), F.lit("P")) != K.col("source.o_orderstatus")
    return merge_insert(_orders(spark, sf), _source(spark, sf), "o_orderkey", condition=kept & known)


# every turn is rewritten one place later: existing places are replaced, each conversation grows by one
@query("merge_composite", """
WITH s AS (SELECT conv_id, turn + 1 AS turn, role, 'edited ' || text AS text FROM conversations)
SELECT t.conv_id, t.turn, coalesce(s.role, t.role) AS role, coalesce(s.text, t.text) AS text
FROM conversations t LEFT JOIN s ON t.conv_id = s.conv_id AND t.turn = s.turn
UNION ALL
SELECT conv_id, turn, role, text FROM s WHERE NOT EXISTS (
  SELECT 1 FROM conversations t WHERE t.conv_id = s.conv_id AND t.turn = s.turn)""")
def merge_composite(spark, sf):
    target = read(spark, sf, "conversations")
    source = target.select("conv_id", (F.col("turn") + 1).alias("turn"), "role",
                           F.concat(F.lit("edited "), "text").alias("text"))
    return merge_insert(target, source, ["conv_id", "turn"])
