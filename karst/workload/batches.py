"""Ordered lookups, manifests, training batches and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from karst.operators.batches import batches, id_manifest, rows_at, sample_rows, transform_batches
from karst.operators.lookup import stored_duplicates, take_ids
from karst.workload.registry import query, read


@query("take_ids", "SELECT o_orderkey + 1 AS pos, c_name, c_acctbal FROM orders JOIN customer ON c_custkey = o_custkey")
def take_customers(spark, sf):
    """The customer of every order, in order sequence, with many repeats."""
    request = read(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("pos"), F.col("o_custkey").alias("c_custkey"))
    return take_ids(read(spark, sf, "customer"), request, "c_custkey", ["c_name", "c_acctbal"], keep_pos=True)


@query("take_ids_skip", "SELECT event_id + 1 AS pos, c_custkey, c_mktsegment FROM events JOIN customer ON c_custkey = user_id * 3")
def take_skip(spark, sf):
    request = read(spark, sf, "events").select((F.col("event_id") + 1).alias("pos"), (F.col("user_id") * 3).alias("c_custkey"))
    return take_ids(read(spark, sf, "customer"), request, "c_custkey", ["c_custkey", "c_mktsegment"],
                    on_missing="skip", keep_pos=True)


@query("duplicate_ids", "SELECT l_orderkey, count(*) AS copies FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) "
                        "GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    request = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return stored_duplicates(read(spark, sf, "lineitem"), request, "l_orderkey")


@query("id_manifest", "SELECT row_number() OVER (ORDER BY o_orderkey) AS pos, o_orderkey FROM orders")
def manifest(spark, sf):
    return id_manifest(read(spark, sf, "orders"), "o_orderkey")


@query("manifest_positions", """
WITH m AS (SELECT row_number() OVER (ORDER BY c_custkey) AS spot, c_custkey, c_name FROM customer),
     n AS (SELECT count(*) AS total FROM customer)
SELECT n.total + 1 - m.spot AS pos, c_custkey, c_name FROM m, n
UNION ALL SELECT n.total + m.spot, c_custkey, c_name FROM m, n""")
def positions(spark, sf):
    """The whole table backwards, then forwards again."""
    customer = read(spark, sf, "customer")
    index = id_manifest(customer, "c_custkey")
    size = index.count()
    wanted = spark.range(1, 2 * size + 1).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") <= size, size + 1 - F.col("id")).otherwise(F.col("id") - size).alias("at"))
    return rows_at(customer, index, wanted, "c_custkey", ["c_custkey", "c_name"], size)


@query("batches_seq", """
SELECT (pos - 1) // 256 AS batch_id, pos, o_orderkey, o_totalprice FROM (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS pos, o_orderkey, o_totalprice FROM orders)""")
def batches_seq(spark, sf):
    return batches(read(spark, sf, "orders"), 256, "o_orderkey", ["o_orderkey", "o_totalprice"])


@query("batches_drop_last", """
SELECT (pos - 1) // 256 AS batch_id, pos, o_orderkey FROM (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS pos, o_orderkey, count(*) OVER () AS n FROM orders)
WHERE (pos - 1) // 256 < n // 256""")
def batches_drop_last(spark, sf):
    return batches(read(spark, sf, "orders"), 256, "o_orderkey", ["o_orderkey"], drop_last=True)


@query("batches_shuffled", """
SELECT (pos - 1) // 256 AS batch_id, pos, o_orderkey, o_custkey FROM (
  SELECT row_number() OVER (ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey) AS pos, o_orderkey, o_custkey
  FROM orders)""")
def batches_shuffled(spark, sf):
    return batches(read(spark, sf, "orders"), 256, "o_orderkey", ["o_orderkey", "o_custkey"], shuffle=True, seed=42)


@query("batch_transform", """
SELECT batch_id, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS chars, min(doc_id) AS first_id FROM (
  SELECT (row_number() OVER (ORDER BY md5('7:' || doc_id::VARCHAR), doc_id) - 1) // 64 AS batch_id, doc_id, text
  FROM documents) GROUP BY batch_id""")
def batch_transform(spark, sf):
    def collate(frame):
        import pandas as pd
        return pd.DataFrame({"batch_id": [frame.batch_id.iloc[0]], "n_rows": [len(frame)],
                             "chars": [int(frame.text.str.len().sum())], "first_id": [int(frame.doc_id.min())]})
    rows = batches(read(spark, sf, "documents"), 64, "doc_id", ["doc_id", "text"], shuffle=True, seed=7)
    return transform_batches(rows, collate, "batch_id bigint, n_rows bigint, chars bigint, first_id bigint")


@query("sample_without", "SELECT c_custkey, c_name FROM customer ORDER BY md5('5:' || c_custkey::VARCHAR), c_custkey LIMIT 100")
def sample_without(spark, sf):
    return sample_rows(read(spark, sf, "customer"), 100, "c_custkey", seed=5, columns=["c_custkey", "c_name"])


@query("sample_with", """
WITH m AS (SELECT row_number() OVER (ORDER BY c_custkey) AS spot, c_custkey FROM customer),
     n AS (SELECT count(*) AS total FROM customer)
SELECT d.i + 1 AS pos, m.c_custkey FROM (SELECT unnest(range(total)) AS i, total FROM n) d
JOIN m ON m.spot = CAST('0x' || substr(md5('9:' || d.i::VARCHAR), 1, 15) AS BIGINT) % d.total + 1""")
def sample_with(spark, sf):
    """As many draws as there are customers."""
    customer = read(spark, sf, "customer")
    return sample_rows(customer, customer.count(), "c_custkey", replace=True, seed=9, columns=["c_custkey"])
