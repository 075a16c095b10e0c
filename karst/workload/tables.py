"""Stored tables: create, append, stream, change, compact, inspect."""

from __future__ import annotations

from pyspark.sql import functions as F

from karst.operators.bounds import left_join_unique
from karst.plans.store import Database
from karst.session import scratch_path
from karst.sources.media import media_facts
from karst.streaming import append_stream
from karst.workload.registry import query, read


def new_database(spark) -> Database:
    return Database(spark, scratch_path(spark, "db"))


@query("create_scan", "SELECT * FROM part")
def create_scan(spark, sf):
    table = new_database(spark).create_table("part", read(spark, sf, "part"))
    return table.query().execute()


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf):
    """From the commit record of a stored table; no row is read for it."""
    table = new_database(spark).create_table("lineitem", read(spark, sf, "lineitem"))
    return spark.createDataFrame([(table.count_rows(),)], "n bigint")


_SHIFT = 10_000_000


def _shifted(spark, sf):
    return read(spark, sf, "customer").withColumn("c_custkey", F.col("c_custkey") + _SHIFT)


@query("append_union", f"SELECT * FROM customer UNION ALL SELECT * REPLACE (c_custkey + {_SHIFT} AS c_custkey) FROM customer")
def append_union(spark, sf):
    table = new_database(spark).create_table("customer", read(spark, sf, "customer"))
    return table.add(_shifted(spark, sf)).to_df()


@query("append_partitions", f"SELECT * FROM customer UNION ALL SELECT * REPLACE (c_custkey + {_SHIFT} AS c_custkey) FROM customer "
                            f"UNION ALL SELECT * REPLACE (c_custkey + {2 * _SHIFT} AS c_custkey) FROM customer")
def append_parts(spark, sf):
    first = _shifted(spark, sf)
    table = new_database(spark).create_table("customer", read(spark, sf, "customer"))
    table.append_partitions([first, first.withColumn("c_custkey", F.col("c_custkey") + _SHIFT)])
    return table.to_df()


@query("append_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_events(spark, sf):
    events = read(spark, sf, "events")
    source = scratch_path(spark, "stream-source")
    events.write.parquet(source)
    table = new_database(spark).create_table("events", schema=events.schema)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1000).parquet(source)
    append_stream(stream, table, "events").awaitTermination()
    return table.to_df()


@query("stored_delete", "SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 200000)")
def stored_delete(spark, sf):
    table = new_database(spark).create_table("orders", read(spark, sf, "orders"))
    table.delete_rows("o_orderstatus = 'F' AND o_totalprice > 200000")
    return table.to_df()


@query("stored_merge", """
SELECT o.o_orderkey, o.o_custkey, coalesce(s.o_totalprice, o.o_totalprice) AS o_totalprice FROM orders o
LEFT JOIN (SELECT o_orderkey * 2 AS o_orderkey, o_totalprice FROM orders) s ON s.o_orderkey = o.o_orderkey
UNION ALL
SELECT o_orderkey * 2, o_custkey, o_totalprice FROM orders s
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = s.o_orderkey * 2)""")
def stored_merge(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    table = new_database(spark).create_table("orders", orders)
    source = orders.select((F.col("o_orderkey") * 2).alias("o_orderkey"), F.col("o_custkey").alias("own"), "o_totalprice")
    # an update keeps the customer of the stored order
    merged = left_join_unique(source, orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], F.xxhash64("own", "o_totalprice"),
                              bounded=True).select("o_orderkey", F.coalesce("o_custkey", "own").alias("o_custkey"), "o_totalprice")
    return table.merge_insert(merged, "o_orderkey").to_df()


def _history(spark, sf):
    table = new_database(spark).create_table("customer", read(spark, sf, "customer"))
    table.add(_shifted(spark, sf))
    table.delete_rows(F.col("c_acctbal") < 0)
    return table


@query("version_counter", "SELECT 3 AS version, 2 * count(*) FILTER (WHERE c_acctbal >= 0) AS n FROM customer")
def version_counter(spark, sf):
    table = _history(spark, sf)
    return table.to_df().agg(F.lit(table.version).alias("version"), F.count("*").alias("n"))


@query("list_versions", """
SELECT 1 AS version, 'create' AS operation, count(*) AS n FROM customer
UNION ALL SELECT 2, 'append', 2 * count(*) FROM customer
UNION ALL SELECT 3, 'delete', 2 * count(*) FILTER (WHERE c_acctbal >= 0) FROM customer""")
def list_versions(spark, sf):
    return _history(spark, sf).list_versions().select(
        F.col("version").cast("int").alias("version"), "operation", F.col("metadata")["rows"].cast("bigint").alias("n"))


@query("table_schema", """
SELECT column_name AS path, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
       WHEN 'FLOAT[]' THEN 'array<float>' END AS type,
       CASE WHEN column_name = 'embedding' THEN (SELECT max(len(embedding)) FROM embeddings) END AS vector_dim
FROM (DESCRIBE SELECT * FROM embeddings)""")
def table_schema(spark, sf):
    tree = new_database(spark).create_table("embeddings", read(spark, sf, "embeddings")).describe()
    return tree.filter(~F.col("path").contains(".")).select("path", "type", F.col("vector_dim").cast("bigint").alias("vector_dim"))


@query("table_names", """
SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def table_names(spark, sf):
    db = new_database(spark)
    for name in ("supplier", "nation", "customer"):
        db.create_table(name, read(spark, sf, name))
    frames = [db.open_table(n).to_df().agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in db.table_names()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("compact_files", f"SELECT * FROM customer UNION ALL SELECT * REPLACE (c_custkey + {_SHIFT} AS c_custkey) FROM customer")
def compact_files(spark, sf):
    table = new_database(spark).create_table("customer", read(spark, sf, "customer"))
    table.add(_shifted(spark, sf)).optimize("compact")
    return table.to_df()


@query("media_bytes", "SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, md5(html) AS md5 FROM pages")
def media_bytes(spark, sf):
    pages = read(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    table = new_database(spark).create_table("pages", pages)
    return media_facts(table.to_df(), "page_id").withColumn("n_bytes", F.col("n_bytes").cast("bigint"))
