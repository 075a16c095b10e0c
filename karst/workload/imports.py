"""Imports: whole tables are written by Spark in the source format and read back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from karst.session import scratch_path
from karst.sources.arrow_ipc import read_arrow, write_arrow
from karst.sources.csv import read_csv
from karst.sources.imports import import_csv, import_json
from karst.sources.json import audit_report, read_json, row_objects
from karst.sources.sqlite import read_sqlite, write_sqlite
from karst.workload.registry import query, read
from karst.workload.tables import new_database


def array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    """Lines of one JSON array of row objects, a list for each batch."""
    import json
    mark = "["
    for batch in batches:
        lines = [json.dumps(row, ensure_ascii=False) for row in batch.to_pylist()]
        if lines:
            yield [mark + lines[0], *("," + line for line in lines[1:])]
            mark = ","
    if mark == ",":
        yield ["]"]


def write_documents(rows, path: str, columnar: bool = False) -> None:
    """A JSON document for each partition: an array of row objects, or an object of column arrays."""
    names = rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        def text(lines: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

        if columnar:
            # held as Arrow; a column becomes text a batch at a time
            held = [b for b in batches if b.num_rows]
            for i, n in enumerate(names if held else ()):
                mark = f"{',' if i else '{'}{json.dumps(n)}:["
                for batch in held:
                    values = json.dumps(batch.column(i).to_pylist(), ensure_ascii=False, separators=("\n,", ":"))
                    yield text([mark + values[1:-1]])
                    mark = ","
                yield text(["]"])
            if held:
                yield text(["}"])
            return
        for lines in array_lines(batches):
            yield text(lines)

    # a partition without rows has no document
    rows.mapInArrow(pack, "value string").write.text(path)


@query("import_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_orders(spark, sf):
    orders = read(spark, sf, "orders")
    path = scratch_path(spark, "csv")
    (orders.write.option("header", True).option("sep", ";").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .csv(path))
    return import_csv(new_database(spark), path, "orders", types=orders.schema, delim=";").to_df()


@query("import_csv_inferred", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_customer(spark, sf):
    path = scratch_path(spark, "csv")
    read(spark, sf, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path)


_EVENTS = ("SELECT event_id, user_id, nullif(event_type, 'click') AS kind, value, value > 10 AS big, props, "
           "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events")


def _events(spark, sf):
    return read(spark, sf, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("click")).alias("kind"), "value",
        (F.col("value") > 10).alias("big"), "props", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("import_json_rows", _EVENTS)
def json_rows(spark, sf):
    path = scratch_path(spark, "json")
    write_documents(_events(spark, sf), path)
    return import_json(new_database(spark), path, "events").to_df()


@query("import_json_columns", _EVENTS)
def json_columns(spark, sf):
    path = scratch_path(spark, "json")
    write_documents(_events(spark, sf), path, columnar=True)
    return read_json(spark, path)


@query("import_jsonl", _EVENTS)
def json_lines(spark, sf):
    path = scratch_path(spark, "json")
    _events(spark, sf).write.json(path)
    return read_json(spark, path, jsonlines=True)


@query("json_type_audit", """
SELECT 'id' AS name, count(*) AS n_int, 0::BIGINT AS n_float, 0::BIGINT AS n_string, 0::BIGINT AS n_bool,
       CAST(count(*) FILTER (WHERE event_id % 2 = 1) AS BIGINT) AS inexact_ints FROM events
UNION ALL SELECT 'kind', 0, 0, count(*) FILTER (WHERE event_type <> 'click'), 0, 0 FROM events
UNION ALL SELECT 'mixed', count(*) FILTER (WHERE value <= 10), 0, 0, count(*) FILTER (WHERE value > 10), 0 FROM events""")
def json_audit(spark, sf):
    """Counts of value kinds: ids beyond 2^53, absent strings, and a column that mixes kinds."""
    big = F.col("event_id") + F.lit(9007199254740992)
    text = read(spark, sf, "events").select(F.concat_ws(
        "", F.lit('{"id":'), big.cast("string"),
        F.when(F.col("event_type") != "click", F.concat(F.lit(',"kind":"'), "event_type", F.lit('"'))).otherwise(""),
        F.lit(',"mixed":'), F.when(F.col("value") > 10, "true").otherwise(F.col("user_id").cast("string")),
        F.lit("}")).alias("value"))
    path = scratch_path(spark, "json")
    text.write.text(path)
    docs = spark.read.text(path).select(F.parse_json("value").alias("v"))
    report = audit_report(row_objects(docs, True))
    return report.select("name", "n_int", "n_float", "n_string", "n_bool", "inexact_ints")


@query("import_json_vectors", """
SELECT vec_id, label, CAST(len(embedding) AS BIGINT) AS dim, embedding[1] AS first, embedding[64] AS last FROM embeddings""")
def json_vectors(spark, sf):
    path = scratch_path(spark, "json")
    read(spark, sf, "embeddings").write.json(path)
    table = import_json(new_database(spark), path, "vectors", jsonlines=True, types={"label": "int"},
                        vector_columns=["embedding"])
    return table.to_df().select("vec_id", "label", F.size("embedding").cast("bigint").alias("dim"),
                                F.col("embedding")[0].alias("first"), F.col("embedding")[63].alias("last"))


@query("import_sqlite", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal FROM customer")
def sqlite_customer(spark, sf):
    """Tasks write database shards; the source splits every shard by row id."""
    path = scratch_path(spark, "sqlite")
    write_sqlite(read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
                 path, "customer table")
    return read_sqlite(spark, path, source_table="customer table")


@query("import_sqlite_query", "SELECT c_custkey + 1 AS id, c_name FROM customer WHERE c_acctbal > 1500.5")
def sqlite_query(spark, sf):
    path = scratch_path(spark, "sqlite")
    write_sqlite(read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path, "c")
    return read_sqlite(spark, path, sql="SELECT c_custkey + 1 AS id, c_name FROM c WHERE c_acctbal > ?", params=(1500.5,))


@query("import_arrow", "SELECT * FROM lineitem")
def arrow_lineitem(spark, sf):
    path = scratch_path(spark, "arrow")
    write_arrow(read(spark, sf, "lineitem"), path)
    return read_arrow(spark, path)
