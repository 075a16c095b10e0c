"""Scans, projections, paging, predicates and scalar functions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from karst import functions as K
from karst.operators.scan import page, select_cols, where
from karst.workload.registry import query, read

_ITEM = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"


@query("scan_full", "SELECT * FROM lineitem")
def scan_full(spark, sf):
    return read(spark, sf, "lineitem")


@query("select_cols", "SELECT l_orderkey, l_shipdate, l_quantity FROM lineitem")
def select_columns(spark, sf):
    return select_cols(read(spark, sf, "lineitem"), "l_orderkey", "l_shipdate", "l_quantity")


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def limit_rows(spark, sf):
    return page(select_cols(read(spark, sf, "orders"), "o_orderkey", "o_totalprice"), 50, key=["o_totalprice", "o_orderkey"])


@query("limit_large", "SELECT CAST(greatest(least(count(*) - 5000, 40000), 0) AS BIGINT) AS kept, CAST(0 AS BIGINT) AS not_stored FROM lineitem")
def limit_large(spark, sf):
    stored = select_cols(read(spark, sf, "lineitem"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    rows = page(stored, 40_000, 5_000)
    known = stored.distinct().withColumn("known", F.lit(True))
    return rows.join(known, stored.columns, "left").agg(F.count("*").alias("kept"), F.count_if(F.col("known").isNull()).alias("not_stored"))


@query("page_2", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 100")
def page_2(spark, sf):
    return page(select_cols(read(spark, sf, "orders"), "o_orderkey", "o_custkey"), 100, 100, "o_orderkey")


@query("page_deep", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem "
                    "ORDER BY 1, 2, 3, 4 LIMIT 120000 OFFSET 30000")
def page_deep(spark, sf):
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return page(select_cols(read(spark, sf, "lineitem"), *key), 120_000, 30_000, key)


@query("filter_where", f"SELECT {_ITEM} FROM lineitem WHERE l_quantity >= 40 AND l_shipdate < TIMESTAMP '1997-01-01' "
                       "AND l_returnflag = 'R'")
def filter_where(spark, sf):
    rows = where(read(spark, sf, "lineitem"),
                 "l_quantity >= 40 AND l_shipdate < TIMESTAMP_NTZ '1997-01-01' AND l_returnflag = 'R'")
    return select_cols(rows, _ITEM.split(", "))


@query("filter_expr", f"SELECT {_ITEM} FROM lineitem WHERE l_discount > 0.05 AND l_returnflag <> 'N'")
def filter_expr(spark, sf):
    rows = where(read(spark, sf, "lineitem"), (K.col("l_discount") > K.lit(0.05)) & (K.col("l_returnflag") != K.lit("N")))
    return select_cols(rows, _ITEM.split(", "))


# a float32 literal keeps its own value when widened; a double literal stays a double
@query("float_literal", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE CAST(l_discount AS FLOAT) > CAST(CAST(0.05 AS FLOAT) AS DOUBLE) AND CAST(l_tax AS FLOAT) >= CAST(0.05 AS DOUBLE)""")
def float_literal(spark, sf):
    rows = read(spark, sf, "lineitem").withColumns(
        {"d": F.col("l_discount").cast("float"), "t": F.col("l_tax").cast("float")})
    rows = where(rows, (K.col("d") > K.lit(np.float32(0.05))) & (K.col("t") >= K.lit(0.05)))
    return select_cols(rows, "l_orderkey", "l_linenumber", "l_discount")


def _item_query(name: str, predicate, sql: str):
    @query(name, f"SELECT {_ITEM} FROM lineitem WHERE {sql}")
    def run(spark, sf):
        lineitem = read(spark, sf, "lineitem")
        built = predicate(lineitem) if callable(predicate) else predicate
        return select_cols(where(lineitem, built), _ITEM.split(", "))
    return run


_item_query("cmp_eq", lambda d: K.col("l_quantity") == K.lit(25), "l_quantity = 25")
_item_query("cmp_ne", lambda d: K.col("l_returnflag") != K.lit("N"), "l_returnflag <> 'N'")
_item_query("cmp_lt", lambda d: K.col("l_quantity") < K.lit(10), "l_quantity < 10")
_item_query("cmp_le", lambda d: K.col("l_quantity") <= K.lit(10), "l_quantity <= 10")
_item_query("cmp_gt", lambda d: K.col("l_extendedprice") > K.lit(50000.0), "l_extendedprice > 50000.0")
_item_query("cmp_ge", lambda d: K.col("l_linenumber") >= K.lit(5), "l_linenumber >= 5")
_item_query("bool_and", lambda d: (K.col("l_quantity") > K.lit(30)) & (K.col("l_linestatus") == K.lit("F")),
            "l_quantity > 30 AND l_linestatus = 'F'")
_item_query("bool_or", lambda d: (K.col("l_quantity") > K.lit(45)) | (K.col("l_returnflag") == K.lit("R")),
            "l_quantity > 45 OR l_returnflag = 'R'")
_item_query("bool_not", lambda d: ~(K.col("l_returnflag") == K.lit("A")), "NOT (l_returnflag = 'A')")
_item_query("bool_compound",
            lambda d: (K.col("l_discount") > K.lit(0.04))
            & ((K.col("l_returnflag") == K.lit("A")) | (K.col("l_returnflag") == K.lit("R"))),
            "l_discount > 0.04 AND (l_returnflag = 'A' OR l_returnflag = 'R')")
_item_query("arith_add", lambda d: K.col("l_quantity") + K.lit(10) > K.lit(50), "l_quantity + 10 > 50")
_item_query("arith_sub", lambda d: K.col("l_extendedprice") - K.lit(1000.0) < K.lit(20000.0),
            "l_extendedprice - 1000.0 < 20000.0")
_item_query("arith_mul", lambda d: K.col("l_quantity") * K.lit(2.0) > K.lit(80.0), "l_quantity * 2.0 > 80.0")
_item_query("arith_div", lambda d: (K.divide(K.col("l_partkey"), K.lit(7), d) == K.lit(20))
            | (K.divide(K.col("l_quantity"), K.lit(4), d) > K.lit(12.0)),
            "l_partkey // 7 = 20 OR l_quantity / 4 > 12.0")
_item_query("expr_div_plain", lambda d: (K.col("l_partkey") / K.lit(7) == K.lit(20)) | (100 / (K.col("l_suppkey") + 1) * K.lit(2) == K.lit(32))
            | ~(K.col("l_quantity") / K.lit(4) <= K.lit(12.0)),
            "l_partkey // 7 = 20 OR 100 // (l_suppkey + 1) * 2 = 32 OR l_quantity / 4 > 12.0")
_item_query("arith_mod", lambda d: K.col("l_suppkey") % K.lit(7) == K.lit(3), "l_suppkey % 7 = 3")
_item_query("scalar_left", lambda d: K.lit(40) < K.col("l_quantity"), "40 < l_quantity")
_item_query("in_list", lambda d: K.isin(K.col("l_linenumber"), 1, 3, 5), "l_linenumber IN (1, 3, 5)")
_item_query("not_in_list", lambda d: K.notiin(K.col("l_returnflag"), "A", "R"), "l_returnflag NOT IN ('A', 'R')")

_NULLABLE = "SELECT event_id, nullif(event_type, 'click') AS kind, value FROM events"


def _with_nulls(spark, sf):
    return read(spark, sf, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("click")).alias("kind"), "value")


@query("is_null", f"SELECT * FROM ({_NULLABLE}) WHERE kind IS NULL")
def is_null(spark, sf):
    return where(_with_nulls(spark, sf), K.isnull(K.col("kind")))


@query("is_not_null", f"SELECT * FROM ({_NULLABLE}) WHERE kind IS NOT NULL")
def is_not_null(spark, sf):
    return where(_with_nulls(spark, sf), K.isnotnull(K.col("kind")))


@query("not_in_list_nulls", f"SELECT * FROM ({_NULLABLE}) WHERE kind NOT IN ('view', 'error')")
def not_in_list_nulls(spark, sf):
    return where(_with_nulls(spark, sf), K.notiin(K.col("kind"), "view", "error"))


# ------------------------------------------------------------ arrays and JSON

@query("array_has", """
SELECT doc_id, lang, coalesce(list_contains(string_split(lower(text), ' '), lang), false) AS has_lang,
       coalesce(list_contains(string_split(lower(text), ' '), 'the'), false) AS has_the FROM documents""")
def array_has(spark, sf):
    words = F.split(F.lower("text"), " ")
    return read(spark, sf, "documents").select(
        "doc_id", "lang", F.coalesce(K.array_has(words, F.col("lang")), F.lit(False)).alias("has_lang"),
        F.coalesce(K.array_has(words, "the"), F.lit(False)).alias("has_the"))


@query("json_get_int", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events "
                       "WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50")
def json_get_int(spark, sf):
    k = K.json_get_int(K.col("props"), "k")
    return where(read(spark, sf, "events"), k > K.lit(50)).select("event_id", k.alias("k"))


@query("json_get_float", "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events "
                         "WHERE CAST(json_extract(props, '$.k') AS DOUBLE) <= 25.5")
def json_get_float(spark, sf):
    k = K.json_get_float(K.col("props"), "k")
    return where(read(spark, sf, "events"), k <= K.lit(25.5)).select("event_id", k.alias("k"))


# documents built from the event columns: strings, booleans, numbers, arrays and a nested object
_DOC_SQL = """(SELECT event_id, json_object('name', event_type, 'flag', value > 10, 'value', value,
  'xs', [event_type, CAST(user_id AS VARCHAR)], 'ns', [user_id, event_id],
  'in', json_object('a b', event_type, 'opt', CASE WHEN value > 20 THEN value END)) AS doc FROM events)"""


def _docs(spark, sf):
    inner = F.struct(F.col("event_type").alias("a b"),
                     F.when(F.col("value") > 20, F.col("value")).alias("opt"))
    return read(spark, sf, "events").select("event_id", F.to_json(F.struct(
        F.col("event_type").alias("name"), (F.col("value") > 10).alias("flag"), "value",
        F.array(F.col("event_type"), F.col("user_id").cast("string")).alias("xs"),
        F.array("user_id", "event_id").alias("ns"), inner.alias("in")), {"ignoreNullFields": "false"}).alias("doc"))


@query("json_get_str", f"""SELECT event_id, json_extract_string(doc, '$.name') AS name,
       json_extract_string(doc, '$.in."a b"') AS nested,
       CASE WHEN json_type(doc, '$.value') = 'VARCHAR' THEN 'x' END AS not_text FROM {_DOC_SQL}""")
def json_get_str(spark, sf):
    doc = K.col("doc")
    return _docs(spark, sf).select("event_id", K.json_get_str(doc, "name").alias("name"),
                                   K.json_get_str(doc, "in", "a b").alias("nested"),
                                   K.json_get_str(doc, "value").alias("not_text"))


@query("json_get_bool", f"SELECT event_id, CAST(json_extract(doc, '$.flag') AS BOOLEAN) AS flag FROM {_DOC_SQL} "
                        "WHERE CAST(json_extract(doc, '$.flag') AS BOOLEAN)")
def json_get_bool(spark, sf):
    flag = K.json_get_bool(K.col("doc"), "flag")
    return where(_docs(spark, sf), flag == K.lit(True)).select("event_id", flag.alias("flag"))


@query("json_contains", f"""SELECT event_id, json_exists(doc, '$.in.opt') AS has_opt,
       json_exists(doc, '$.name') AS has_name, json_exists(doc, '$.missing') AS has_missing FROM {_DOC_SQL}""")
def json_contains(spark, sf):
    doc = K.col("doc")
    return _docs(spark, sf).select("event_id", K.json_contains(doc, "in", "opt").alias("has_opt"),
                                   K.json_contains(doc, "name").alias("has_name"),
                                   K.json_contains(doc, ["missing"]).alias("has_missing"))


@query("json_array_has", f"""SELECT event_id,
       list_contains(CAST(json_extract(doc, '$.xs') AS VARCHAR[]), 'click') AS has_click,
       list_contains(CAST(json_extract(doc, '$.ns') AS BIGINT[]), 7) AS has_seven FROM {_DOC_SQL}""")
def json_array_has(spark, sf):
    doc = K.col("doc")
    return _docs(spark, sf).select("event_id", K.json_array_has(doc, ["xs"], "click").alias("has_click"),
                                   K.json_array_has(doc, ["ns"], 7, quote_value=False).alias("has_seven"))
