import datetime as dt
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from karst import functions as K
from karst.functions.text import fold, porter_stem
from karst.operators.layouts import text_postings
from karst.plans.indexes import IndexExists, IndexNotFound
from karst.plans.store import StaleDataset, TableExists, TableNotFound
from karst.schema import SchemaMismatch, make_schema, make_vector_schema, vector_dims
from karst.streaming import append_stream


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_create_open_list_drop(db):
    table = db.create_table("b", {"id": [1, 2], "v": [1.5, None]})
    assert ids(db.open_table("b").to_df()) == [1, 2] and table.version == 1
    db.create_table("a", [{"id": 1}])
    db.create_table("c", pd.DataFrame({"id": [1, 2]}))
    assert db.table_names() == ["a", "b", "c"]
    assert db.table_names(limit=2) == ["a", "b"] and db.table_names(start_after="b") == ["c"]
    with pytest.raises(TableExists):
        db.create_table("a", {"id": [1]})
    with pytest.raises(TableNotFound):
        db.open_table("zzz")
    for bad in ("", "_x", "a/b", "a\0b"):
        with pytest.raises(ValueError):
            db.create_table(bad, {"id": [1]})
    with pytest.raises(ValueError):
        db.table_names(limit=-1)
    db.rename_table("a", "z")
    assert db.table_names() == ["b", "c", "z"]
    with pytest.raises(TableExists):
        db.rename_table("b", "c")
    db.drop_table("z")
    db.create_namespace("ns")
    db.create_table("inner", {"id": [1]}, namespace="ns")
    assert db.list_namespaces() == ["ns"] and db.table_names(namespace="ns") == ["inner"]
    with pytest.raises(ValueError):
        db.drop_namespace("ns")
    db.drop_all_tables("ns")
    db.drop_namespace("ns")
    db.drop_all_tables()
    assert db.table_names() == [] and db.list_namespaces() == []


def test_types_round_trip(db, spark):
    schema = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("b", T.ByteType()), T.StructField("s", T.ShortType()),
        T.StructField("flag", T.BooleanType()), T.StructField("text", T.StringType()), T.StructField("raw", T.BinaryType()),
        T.StructField("day", T.DateType()), T.StructField("at", T.TimestampNTZType()),
        T.StructField("tags", T.ArrayType(T.IntegerType())),
        T.StructField("info", T.StructType([T.StructField("score", T.IntegerType()), T.StructField("label", T.StringType())])),
        T.StructField("parts", T.ArrayType(T.StructType([T.StructField("start", T.LongType())])))])
    rows = [(1, -128, 7, True, "né", bytearray(b"\x00\xff"), dt.date(1960, 1, 1), dt.datetime(2026, 9, 27, 12, 30, 0, 123000),
             [1, None], (1, "x"), [(1,), (2,)]),
            (2, None, None, None, None, bytearray(b""), None, None, [], None, []), (3,) + (None,) * 10]
    frame = spark.createDataFrame(rows, schema)
    table = db.create_table("types", frame)
    assert sorted(table.to_df().collect()) == sorted(frame.collect())
    assert ("info.label", "string", True, None) in [tuple(r) for r in table.describe().collect()]
    for kind in ("map<string,int>", "decimal(10,2)", "timestamp"):
        with pytest.raises(SchemaMismatch):
            db.create_table("bad", spark.createDataFrame([], f"id int, x {kind}"))
    assert db.table_names() == ["types"]


def test_failed_writes_change_nothing(db, spark):
    table = db.create_table("v", schema=make_vector_schema("id", "vec", 2))
    table.add({"id": ["x"], "vec": pa.array([[1, 0]], pa.list_(pa.float32()))})
    table.add({"id": ["n"], "vec": pa.array([None], pa.list_(pa.float32()))})
    version = table.version
    for bad in ([[1.0]], [[1.0, float("nan")]], [[]]):
        with pytest.raises(SchemaMismatch):
            table.add({"id": ["y"], "vec": pa.array(bad, pa.list_(pa.float32()))})
    for bad in ({"id": ["y"]}, {"id": ["y"], "vec": ["text"]}, {"id": ["y"], "vec": [[1.0, 2.0]], "more": [1]}):
        with pytest.raises(SchemaMismatch):
            table.add(bad)
    with pytest.raises(Exception):
        table.add(spark.range(1).select(F.expr("raise_error('no')").cast("string").alias("id"),
                                        F.array(F.lit(1.0), F.lit(2.0)).alias("vec")))
    assert table.version == version and table.count_rows() == 2
    with pytest.raises(ValueError):
        db.create_table("ragged", {"id": [1, 2], "v": [1]})
    assert table.vector_search([1, 0]).limit(1).execute().first().id == "x"


def test_mutations_and_versions(db):
    table = db.create_table("t", {"id": [1, 2, 3], "score": [.1, .2, .3]})
    table.add({"id": [4, 5], "score": [.4, .5]})
    before = {s.name for s in table.commit().segments}
    assert table.delete_rows("id = 2") == 1
    after = {s.name for s in table.commit().segments}
    assert len(before & after) == 1, "the untouched segment is kept"
    assert table.delete_rows(K.col("id") >= K.lit(4)) == 2 and ids(table.to_df()) == [1, 3]
    assert table.delete_rows("id = 99") == 0
    table.merge_insert({"id": [3, 9], "score": [3.0, 9.0]}, "id")
    assert sorted(tuple(r) for r in table.to_df().collect()) == [(1, .1), (3, 3.0), (9, 9.0)]
    table.merge_insert({"id": [1, 7], "score": [0.0, 7.0]}, ["id"], condition="target.score < source.score")
    assert dict(tuple(r) for r in table.to_df().collect()) == {1: .1, 3: 3.0, 9: 9.0, 7: 7.0}
    table.merge_insert({"id": [1, 8], "score": [1.0, 8.0]}, "id", update=False)
    assert dict(tuple(r) for r in table.to_df().collect())[1] == .1 and table.count_rows() == 5
    table.merge_insert({"id": [1, 10], "score": [1.0, 10.0]}, "id", insert=False)
    assert dict(tuple(r) for r in table.to_df().collect())[1] == 1.0 and table.count_rows() == 5
    for call in (lambda: table.merge_insert({"id": [1, 1], "score": [1.0, 2.0]}, "id"),
                 lambda: table.merge_insert({"id": [1], "score": [1.0]}, [])):
        with pytest.raises(ValueError):
            call()
    history = table.list_versions().collect()
    assert [r.version for r in history] == list(range(1, table.version + 1))
    for r in history:
        exact = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=r.timestamp_seconds, milliseconds=r.timestamp_nanos // 10**6)
        assert r.timestamp == exact
    table.delete_rows("true")
    assert table.count_rows() == 0 and table.to_df().columns == ["id", "score"]


def test_metadata(db):
    table = db.create_table("m", {"id": [1]})
    table.set_metadata({"author": "né", "unit": "m"})
    assert table.get_metadata(["author", "absent"]) == {"author": "né"} and table.get_metadata([]) == {}
    table.delete_metadata(["unit", "absent"]).add({"id": [2]})
    assert table.get_metadata() == {"author": "né"}
    with pytest.raises(ValueError):
        table.set_metadata({"a\0": "x"})


def test_queries(db):
    table = db.create_table("q", {"id": [1, 2, 3, 4], "score": [10, 20, 30, 40]})
    q = table.query().filter_expr(K.col("score") >= K.lit(20)).select_cols("id").order_key("id")
    assert [r.id for r in q.limit(2).execute().collect()] == [2, 3]
    assert [r.id for r in q.offset(2).execute().collect()] == [4]
    both = table.query().filter_where("id = 1").filter_expr(K.col("id") == K.lit(2)).execute()
    assert ids(both) == [2]
    assert "Scan parquet" in q.explain() or "FileScan" in q.explain()
    assert "Parsed Logical Plan" in q.explain(verbose=True)
    for call in (lambda: table.query().limit(-1), lambda: table.query().offset(-1),
                 lambda: table.query().select_cols("zzz").execute(), lambda: table.query().select_cols([])):
        with pytest.raises(ValueError):
            call()


def test_vector_queries(db):
    vecs = [[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]]
    table = db.create_table("v", {"id": ["a", "b", "c"], "vector": pa.array(vecs, pa.list_(pa.float32()))})
    assert vector_dims(table.schema) == {"vector": 3}
    q = table.vector_search([1, 0, 0]).tie_break("id")
    assert [r.id for r in q.limit(2).execute().collect()] == ["a", "b"]
    assert [r.id for r in q.filter_where("id <> 'a'").limit(3).execute().collect()] == ["b", "c"]
    assert q.filter_where("id = 'c'").prefilter(False).limit(1).execute().count() == 0
    assert q.distance_type("cosine").nprobes(3).refine_factor(2).ef(10).limit(1).execute().first()._distance == 0
    assert q.select_cols("id").limit(1).execute().columns == ["id", "_distance"]
    assert table.embedding_search("x", lambda v: [[0, 0, 1.0]], "vector").limit(1).execute().first().id == "c"
    assert "TakeOrderedAndProject" in q.limit(1).explain(True)
    assert [r.id for r in table.nearest_to([0, 1, 0], 1).collect()] == ["b"]
    for call in (lambda: q.execute(), lambda: q.nprobes(0), lambda: q.limit(-1), lambda: table.vector_search([]),
                 lambda: table.vector_search([1, 0]).limit(1).execute(), lambda: table.vector_search([1, 0, 0], "id")):
        with pytest.raises(ValueError):
            call()


def test_dataset_is_pinned_to_its_version(db):
    table = db.create_table("d", {"id": [10, 30, 50, 90], "label": list("abcd")})
    table.create_scalar_index("id")
    assert [r.label for r in table.take_ids([90, 10, 90]).collect()] == ["d", "a", "d"]
    ds = table.dataset(columns=["id", "label"])
    assert len(ds) == 4 and ds[2].label == "b"
    assert [r.id for r in ds.rows([4, 1]).collect()] == [90, 10]
    assert ds.batches(3).count() == 4 and ds.batches(3, drop_last=True).count() == 3
    assert ds.batches(2, shuffle=True, seed=1).count() == 4
    assert ds.sample(2).count() == 2 and ds.sample(9, replace=True).count() == 9
    subset = table.dataset(ids=[50, 10])
    assert [r.label for r in subset.rows([1, 2]).collect()] == ["c", "a"]
    assert sorted(r.id for r in subset.batches(1, shuffle=True, seed=3).collect()) == [10, 50]
    table.add({"id": [200], "label": ["e"]})
    for call in (lambda: ds[1], lambda: ds.batches(2), lambda: ds.sample(1), lambda: ds.rows([1])):
        with pytest.raises(StaleDataset):
            call()
    assert [r.label for r in table.take_ids([200, 10]).collect()] == ["e", "a"], "rows not indexed yet are found"


def test_compact_prune_and_old_readers(db, spark):
    table = db.create_table("c", {"id": list(range(20))})
    for i in range(3):
        table.add({"id": [100 + i]})
    assert len(table.commit().segments) == 4
    table.optimize("compact")
    assert len(table.commit().segments) == 1 and table.count_rows() == 23
    version = table.version
    table.optimize("compact")
    assert table.version == version, "nothing left to compact"
    assert len(table.log.versions()) > 1
    table.optimize("prune")
    assert table.log.versions() == [version] and table.to_df().count() == 23
    table.optimize()
    with pytest.raises(ValueError):
        table.optimize("other")


def test_sinks_and_partitions(db, spark):
    frame = spark.range(3)
    frame.transform(db.sink("s")).transform(db.sink("s"))
    table = db.open_table("s")
    assert table.count_rows() == 6
    with pytest.raises(SchemaMismatch):
        table.append_partitions([spark.range(1), spark.range(1).withColumnRenamed("id", "x")])
    assert table.count_rows() == 7


def test_stream_appends_once(db, spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(40).repartition(4).write.parquet(source)
    table = db.create_table("s", schema=make_schema([("id", "bigint")]))
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
    checkpoint = str(tmp_path / "cp")
    append_stream(stream, table, "w", checkpoint).awaitTermination()
    assert ids(table.to_df()) == list(range(40)) and table.version == 5
    again = append_stream(stream, table, "w", checkpoint)
    again.awaitTermination()
    # the same batch delivered again, as after a lost driver
    table.add(spark.range(5), token=(f"w:{again.id}", 3))
    assert table.count_rows() == 40
    table.add(spark.range(5), token=(f"w:{again.id}", 4))
    assert table.count_rows() == 45


def test_streams_of_one_writer_lose_nothing(db, spark, tmp_path):
    table = db.create_table("s", schema=make_schema([("id", "bigint")]))
    source = str(tmp_path / "in")
    for part in range(2):  # the default checkpoint goes on where it ended
        spark.range(20 * part, 20 * part + 20).coalesce(1).write.mode("append").parquet(source)
        append_stream(spark.readStream.schema("id bigint").parquet(source), table, "w").awaitTermination()
    assert ids(table.to_df()) == list(range(40))
    # another stream under the same name begins with batch 0 again
    other = str(tmp_path / "other")
    spark.range(40, 60).coalesce(1).write.parquet(other)
    append_stream(spark.readStream.schema("id bigint").parquet(other), table, "w", str(tmp_path / "cp")).awaitTermination()
    assert ids(table.to_df()) == list(range(60))


def test_vector_index_lifecycle(db, spark):
    rows = [(i, [float(i % 17), float(i % 5), float(i % 3), 1.0]) for i in range(300)]
    frame = spark.createDataFrame(rows, "id int, vec array<float>")
    table = db.create_table("v", frame)
    assert table.create_vector_index("vec") == "vec_idx" and table.index_stats("vec_idx").num_indexed_rows == 300
    assert table.create_vector_index("vec", "ivf_flat", num_partitions=4, replace=True) == "vec_idx"
    with pytest.raises(IndexExists):
        table.create_vector_index("vec", "IVFFlat")
    stats = table.index_stats("vec_idx")
    assert (stats.num_indexed_rows, stats.num_unindexed_rows, stats.num_indices) == (300, 0, 1)
    table.add(spark.createDataFrame([(1000, [99.0, 0.0, 0.0, 1.0])], frame.schema))
    assert table.index_stats("vec_idx").num_unindexed_rows == 1
    q = table.vector_search([99, 0, 0, 1], "vec").tie_break("id")
    assert q.nprobes(1).limit(1).execute().first().id == 1000, "rows not indexed yet are searched"
    table.optimize("index")
    stats = table.index_stats("vec_idx")
    assert (stats.num_indexed_rows, stats.num_unindexed_rows, stats.num_indices) == (301, 0, 2)
    exact = [r.id for r in q.flat().limit(20).execute().collect()]
    assert [r.id for r in q.nprobes(4).limit(20).execute().collect()] == exact
    table.delete_rows("id = 1000")
    assert 1000 not in [r.id for r in q.nprobes(4).limit(5).execute().collect()], "deleted rows are not found"
    table.delete_rows("id < 10")
    assert table.index_stats("vec_idx").num_unindexed_rows == 290
    table.optimize("index")
    exact = [r.id for r in q.flat().limit(20).execute().collect()]
    assert [r.id for r in q.nprobes(4).limit(20).execute().collect()] == exact
    assert q.nprobes(4).offset(5).limit(5).execute().count() == 5
    table.create_vector_index("vec", "ivf_pq", num_partitions=2, num_sub_vectors=2, replace=True)
    found = q.nprobes(2).refine_factor(40).limit(10).execute().collect()
    assert [r.id for r in found] == exact[:10]
    assert q.distance_type("cosine").limit(1).execute().count() == 1, "another metric scans the table"
    table.create_vector_index("vec", "IVFHNSWsq", replace=True)
    assert table.vector_search([1, 1, 1, 1], "vec").refine_factor(3).limit(5).execute().count() == 5
    assert table.list_indices() == ["vec_idx"]
    table.drop_index("vec_idx")
    assert table.list_indices() == []
    for call in (lambda: table.drop_index("vec_idx"), lambda: table.index_stats("ghost_idx")):
        with pytest.raises(IndexNotFound):
            call()
    with pytest.raises(ValueError):
        table.create_vector_index("vec", "tree")


def test_indexes_of_an_emptied_table(db):
    table = db.create_table("gone", {"id": [1, 2, 3], "kind": ["a", "b", "a"], "tags": [[1], [2], [1, 2]],
                                     "vec": pa.array([[0.0, 1.0], [1.0, 0.0], [1.0, 1.0]], pa.list_(pa.float32()))})
    table.create_vector_index("vec")
    table.create_scalar_index("id")
    table.create_scalar_index("kind", "bitmap")
    table.create_scalar_index("tags", "labellist", key="id")
    table.delete_rows("true")
    for _ in range(2):
        table.optimize()
        assert table.vector_search([0.0, 1.0], "vec").limit(2).execute().count() == 0
        assert table.query().use_index("id_idx").filter_where("id > 0").execute().isEmpty()
        assert table.query().use_index("kind_idx").filter_where("kind = 'a'").execute().isEmpty()
        assert table.indexes.rows_with_labels("tags_idx", [1]).isEmpty()
    table.add({"id": [9], "kind": ["a"], "tags": [[1]], "vec": pa.array([[2.0, 0.0]], pa.list_(pa.float32()))})
    table.optimize()
    assert table.query().use_index("kind_idx").filter_where("kind = 'a'").execute().first().id == 9
    assert table.vector_search([0.0, 1.0], "vec").limit(2).execute().first().id == 9


def test_value_layout_of_many_values(spark, tmp_path):
    from karst.operators import layouts as L
    frame = spark.range(6000).selectExpr("id", "concat('v', id % 5000) AS kind", "id * 0.5 AS x")
    path = "file:" + str(tmp_path / "values")
    L.write_value_layout(frame, "kind", path)
    assert sorted(r.id for r in spark.read.parquet(path).filter("kind = 'v17'").collect()) == [17, 5017]


def test_scalar_and_text_indexes(db, spark):
    texts = ["apple banana", "cherry The date", "élan fig", "grape runs running", "kiwi lemon"]
    frame = spark.createDataFrame([(i, t, t.split(" "), "x" if i % 2 else "y") for i, t in enumerate(texts)],
                                  "id int, text string, words array<string>, kind string")
    table = db.create_table("t", frame)
    assert table.create_scalar_index("id") == "id_idx"
    assert table.create_scalar_index("kind", "Bitmap") == "kind_idx"
    assert table.create_scalar_index("words", "LabelList", key="id") == "words_idx"
    assert table.create_scalar_index(["kind", "id"]) == "kind_id_idx"
    assert table.create_fts_index("text", key="id", stem=True, ascii_folding=True, remove_stop_words=True) == "text_idx"
    assert table.list_indices() == ["id_idx", "kind_id_idx", "kind_idx", "text_idx", "words_idx"]
    table.add(spark.createDataFrame([(50, "kiwi", ["kiwi"], "y")], frame.schema))
    assert ids(table.query().use_index("id_idx").filter_where("id > 2").execute()) == [3, 4, 50]
    assert ids(table.query().use_index("kind_idx").filter_expr(K.col("kind") == K.lit("y")).execute()) == [0, 2, 4, 50]
    assert table.query().use_index("kind_idx").execute().columns == frame.columns
    odd = [(1, "007"), (2, "7"), (3, ""), (4, None), (5, "a=b/c d"), (6, "007")]
    codes = db.create_table("codes", spark.createDataFrame(odd, "id int, code string"))
    codes.create_scalar_index("code", "bitmap")
    for predicate, wanted in (("code = '007'", [1, 6]), ("code = '7'", [2]), ("code = ''", [3]), ("code IS NULL", [4]),
                              ("code LIKE 'a%'", [5]), ("code IS NOT NULL", [1, 2, 3, 5, 6]), ("id > 3", [4, 5, 6])):
        got = codes.query().use_index("code_idx").filter_where(predicate).execute()
        assert ids(got) == wanted and all(tuple(r) in odd for r in got.collect())
    assert sorted(map(str, codes.query().use_index("code_idx").execute().collect())) == sorted(map(str, codes.to_df().collect()))
    plan = table.query().use_index("kind_idx").filter_where("kind = 'y'").explain(True)
    assert "PartitionFilters: [isnotnull(_part" in plan
    assert ids(table.indexes.rows_with_labels("words_idx", ["kiwi"])) == [4, 50]
    assert ids(table.indexes.rows_with_labels("words_idx", ["kiwi", "lemon"], "all")) == [4]
    terms = {(r.term, r.id): r.tf for r in table.indexes.postings("text_idx").collect()}
    assert terms[("run", 3)] == 2 and ("elan", 2) in terms and not any(t == "the" for t, _ in terms)
    table.optimize("index")
    assert table.index_stats("text_idx").num_unindexed_rows == 0
    assert ("kiwi", 50) in {(r.term, r.id) for r in table.indexes.postings("text_idx").collect()}
    with pytest.raises(IndexExists):
        table.create_fts_index("text", key="id")
    table.create_fts_index("text", key="id", replace=True)
    for call in (lambda: table.create_fts_index([]), lambda: table.create_fts_index(["text", "text"]),
                 lambda: table.create_fts_index([""]), lambda: table.create_fts_index("text", max_token_length=-2),
                 lambda: table.create_fts_index("text", max_token_length=1 << 31), lambda: table.create_fts_index("text", language="xx"),
                 lambda: table.create_fts_index("text", language="French", stem=True),
                 lambda: table.create_scalar_index("absent"), lambda: table.create_scalar_index(["id", "kind"], "bitmap"),
                 lambda: table.create_scalar_index("id", "hash"), lambda: table.create_scalar_index("id", "labellist"),
                 lambda: table.create_scalar_index("words", "bitmap", replace=True)):
        with pytest.raises(ValueError):
            call()


def test_postings_counted_in_rows(spark):
    """Unique keys need no shuffle; repeated and missing keys are summed; texts longer than a step of the kernel count whole."""
    long = "running Élan ran " * 400_000
    rows = [(1, "Runs run RUN élan"), (2, None), (3, ""), (4, long), (5, "élan elan ÉLAN x"), (6, "...")]
    frame = spark.createDataFrame(rows, "id bigint, text string")

    def plain(rows):
        counts = Counter()
        for key, text in rows:
            for token in re.findall(r"[^\W_]+", (text or "").lower()):
                counts[porter_stem(fold(token)), key] += 1
        return counts

    got = text_postings(frame, "text", "id", stem=True, ascii_folding=True)
    assert "Exchange" not in got._jdf.queryExecution().toString()
    assert got.columns == ["field", "term", "id", "tf"] and got.schema["tf"].dataType.typeName() == "long"
    assert {(r.term, r.id): r.tf for r in got.collect()} == plain(rows) and got.count() == len(plain(rows))
    more = rows + [(1, "run"), (None, "runs x"), (None, "x")]
    got = text_postings(spark.createDataFrame(more, frame.schema), "text", "id", stem=True, ascii_folding=True)
    assert {(r.term, r.id): r.tf for r in got.collect()} == plain(more) and got.count() == len(plain(more))


def test_text_options(spark):
    df = spark.createDataFrame([(1, "Running runs a LONGTOKEN", "extra"), (2, "the the", None)], "id int, text string, more string")

    def terms(**options):
        return {(r.field, r.term, r.id): r.tf for r in text_postings(df, options.pop("columns", "text"), "id", **options).collect()}
    assert terms()[("text", "the", 2)] == 2
    assert ("text", "longtoken", 1) not in terms(max_token_length=8)
    assert ("text", "LONGTOKEN", 1) in terms(lowercase=False)
    assert set(terms(remove_stop_words=True)) == {("text", t, 1) for t in ("running", "runs", "longtoken")}
    assert terms(stem=True)[("text", "run", 1)] == 2
    assert ("more", "extra", 1) in terms(columns=["text", "more"])
    assert ("text", "the the", 2) in terms(tokenizer="raw")
