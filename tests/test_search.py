import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from karst import functions as K
from karst.functions import kernels
from karst.operators import cells as C
from karst.operators.embed import encode_batch, embedding_search, with_embeddings
from karst.operators.search import knn, knn_join, vector_column
from karst.schema import vector_dims
from karst.session import scratch_path


@pytest.fixture(scope="module")
def basis(spark):
    return spark.createDataFrame([(n, [1.0 if i == j else 0.0 for j in range(4)]) for i, n in enumerate("abcd")],
                                 "id string, vec array<float>")


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 16)) * 4
    points = (centres[rng.integers(0, 12, 1200)] + rng.normal(size=(1200, 16))).astype(np.float32)
    points[600:800] = points[600]          # many copies of one vector
    rows = [(i, [float(x) for x in p], int(i % 7)) for i, p in enumerate(points)]
    return points, spark.createDataFrame(rows, "id bigint, vec array<float>, label int").repartition(5).cache()


def brute(points, query, k, metric="l2", keep=lambda i: True):
    d = kernels.distances(points, np.asarray(query, np.float32), metric).astype(np.float32)
    order = sorted((float(x), i) for i, x in enumerate(d) if not np.isnan(x) and keep(i))
    return [(i, x) for x, i in order[:k]]


def test_exact_match_first(basis):
    for metric in ("l2", "cosine", "dot"):
        for engine in ("arrow", "columns"):
            out = knn(basis, [1, 0, 0, 0], 4, "vec", metric, "id", engine=engine)
            rows = out.collect()
            assert rows[0].id == "a" and rows[0]._distance == 0 and len(rows) == 4
            assert [r._distance for r in rows] == sorted(r._distance for r in rows)
            assert dict(out.dtypes)["_distance"] == "float"
    for k in range(5):
        assert knn(basis, [1, 0, 0, 0], k, "vec", key="id").count() == k


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
@pytest.mark.parametrize("engine", ["arrow", "columns"])
def test_matches_brute_force_with_ties(cloud, metric, engine):
    points, df = cloud
    for q in (600, 5):
        found = knn(df, points[q], 30, "vec", metric, "id", engine=engine, select=["id"]).collect()
        wanted = brute(points, points[q], 30, metric)
        np.testing.assert_allclose([r._distance for r in found], [d for _, d in wanted], rtol=1e-5, atol=1e-6)
        if metric == "l2":
            assert [r.id for r in found] == [i for i, _ in wanted]


def test_filters_pages_projection(cloud):
    points, df = cloud
    q = points[3]
    pre = knn(df, q, 10, "vec", key="id", where="label = 2", select=["id"]).collect()
    assert [r.id for r in pre] == [i for i, _ in brute(points, q, 10, keep=lambda i: i % 7 == 2)]
    expr = knn(df, q, 10, "vec", key="id", where=K.col("label") == K.lit(2), select=["id"]).collect()
    assert expr == pre
    post = knn(df, q, 20, "vec", key="id", where="label = 2", prefilter=False, select=["id"]).collect()
    assert [r.id for r in post] == [i for i, _ in brute(points, q, 20) if i % 7 == 2]
    later = knn(df, q, 5, "vec", key="id", offset=5, select=["id"]).collect()
    assert [r.id for r in later] == [i for i, _ in brute(points, q, 10)][5:]
    out = knn(df, q, 3, "vec", key="id", select=["label", "_distance"])
    assert out.columns == ["label", "_distance"]


def test_plan_is_a_bounded_top_k(cloud, spark, tmp_path):
    points, df = cloud
    path = "file:" + str(tmp_path / "p")
    df.write.parquet(path)
    plan = knn(spark.read.parquet(path), points[0], 5, "vec", key="id", where="label IN (1, 2)", select=["id"])
    text = plan._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in text and "In(label, [1,2])" in text and "Exchange" not in text


def test_very_large_k_is_not_gathered(cloud, monkeypatch):
    from karst.operators import numbering, search
    points, df = cloud
    wanted = brute(points, points[0], 400)
    monkeypatch.setattr(numbering, "TOP_N", 50)
    monkeypatch.setattr(search, "TOP_N", 50)
    for offset in (0, 100):
        found = knn(df, points[0], 300, "vec", key="id", select=["id"], offset=offset).collect()
        assert [r.id for r in found] == [i for i, _ in wanted[offset:offset + 300]]


def test_argument_rules(basis, spark):
    for call in (lambda: knn(basis, [1, 0], 1, "absent"), lambda: knn(basis, [], 1, "vec"),
                 lambda: knn(basis, [1e100, 0, 0, 0], 1, "vec"), lambda: knn(basis, [1, 0, 0, 0], -1, "vec"),
                 lambda: knn(basis, [1, 0, 0, 0], 1, "vec", "manhattan"), lambda: knn(basis, [1, 0, 0, 0], 1, "id"),
                 lambda: knn(basis, [1, 0, 0, 0], 1, "vec", select=["absent"]),
                 lambda: knn(basis, [1, 0, 0, 0], 1, "vec", engine="gpu")):
        with pytest.raises(ValueError):
            call()
    for engine in ("arrow", "columns"):
        with pytest.raises(Exception):
            knn(basis, [1, 0], 1, "vec", engine=engine).collect()
    two = basis.withColumn("other", F.col("vec"))
    with pytest.raises(ValueError):
        knn(two, [1, 0, 0, 0], 1)
    assert vector_column(two.withColumnRenamed("other", "vector").schema) == "vector"
    holes = basis.unionByName(spark.createDataFrame([("n", None)], basis.schema))
    assert knn(holes, [1, 0, 0, 0], 10, "vec", key="id").count() == 4


def test_hamming_on_codes_and_bytes(spark):
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (60, 8), dtype=np.uint8)
    df = spark.createDataFrame([(i, bytearray(c.tobytes()), [int(x) for x in c]) for i, c in enumerate(codes)],
                               "id int, b binary, a array<int>")
    wanted = sorted((int(np.bitwise_count(c ^ codes[9]).sum()), i) for i, c in enumerate(codes))[:7]
    for column, query in (("b", codes[9].tobytes()), ("a", [int(x) for x in codes[9]])):
        found = knn(df, query, 7, column, "hamming", "id", select=["id"]).collect()
        assert [(r._distance, r.id) for r in found] == wanted


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "query_block": 70, "vector_block": 300}])
@pytest.mark.parametrize("metric", ["l2", "dot"])
def test_knn_join_matches_brute_force(cloud, options, metric):
    points, df = cloud
    queries = df.filter("id % 6 = 0").select(F.col("id").alias("qid"), "vec")
    found = knn_join(queries, df, 4, "qid", "id", "vec", "vec", metric, **options).collect()
    got = {}
    for r in found:
        got.setdefault(r.qid, []).append((r._distance, r.id))
    assert len(got) == 200
    for q, rows in got.items():
        wanted = brute(points, points[q], 4, metric)
        if metric == "l2":
            assert [i for _, i in sorted(rows)] == [i for i, _ in wanted]
        np.testing.assert_allclose([d for d, _ in sorted(rows)], [d for _, d in wanted], rtol=1e-5, atol=1e-6)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "query_block": 100, "vector_block": 400}])
def test_knn_join_with_copies_and_ties(spark, options, monkeypatch):
    """A third of the vectors are copies, and all distances are small integers."""
    rng = np.random.default_rng(8)
    points = rng.integers(0, 2, (900, 5)).astype(np.float32)
    points[300:600] = points[300]
    df = spark.createDataFrame([(int(i), [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vec array<float>")
    df = df.repartition(4)
    found = knn_join(df.withColumnRenamed("id", "qid"), df, 6, "qid", "id", "vec", "vec", **options).collect()
    got = {}
    for r in found:
        got.setdefault(r.qid, []).append((r._distance, r.id))
    for q in range(0, 900, 37):
        assert [i for _, i in sorted(got[q])] == [i for i, _ in brute(points, points[q], 6)]
    assert len(found) == 900 * 6


def test_block_top_k_settles_ties_in_pieces(monkeypatch):
    from karst.operators import search
    monkeypatch.setattr(search, "PAIR_SLICE", 64)
    monkeypatch.setattr(search, "VECTOR_SLICE", 50)
    points = np.zeros((200, 3), np.float32)
    points[::2, 0] = np.arange(100) % 3
    block = search._BlockTopK(pa.array(range(200)), points, "l2", 4, ("q", "id"))
    block.add(pa.array(range(200)), points)
    rows = block.result().to_pylist()
    for q in (0, 1, 2, 77):
        assert [r["id"] for r in rows if r["q"] == q] == [i for i, _ in brute(points, points[q], 4)]
    ids, kept = kernels.without_surplus_copies(pa.array(range(200)), points, 4)
    assert ids.to_pylist()[:2] == [0, 1] and len(kept) == 12


def layout_of(spark, df, metric, codec=None, cells=8):
    model = C.train_cells(df, "vec", metric, cells)
    assigned = C.assign_cells(df, "vec", model)
    codes = codec(assigned, "vec", model) if codec else None
    if codes is not None:
        assigned = C.add_codes(assigned, "vec", model, codes)
    path = scratch_path(spark, "test-cells")
    C.write_cells(assigned, model, path)
    return spark.read.parquet(path), model, codes


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_ivf_probes(cloud, spark, metric):
    points, df = cloud
    layout, model, _ = layout_of(spark, df, metric)
    assert layout.count() == 1200
    q = points[42]
    exact = [i for i, _ in brute(points, q, 10, metric)]
    everything = C.ivf_search(layout, model, q, 10, "vec", None, key="id", select=["id"])
    if metric == "l2":
        assert [r.id for r in everything.collect()] == exact
    some = C.ivf_search(layout, model, q, 10, "vec", 3, key="id", select=["id"])
    assert len({r.id for r in some.collect()} & set(exact)) >= 7
    text = some._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in text or "_bucket#" in text.split("PartitionFilters")[1][:80]


@pytest.mark.parametrize("codec", [C.train_product_codes, C.train_scalar_codes])
@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_codes_have_recall(cloud, spark, codec, metric):
    points, df = cloud
    distinct = df.filter("id < 600 OR id >= 800")
    layout, model, codes = layout_of(spark, distinct, metric, codec)
    kept = lambda i: not 600 <= i < 800
    hits = 0
    for q in (1, 50, 900):
        exact = {i for i, _ in brute(points, points[q], 10, metric, kept)}
        found = C.code_search(layout, model, codes, points[q], 10, "vec", "id", nprobes=None, refine_factor=10, select=["id"])
        hits += len({r.id for r in found.collect()} & exact)
    assert hits >= 27
    plain = C.code_search(layout, model, codes, points[1], 5, "vec", "id", nprobes=None, where="label <> 0", select=["id", "label"])
    rows = plain.collect()
    assert len(rows) == 5 and all(r.label != 0 for r in rows)
    q = points[77]
    full = C.code_search(layout, model, codes, q, 10, "vec", "id", nprobes=None, refine_factor=200, select=["id"])
    if metric == "l2":
        assert [r.id for r in full.collect()] == [i for i, _ in brute(points, q, 10, metric, kept)]


def test_hot_cell_is_split(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in ([5.0, 5.0] if i % 3 else rng.normal(size=2) * 20)]) for i in range(900)]
    df = spark.createDataFrame(rows, "id bigint, vec array<float>")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout, model, _ = layout_of(spark, df, "l2", cells=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert max(model.shares) > 0.5
    hot = layout.filter(F.col("_cell") == int(np.argmax(model.shares)))
    assert hot.select(F.col("_metadata.file_path")).distinct().count() > 1
    assert layout.count() == 900


def test_cell_rules(cloud, spark):
    _, df = cloud
    assert C.cell_count(10**6, 64, 200_000) == 200_000 and C.cell_count(50, 64, 200_000) == 50
    with pytest.raises(ValueError):
        C.cell_count(10**6, 1536, 40_000)
    assert C.cell_count(10_000, 64) == 100 and C.cell_count(10_000, 64, 7) == 7
    assert C.cell_count(10**12, 1536) * 1536 * 4 <= C.MAX_CENTRE_BYTES
    for call in (lambda: C.train_cells(df, "vec", "hamming"), lambda: C.train_cells(df, "vec", num_partitions=0),
                 lambda: C.train_cells(df, "vec", sample_rate=2.0), lambda: C.train_cells(df.limit(0), "vec"),
                 lambda: C.sub_vector_count(16, 5)):
        with pytest.raises(ValueError):
            call()


def test_embeddings(spark):
    def length_encoder(values):
        assert len(values) <= 3
        return [[float(len(v)), 1.0] for v in values]

    df = spark.createDataFrame([(i, "x" * i) for i in range(1, 12)], "id int, text string").repartition(2)
    out = with_embeddings(df, "text", length_encoder, batchsize=3)
    assert vector_dims(out.schema) == {"embedding": 2}
    assert {r.id: r.embedding[0] for r in out.collect()} == {i: float(i) for i in range(1, 12)}
    near = embedding_search(out, "xxxx", length_encoder, 1, key="id")
    assert near.first().id == 4
    matrix = with_embeddings(df, "text", lambda v: np.array([[len(x), 2, 3] for x in v]), column="m", batchsize=4)
    assert vector_dims(matrix.schema) == {"m": 3}
    again = with_embeddings(out, "text", length_encoder, batchsize=2, overwrite=True)
    assert again.columns.count("embedding") == 1

    def load():
        return lambda values: [[1.0] for _ in values]
    assert with_embeddings(df, "text", load, encoder_factory=True).first().embedding == [1.0]
    for call in (lambda: with_embeddings(out, "text", length_encoder), lambda: with_embeddings(df, "absent", length_encoder),
                 lambda: with_embeddings(df.limit(0), "text", length_encoder),
                 lambda: with_embeddings(df, "text", length_encoder, batchsize=0)):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("output", [[[1.0]], [[1.0], [1.0, 2.0]], [[], []], [[1.0], [float("nan")]], [[1e100], [1.0]],
                                    "text", np.ones((3, 2)), [["a"], ["b"]]])
def test_encoder_contract(output):
    with pytest.raises(ValueError):
        encode_batch(lambda values: output, ["a", "b"])


def test_dimension_must_agree_across_tasks(spark):
    df = spark.createDataFrame([("a",), ("bb",)], "text string").repartition(2)
    with pytest.raises(Exception):
        with_embeddings(df.repartition(2, "text"), "text", lambda v: [[1.0] * len(x) for x in v], batchsize=1)


def test_kernel_matrix_rules():
    good = pa.array([[1.0, 2.0], None, [3.0, 4.0]], pa.list_(pa.float32()))
    rows, present = kernels.matrix(good, 2)
    assert rows.tolist() == [[1, 2], [3, 4]] and present.tolist() == [True, False, True]
    for bad in ([[1.0]], [[1.0, None]]):
        with pytest.raises(ValueError):
            kernels.matrix(pa.array(bad, pa.list_(pa.float32())), 2)


def test_knn_join_among_near_copies_of_long_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 48))
    centres = (centres / np.linalg.norm(centres, axis=1)[:, None] * 100).astype(np.float32)
    rows, points = [], []
    for c in centres:
        for step in range(1, 41):
            near = c.copy()
            near[step % 48] = np.nextafter(near[step % 48], np.float32(np.inf)) + np.float32(step * 8e-6)
            points.append(near)
    points = np.array(points, np.float32)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vid bigint, v array<float>")
    queries = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "qid bigint, q array<float>")
    for limit in (1 << 26, 0):
        got = {}
        for r in knn_join(queries, vectors, 5, "qid", "vid", "q", "v", broadcast_bytes=limit).collect():
            got.setdefault(r.qid, []).append((r._distance, r.vid))
        for i, c in enumerate(centres):
            exact = np.sqrt(((points.astype(np.float64) - c.astype(np.float64)) ** 2).sum(1)).astype(np.float32)
            assert sorted(got[i]) == sorted((exact[j], j) for j in np.lexsort((np.arange(len(points)), exact))[:5])


# ---------------------------------------------------------------- pivots, winners and candidates

@pytest.fixture(scope="module")
def clustered(spark):
    """Thirty tight clouds far apart."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(30, 8)) * 50
    points = (centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 8))).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vec array<float>").repartition(4)
    return points, df


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_pivots_visit_few_block_pairs(clustered, metric):
    from pyspark.sql import types as T
    from karst.operators.pivots import pivot_join
    points, df = clustered
    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField("id", T.LongType()), T.StructField("_distance", T.FloatType())])
    counts = []
    q = df.filter("id % 3 = 0").select(F.col("id").alias("qid"), F.col("vec").alias("_q"))
    rows = pivot_join(q, df.select("id", F.col("vec").alias("_v")), 4, "qid", "id", 8, metric, schema, 50, 100, report=counts).collect()
    assert counts[1] < counts[0] / 2, counts
    got = {}
    for r in rows:
        got.setdefault(r.qid, set()).add((r._distance, r.id))
    for i in range(0, 3000, 111):
        wanted = brute(points, points[i], 4, metric)
        assert [j for _, j in sorted(got[i])[:4]] == [j for j, _ in wanted]


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_pivots_with_odd_vectors(spark, metric):
    """Vectors without a direction, with holes, in copies, and more neighbours asked for than there are."""
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, 1.0]), (5, [2.0, 2.0])] + [(10 + i, [0.0, 3.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    asked = df.select(F.col("id").alias("qid"), "vec")
    options = dict(k=60, query_key="qid", vector_key="id", query_column="vec", vector_column_name="vec", metric=metric)
    plain = {(r.qid, r.id, r._distance) for r in knn_join(asked, df, **options).collect()}
    found = {(r.qid, r.id, r._distance) for r in knn_join(asked, df, **options, query_block=5, vector_block=7, broadcast_bytes=0).collect()}
    assert found == plain
    assert knn_join(asked, df.limit(0), **options, broadcast_bytes=0).count() == 0


def test_winners_only_projection(spark, tmp_path):
    """The search sees key and vector, and the second scan one of the files."""
    from karst.operators.search import read_from_files
    path = str(tmp_path / "wide")
    rows = [(i, [float(i), 0.0], "x" * 50 + str(i), {"a": i}) for i in range(400)]
    spark.createDataFrame(rows, "id bigint, vec array<float>, body string, extra map<string,int>").repartitionByRange(8, "id").write.parquet(path)
    df = spark.read.parquet(path)
    found = knn(df.filter("id <> 201"), [200.2, 0.0], 3, "vec", key="id", select=["body", "extra"], offset=1)
    assert [r.body[50:] for r in found.collect()] == ["199", "202", "198"] and found.columns == ["body", "extra", "_distance"]
    plan = found._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "file_path" in plan and "GreaterThanOrEqual(id,198)" in plan.replace(" ", "")
    assert read_from_files(df.filter("id > 3").select("id")) and not read_from_files(df.join(df.select("id"), "id"))
    assert not read_from_files(df.withColumn("r", F.rand())) and not read_from_files(df.groupBy("id").count())
    # a column that is not wide goes along at once; other sources have no places to fetch from
    assert "MapInArrow" in knn(df.drop("body", "extra"), [1.0, 0.0], 3, "vec", key="id")._jdf.queryExecution().toString()
    joined = df.join(df.select("id", F.upper("body").alias("b2")), "id")
    assert [r.b2[50:] for r in knn(joined, [200.2, 0.0], 2, "vec", key="id", select=["b2"]).collect()] == ["200", "201"]
    after = knn(df, [200.2, 0.0], 4, "vec", key="id", select=["body"], where="extra['a'] % 2 = 0", prefilter=False)
    assert [r.body[50:] for r in after.collect()] == ["200", "202"]


def test_search_columns_that_python_sees(spark, tmp_path, monkeypatch):
    from karst.operators import search
    seen = []
    whole = search.top_k_batches

    def spy(query, column, metric, k, order, keep):
        seen.append((column, keep))
        return whole(query, column, metric, k, order, keep)

    monkeypatch.setattr(search, "top_k_batches", spy)
    path = str(tmp_path / "narrow")
    spark.createDataFrame([(i, [float(i)], "b") for i in range(9)], "id int, vec array<float>, body string").write.parquet(path)
    assert [r.id for r in knn(spark.read.parquet(path), [3.0], 2, "vec", key="id").collect()] == [3, 2]
    assert seen == [("vec", ["id", search.FILE, search.LINE])]


def test_code_search_reads_candidates_only(spark, tmp_path):
    from karst.operators import cells as C
    rng = np.random.default_rng(4)
    points = rng.normal(size=(600, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vec array<float>")
    cells = C.train_cells(df, "vec", num_partitions=6)
    assigned = C.assign_cells(df, "vec", cells)
    codec = C.train_product_codes(assigned, "vec", cells, 8)
    path = str(tmp_path / "codes")
    C.write_cells(C.add_codes(assigned, "vec", cells, codec), cells, path)
    layout = spark.read.parquet(path)
    found = C.code_search(layout, cells, codec, points[7], 5, "vec", "id", nprobes=None, refine_factor=4, select=["id"])
    exact = [i for i, _ in brute(points, points[7], 5, "l2")]
    assert len({r.id for r in found.collect()} & set(exact)) >= 4
    # the scan that reads the vectors has the candidates' row numbers in its filter
    candidates = knn(layout, points[7], 20, "vec", key="id", select=["_fragment", "_row", "_bucket", "_cell"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    scan = C.candidate_rows(layout, candidates)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(_row," in scan and "LessThanOrEqual(_row," in scan and "_bucket" in scan.split("PartitionFilters")[1]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    errors = C.code_errors(layout, "vec", cells, codec).agg(F.sum("_error"), F.sum("_energy")).first()
    assert errors[0] < 0.6 * errors[1]


def test_row_ranges_close_the_smallest_gaps():
    from karst.operators.cells import row_ranges
    places = [(0, 0, r, r) for r in (1, 2, 9, 10, 40, 41, 90)] + [(1, 0, 5, 7)]
    assert row_ranges(places, 3) == [(0, 0, 1, 10), (0, 0, 40, 41), (0, 0, 90, 90), (1, 0, 5, 7)]
    assert row_ranges(places, 100)[:2] == [(0, 0, 1, 1), (0, 0, 2, 2)] and row_ranges(places, 1)[0] == (0, 0, 1, 90)


def test_product_codes_of_vectors_without_clusters(spark):
    """Books for all rows together keep less than half of what the cells leave; the candidates a recall takes are measured."""
    rng = np.random.default_rng(2)
    points = rng.normal(size=(12_000, 16)).astype(np.float32)
    df = spark.createDataFrame(pa.table({"id": pa.array(np.arange(12_000)), "vec": pa.array(list(points))}))
    layout, model, codes = layout_of(spark, df, "l2", C.train_product_codes, 40)
    assert codes.size == 1 and len(codes.books) > 3
    kept = C.code_errors(layout, "vec", model, codes).agg(F.sum("_error") / F.sum("_energy")).first()[0]
    assert kept < 0.5
    factor = C.measured_refine_factor(layout, model, codes, 10, "vec", "id")
    assert factor > 10
    hits = 0
    for q in (3, 4000, 11_999):
        found = C.code_search(layout, model, codes, points[q], 10, "vec", "id", nprobes=None, refine_factor=factor, select=["id"])
        hits += len({r.id for r in found.collect()} & {i for i, _ in brute(points, points[q], 10)})
    assert hits >= 27


def test_books_are_shared_within_their_bound():
    assert C.book_groups(np.array([1000] * 8), 99).tolist() == [0, 0, 0, 1, 1, 2, 2, 3]
    counts = np.array([0, 5000, 100, 0, 30_000, 10] * 30)
    group = C.book_groups(counts, 12)
    assert len(group) == len(counts) and (np.diff(group) >= 0).all() and group.max() < 12


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_single_precision_pairs_lose_none(metric):
    rng = np.random.default_rng(8)
    points = (rng.normal(size=(3000, 24)) * 10.0 ** rng.integers(-3, 4, 3000)[:, None]).astype(np.float32)
    points[5], points[700:900] = 0, points[699]
    queries = points[:40]
    rough = kernels.distances_many(points, queries, metric)
    edges = np.where(np.isnan(rough), np.inf, rough)
    edges = np.minimum(np.sort(edges, axis=1)[:, 9], 2.0 if metric == "cosine" else np.inf)
    line, pick = kernels.near_pairs(points, queries, metric, edges)
    found = set(zip(line.tolist(), pick.tolist()))
    for i, q in enumerate(queries):
        exact = kernels.distances(points, q, metric)
        assert {(i, int(j)) for j in np.flatnonzero(exact <= edges[i])} <= found
    assert kernels.near_pairs(points * np.float32(1e20), queries, "l2", edges) is None
    assert kernels.near_pairs(points, queries, metric, np.full(40, np.inf)) is None


def test_pivot_join_sends_rows_by_tiles(spark):
    """Blocks of 20 rows: one tile takes what would be thousands of pairs of blocks, each with its own copy of the rows."""
    rng = np.random.default_rng(4)
    points = rng.normal(size=(900, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vec array<float>")
    out = knn_join(df.withColumnRenamed("id", "qid"), df, 4, "qid", "id", "vec", "vec", query_block=20, vector_block=20, broadcast_bytes=0)
    assert "_tq" in out._jdf.queryExecution().analyzed().toString()
    found = {}
    for r in out.collect():
        found.setdefault(r.qid, set()).add(r.id)
    assert found == {i: {j for j, _ in brute(points, points[i], 4)} for i in range(900)}
