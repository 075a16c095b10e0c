"""Upserts, deletes, ordered lookups, batches and samples against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from karst import functions as K
from karst.operators.batches import batches, id_manifest, rows_at, sample_rows, transform_batches
from karst.operators import numbering
from karst.operators.bounds import fits_broadcast, left_join_unique, with_salt
from karst.operators.lookup import check_ids, stored_duplicates, take_ids
from karst.operators.mutate import DuplicateKeys, delete_rows, duplicate_keys, merge_insert
from karst.operators.numbering import number_rows
from karst.schema import SchemaMismatch


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_delete_keeps_null_predicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, tag string")
    assert pairs(delete_rows(df, "tag = 'a'")) == [(2, None), (3, "b")]
    assert pairs(delete_rows(df, K.col("tag") != K.lit("a"))) == [(1, "a"), (2, None)]
    assert delete_rows(df, "true").count() == 0


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (None, 9.0)], "id int, v double")


@pytest.fixture()
def source(spark):
    return spark.createDataFrame([(2, 20.0), (3, 30.0), (4, 40.0), (None, 90.0)], "id int, v double")


@pytest.mark.parametrize("small", [True, False, None])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_merge_variants(target, source, small, hot_rows):
    def run(**options):
        return pairs(merge_insert(target, source, "id", small=small, hot_rows=hot_rows, **options))
    assert run() == [(1, 1.0), (2, 20.0), (3, 30.0), (4, 40.0), (None, 9.0), (None, 90.0)]
    assert run(update=False) == [(1, 1.0), (2, 2.0), (3, None), (4, 40.0), (None, 9.0), (None, 90.0)]
    assert run(insert=False) == [(1, 1.0), (2, 20.0), (3, 30.0), (None, 9.0)]
    assert run(update=False, insert=False) == [(1, 1.0), (2, 2.0), (3, None), (None, 9.0)]
    # a null condition does not update, and the condition does not stop inserts
    assert run(condition="target.v < source.v") == [(1, 1.0), (2, 20.0), (3, None), (4, 40.0), (None, 9.0), (None, 90.0)]
    assert run(condition=K.col("target.v") > K.col("source.v")) == [
        (1, 1.0), (2, 2.0), (3, None), (4, 40.0), (None, 9.0), (None, 90.0)]


@pytest.fixture()
def shuffled_joins(spark):
    """Joins without automatic broadcasts or runtime re-planning."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_plans_without_broadcasts(spark, shuffled_joins, target, source):
    assert pairs(merge_insert(target, source, "id", small=False)) == [
        (1, 1.0), (2, 20.0), (3, 30.0), (4, 40.0), (None, 9.0), (None, 90.0)]
    test_merge_with_a_hot_target_key(spark, False)
    values = random.Random(4).sample(range(10_000), 300)
    df = spark.createDataFrame([(v,) for v in values], "id int")
    assert pairs(number_rows(df.repartition(5), ["id"]).select("pos", "id")) == [(i + 1, v) for i, v in enumerate(sorted(values))]
    request = spark.createDataFrame([(i, values[i % 2]) for i in range(60)], "pos bigint, id int")
    got = take_ids(df, request, keep_pos=True, hot_rows=10).collect()
    assert [tuple(r) for r in got] == [(i, values[i % 2]) for i in range(60)]


@pytest.mark.parametrize("small", [True, False])
def test_merge_with_a_hot_target_key(spark, small):
    """Half of the target shares one key and a fifth has no key; results stay whole."""
    rows = [(7 if i % 2 else None if i % 5 == 0 else i, i) for i in range(600)]
    target = spark.createDataFrame(rows, "k int, n int").repartition(3)
    source = spark.createDataFrame([(7, -1), (2, -2), (9999, -3)], "k int, n int")
    got = pairs(merge_insert(target, source, "k", small=small, hot_rows=50))
    new = {7: -1, 2: -2}
    wanted = [(k, new.get(k, n)) for k, n in rows] + [(9999, -3)]
    assert got == sorted(wanted, key=lambda t: tuple((x is None, x) for x in t))


def test_merge_composite_and_rules(spark, target, source):
    a = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0), (2, 1, 3.0)], "a int, b int, v double")
    b = spark.createDataFrame([(1, 2, 20.0), (2, 2, 40.0)], "a int, b int, v double")
    assert pairs(merge_insert(a, b, ["a", "b"])) == [(1, 1, 1.0), (1, 2, 20.0), (2, 1, 3.0), (2, 2, 40.0)]
    with pytest.raises(ValueError):
        merge_insert(target, source, [])
    with pytest.raises(SchemaMismatch):
        merge_insert(target, source, "absent")
    with pytest.raises(SchemaMismatch):
        merge_insert(target, source.withColumn("x", F.lit(1)), "id")
    with pytest.raises(DuplicateKeys):
        merge_insert(target, source.unionByName(source), "id")
    odd = spark.createDataFrame([(1, "x")], ["sample key", "v"])
    assert pairs(merge_insert(odd, spark.createDataFrame([(1, "y"), (2, "z")], ["sample key", "v"]), "sample key")) == [
        (1, "y"), (2, "z")]


def test_salting_finds_hot_keys(spark):
    df = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(90)], "k int, n int")
    salted, hot = with_salt(df, ["k"], F.col("n"), hot_rows=20)
    assert [(r.k, r._splits) for r in hot.collect()] == [(1, 4)] or hot.first().k == 1
    assert salted.filter("k = 1").select("_salt").distinct().count() > 1
    assert salted.filter("k <> 1").select("_salt").distinct().count() == 1
    right = spark.createDataFrame([(1, "one"), (3, "three")], "k int, name string")
    for small in (True, False):
        for how in ("left", "inner"):
            got = left_join_unique(df, right, ["k"], F.col("n"), how, hot_rows=20, small=small)
            assert pairs(got.select("k", "n", "name")) == pairs(df.join(right, "k", how))
    assert fits_broadcast(df) and not fits_broadcast(df, max_rows=10) and not fits_broadcast(df, max_bytes=100)


@pytest.mark.parametrize("hot_rows", [20, 1_000_000])
def test_joins_by_key_follow_the_rows(spark, monkeypatch, hot_rows):
    """The tasks of a merge grow with its rows, whatever the bytes; no task counts all keys."""
    from karst.operators import bounds
    from karst.operators.mutate import check_unique, unmatched
    target = spark.createDataFrame([(None if i % 50 == 0 else 1 if i % 4 == 0 else i, float(i)) for i in range(400)], "id int, v double")
    source = spark.createDataFrame([(i, -1.0) for i in range(1, 600, 2)], "id int, v double")
    wanted = pairs(merge_insert(target, source, "id", small=True))
    monkeypatch.setattr(bounds, "TASK_ROWS", 25)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_insert(target, source, "id", small=False, hot_rows=hot_rows)
        assert pairs(merged) == wanted
        # 400 and 300 rows meet in 28 tasks; of the 392 keys that are no null the hot one may be sent once
        assert merged.rdd.getNumPartitions() >= 28 + 24
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert pairs(unmatched(target, source, ["id"], False, hot_rows)) == pairs(unmatched(target, source, ["id"], True))
    check_unique(source, ["id"], "source")
    with pytest.raises(DuplicateKeys):
        check_unique(target, ["id"], "target")
    rows, crowded = bounds.key_load(target, ["id"], hot_rows)
    assert rows == 400 and len(crowded) == (1 if hot_rows == 20 else 0)
    assert {r.id for r in bounds.hot_keys(target, ["id"], (rows, crowded), hot_rows).collect()} == {1} if crowded else True


def test_numbers_are_dense_in_any_partitioning(spark):
    values = random.Random(4).sample(range(10_000), 700)
    df = spark.createDataFrame([(v, str(v)) for v in values], "id int, s string")
    wanted = [(i + 1, v) for i, v in enumerate(sorted(values))]
    for parts in (1, 4, 17):
        got = number_rows(df.select("id").repartition(parts), ["id"])
        assert pairs(got.select("pos", "id")) == wanted


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame([(i * 10, "abcdefghij"[i], bytearray([i])) for i in range(1, 8)],
                                 "id bigint, label string, media binary").repartition(3)


def test_take_ids_order_and_repeats(spark, samples):
    assert [r.label for r in take_ids(samples, [70, 10, 70]).collect()] == ["h", "b", "h"]
    assert take_ids(samples, [30], columns=["media"]).columns == ["media"]
    assert take_ids(samples, []).count() == 0
    assert take_ids(samples, [10, 20, 25], on_missing="skip").count() == 2
    for missing in ([25], [10, 25]):
        with pytest.raises(Exception, match="not stored"):
            take_ids(samples, missing, columns=["label"]).collect()
    for bad in ([True], [1.0], [None], [1, "a"], [1 << 63]):
        with pytest.raises(ValueError):
            take_ids(samples, bad)
    for options in ({"columns": ["absent"]}, {"columns": []}, {"columns": ["id", "id"]}, {"on_missing": "maybe"},
                    {"id_column": "media"}, {"id_column": "absent"}):
        with pytest.raises(ValueError):
            take_ids(samples, [10], **options)
    with pytest.raises(ValueError):
        take_ids(samples, ["10"])
    twice = samples.unionByName(samples.filter("id = 10"))
    with pytest.raises(Exception, match="duplicate stored id"):
        take_ids(twice, [10, 20]).collect()
    assert take_ids(twice, [20]).count() == 1
    names = spark.createDataFrame([("a'b", 1), ("né", 2)], "key string, x int")
    assert [r.x for r in take_ids(names, ["né", "a'b", "né"], "key").collect()] == [2, 1, 2]
    odd = spark.createDataFrame([(1, "a"), (2, "b")], ["sample key", "value"])
    assert [r.value for r in take_ids(odd, [2, 1], "sample key", ["value"]).collect()] == ["b", "a"]
    assert check_ids(["a", "b"]) == ["a", "b"]


def test_take_ids_from_a_frame_with_a_hot_id(spark, samples):
    wanted = [(i, 20 if i % 2 else 30) for i in range(1, 301)]
    request = spark.createDataFrame(wanted, "pos bigint, id bigint").repartition(4)
    for hot_rows in (10, 1_000_000):
        got = take_ids(samples, request, columns=["id"], keep_pos=True, hot_rows=hot_rows).collect()
        assert [tuple(r) for r in got] == wanted
    twice = samples.unionByName(samples.filter("id = 10"))
    every = spark.createDataFrame([(1, 10), (2, 20)], "pos bigint, id bigint")
    assert pairs(stored_duplicates(twice, every)) == [(10, 2)]
    assert pairs(duplicate_keys(twice, ["id"])) == [(10, 2)]


def test_manifest_positions(samples, spark):
    manifest = id_manifest(samples)
    assert pairs(manifest.select("pos", "id")) == [(i, i * 10) for i in range(1, 8)]
    assert [r.id for r in rows_at(samples, manifest, [5, 1, 5]).collect()] == [50, 10, 50]
    for bad in ([0], [8]):
        with pytest.raises(IndexError):
            rows_at(samples, manifest, bad)
    with pytest.raises(ValueError):
        rows_at(samples, manifest, [True])
    far = spark.createDataFrame([(1, 9)], "pos bigint, at bigint")
    with pytest.raises(Exception, match="out of range"):
        rows_at(samples, manifest, far).collect()
    listed = id_manifest(samples, ids=[30, 10])
    assert pairs(listed) == [(1, 30), (2, 10)]
    with pytest.raises(DuplicateKeys):
        id_manifest(samples, ids=[10, 10])
    with pytest.raises(DuplicateKeys):
        id_manifest(samples.unionByName(samples))
    with pytest.raises(Exception):
        id_manifest(samples.unionByName(spark.createDataFrame([(None, "x", None)], samples.schema))).count()


def test_batches_cover_every_row_once(spark, samples):
    seq = batches(samples, 3).collect()
    sizes = {}
    for r in seq:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert sizes == {0: 3, 1: 3, 2: 1}
    assert [r.id for r in sorted(seq, key=lambda r: r.pos)] == [i * 10 for i in range(1, 8)]
    assert batches(samples, 3, drop_last=True).count() == 6
    one = pairs(batches(samples.repartition(1), 3, columns=["id"], shuffle=True, seed=12))
    many = pairs(batches(samples.repartition(17), 3, columns=["id"], shuffle=True, seed=12))
    assert one == many and sorted(t[2] for t in one) == [i * 10 for i in range(1, 8)]
    assert one != pairs(batches(samples, 3, columns=["id"], shuffle=True, seed=13))
    with pytest.raises(ValueError):
        batches(samples, 0)
    lost = id_manifest(samples, ids=[10, 15])
    with pytest.raises(Exception, match="not stored"):
        batches(samples, 2, manifest=lost).collect()

    def total(frame):
        import pandas as pd
        assert list(frame.pos) == sorted(frame.pos)
        return pd.DataFrame({"batch_id": [frame.batch_id.iloc[0]], "s": [sum(b[0] for b in frame.media)]})
    sums = transform_batches(batches(samples, 2), total, "batch_id bigint, s bigint").collect()
    assert sum(r.s for r in sums) == 28 and len(sums) == 4


def test_samples(samples, monkeypatch):
    a = pairs(sample_rows(samples, 3, seed=1, columns=["id"]))
    assert a == pairs(sample_rows(samples.repartition(9), 3, seed=1, columns=["id"])) and len(set(a)) == 3
    assert len(set(pairs(sample_rows(samples, 7, seed=2, columns=["id"])))) == 7
    drawn = sample_rows(samples, 40, replace=True, seed=3).collect()
    assert len(drawn) == 40 and len({r.id for r in drawn}) > 1
    assert sample_rows(samples, 0).count() == 0
    monkeypatch.setattr(numbering, "TOP_N", 2)
    assert pairs(sample_rows(samples, 3, seed=1, columns=["id"])) == a
    for call in (lambda: sample_rows(samples, 8), lambda: sample_rows(samples, -1),
                 lambda: sample_rows(samples.limit(0), 1, replace=True)):
        with pytest.raises(ValueError):
            call()


def test_given_ids_are_stored_once(spark):
    from karst.operators.batches import batches, sample_rows
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "id bigint, v string")
    given = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "pos bigint, id bigint")
    for wrong in (given, given.replace({2: 9}, subset=["id"])):
        with pytest.raises(Exception, match="duplicate stored id|id is not stored"):
            batches(frame, 2, "id", manifest=wrong).collect()
        with pytest.raises(Exception, match="duplicate stored id|id is not stored"):
            sample_rows(frame, 3, "id", manifest=wrong).collect()
    good = given.filter("id <> 2").replace({3: 2}, subset=["pos"])
    assert sorted(tuple(r) for r in batches(frame, 2, "id", manifest=good).collect()) == [(0, 1, 1, "a"), (0, 2, 3, "d")]
    assert {r.v for r in sample_rows(frame, 2, "id", manifest=good).collect()} == {"a", "d"}


@pytest.mark.parametrize("kind, width", [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)])
def test_hamming_of_negative_codes(spark, kind, width):
    import numpy as np
    from karst.functions.kernels import distances
    from karst.functions.metrics import distance
    frame = spark.createDataFrame([([-1, 5, -128],)], "v array<bigint>").selectExpr(f"cast(v as array<{kind}>) as v")
    query = np.array([0, 5, 127], dtype=f"int{width}")
    assert distances(np.array([[-1, 5, -128]], dtype=query.dtype), query, "hamming").tolist() == [2.0 * width]
    from karst.functions.metrics import literal_vector
    assert frame.select(distance(frame["v"], literal_vector(query), "hamming").alias("d")).first().d == 2.0 * width


def test_deep_pages(spark, monkeypatch):
    from karst.operators import numbering
    from karst.operators.scan import page
    monkeypatch.setattr(numbering, "TOP_N", 6)
    frame = spark.createDataFrame([(i * 37 % 101, None if i == 5 else i) for i in range(101)], "`a b` bigint, c bigint")
    ordered = frame.orderBy("`a b`").collect()
    for limit, offset in ((10, 0), (3, 3), (25, 40), (50, 90), (0, 70), (5, 300)):
        assert page(frame, limit, offset, "a b").collect() == ordered[offset:offset + limit]
    assert page(frame, None, 95, "a b").collect() == ordered[95:]
