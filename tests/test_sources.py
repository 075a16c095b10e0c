import json
import sqlite3

import numpy as np
import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from pyspark.sql import functions as F, types as T

from karst.plans.store import TableNotFound
from karst.schema import SchemaMismatch, vector_dims
from karst.sources import import_csv, import_json, import_sqlite
from karst.sources.arrow_ipc import from_arrow, read_arrow, write_arrow
from karst.sources.json import JsonImportError, read_json
from karst.sources.json_cut import fragments
from karst.sources.media import media_facts, read_media
from karst.sources.sqlite import read_sqlite, write_sqlite


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return "file:" + str(path)


def test_json_rows_columns_and_lines(db, tmp_path):
    rows = '[{"sku":310,"note":null,"kg":0.125}, {"kg":12.5,"sku":44},\n\n {"sku":205,"note":"Öl, 5 l","kg":null}]'
    table = import_json(db, put(tmp_path, "stock.json", rows), "stock")
    found = {r.sku: (r.note, r.kg) for r in table.to_df().collect()}
    assert found == {310: (None, 0.125), 44: (None, 12.5), 205: ("Öl, 5 l", None)}
    assert table.schema["kg"].dataType == T.DoubleType() and table.schema["sku"].dataType == T.LongType()
    import_json(table, put(tmp_path, "more.json", '{"kg":[3,4.75],"note":["twine",""],"sku":[501,502]}'))
    assert [tuple(r) for r in table.to_df().filter("sku > 500").orderBy("sku").select("note", "kg").collect()] == [
        ("twine", 3.0), ("", 4.75)]
    log = import_json(db, put(tmp_path, "log.jsonl", '{"at":90,"who":"night"}\n\n{"at":30}\n{"who":"day","at":60}\n'), "log")
    import_json(log, put(tmp_path, "tail.log", '{"who":"late","at":120}\n'), jsonlines=True)
    assert [(r["at"], r.who) for r in log.to_df().orderBy("at").collect()] == [
        (30, None), (60, "day"), (90, "night"), (120, "late")]
    with pytest.raises(Exception):
        import_json(log, put(tmp_path, "broken.jsonl", '{"at":150,"who":"x"}\n{"at":\n'))
    assert log.to_df().agg(F.max("at")).first()[0] == 120


def test_json_vectors_and_lists(db, tmp_path):
    angles = [0.0, 40.0, 95.0, 170.0]
    points = [[float(np.cos(np.radians(a))), float(np.sin(np.radians(a))), 0.5] for a in angles]
    lines = [json.dumps({"p": v, "marks": list(range(i)), "deg": a}) for i, (a, v) in enumerate(zip(angles, points))]
    table = import_json(db, put(tmp_path, "ring.ndjson", "\n".join(lines)), "ring", vector_columns=["p"])
    assert vector_dims(table.schema) == {"p": 3}
    assert table.schema["p"].dataType.elementType == T.FloatType()
    near = table.vector_search(points[2], "p").limit(2).execute().collect()
    assert [r.deg for r in near] == [95.0, 40.0]
    assert {r.deg: r.marks for r in table.to_df().collect()} == {a: list(range(i)) for i, a in enumerate(angles)}
    third = 1 / 3
    wide = import_json(db, put(tmp_path, "wide.json", json.dumps({"n": [5], "p": [[third, -third, 2.0, 1e-9]]})), "wide",
                       vector_columns=["p"], types={"p": "array<double>"})
    assert list(wide.to_df().first().p) == [third, -third, 2.0, 1e-9]


def test_json_types_for_empty_input(db, tmp_path):
    hints = {"flags": "array<boolean>", "code": "string", "n": "int"}
    table = import_json(db, put(tmp_path, "none.json", "  [ ]\n"), "none", types=hints)
    assert table.to_df().isEmpty() and set(table.schema.names) == set(hints)
    import_json(table, put(tmp_path, "one.json", '{"n":[12],"flags":[[true,false]],"code":["k-7"]}'))
    row = table.to_df().first()
    assert (row.n, row.flags, row.code) == (12, [True, False], "k-7")


#: one document per rule that an import must reject, named by the rule
REJECTED = {
    "no columns and no types": "  []  ",
    "a string at the root": '"rows"',
    "rows that are lists": '[["a"],["b"]]',
    "a column without a list": '{"a":["x","y"],"b":"x"}',
    "columns of unequal length": '{"a":[0.5,1.5,2.5],"b":[],"c":[1,2,3]}',
    "text and truth values": '[{"k":"on"},{"k":null},{"k":false}]',
    "an object as a value": '{"k":[null,{"lat":4.5,"lon":51}]}',
    "lists inside lists": '[{"k":[["deep"]]},{"k":[]}]',
    "a whole number that a double rounds": '{"k":[0.25,-72057594037927937]}',
    "a list and text": '[{"k":"p,q"},{"k":["p","q"]}]',
    "text and numbers": '{"k":["12",13]}',
    "a whole number beyond 64 bits": '{"k":[-99999999999999999999]}',
}


@pytest.mark.parametrize("text", REJECTED.values(), ids=REJECTED.keys())
def test_rejected_json_creates_nothing(db, tmp_path, text):
    with pytest.raises(JsonImportError):
        import_json(db, put(tmp_path, "in.json", text), "target")
    assert "target" not in db.table_names()


@pytest.mark.parametrize("third", ["[0.5]", "[7,8,9,10]", '["7",8,9]', "[7,false,9]", "[7,8,null]", "[-4e200,8,9]"])
def test_rejected_vectors_create_nothing(db, tmp_path, third):
    lines = "".join(f'{{"n":{n},"p":{p}}}\n' for n, p in ((1, "[1,2,3]"), (2, "[4,5,6]"), (3, third)))
    with pytest.raises(JsonImportError):
        import_json(db, put(tmp_path, "in.jsonl", lines), "target", vector_columns=["p"])
    assert "target" not in db.table_names()


def test_json_hints(spark, tmp_path):
    path = put(tmp_path, "hints.json", '{"who":["ann","bo","cy"],"pay":[1200,990.0,null]}')
    assert {r.who: r.pay for r in read_json(spark, path, types={"pay": "smallint"}).collect()} == {"ann": 1200, "bo": 990, "cy": None}
    assert read_json(spark, path).schema["pay"].dataType == T.DoubleType()
    for types in ({"wage": "double"}, {"pay": "boolean"}, {"who": 1.5}):
        with pytest.raises(JsonImportError):
            read_json(spark, path, types=types)
    with pytest.raises(JsonImportError):
        read_json(spark, path, vector_columns=["where"])
    with pytest.raises(JsonImportError):
        read_json(spark, put(tmp_path, "void.jsonl", '{"p":null}\n{"p":null}\n'), vector_columns=["p"])
    edges = [-2**63, 2**53 + 1, 2**63 - 1]
    exact = read_json(spark, put(tmp_path, "exact.json", json.dumps({"k": [*edges, None]})))
    assert sorted(r.k for r in exact.dropna().collect()) == edges
    empty = read_json(spark, put(tmp_path, "null.jsonl", '{"x":null,"y":"z"}\n{"y":"w"}\n'))
    assert [r.x for r in empty.collect()] == [None, None]


def test_csv_options_and_strictness(db, tmp_path):
    types = {"town": "string", "depth": "double", "code": "bigint"}
    text = 'code|town|depth\n81|"Ys | lower"|-3.75\n17|Łeba|?\n26|?|10\n'
    table = import_csv(db, put(tmp_path, "towns.csv", text), "towns", delim="|", missingstring="?", types=types)
    assert {r.code: (r.town, r.depth) for r in table.to_df().collect()} == {
        81: ("Ys | lower", -3.75), 17: ("Łeba", None), 26: (None, 10.0)}
    import_csv(table, put(tmp_path, "next.csv", "code|town|depth\n90|Skye|0.5\n91|Mull|6\n"), delim="|")
    assert table.count_rows() == 5
    with pytest.raises(Exception):
        import_csv(table, put(tmp_path, "torn.csv", "code,town,depth\n95,Iona,7\nninety-six,Jura,8\n"))
    assert table.count_rows() == 5
    loose = import_csv(db, put(tmp_path, "loose.csv", "depth,code\nunknown,52\n8.5,53\n"), "loose", strict=False,
                       types={"depth": "double"})
    assert {r.code: r.depth for r in loose.to_df().collect()} == {52: None, 53: 8.5}


def test_sqlite_tables_queries_and_shards(db, spark, tmp_path):
    path = tmp_path / "harbour.db"
    source = sqlite3.connect(path)
    source.execute('CREATE TABLE "berth-log (2)" (ship TEXT, metres REAL, quay INTEGER)')
    source.executemany('INSERT INTO "berth-log (2)" VALUES (?, ?, ?)', [
        ("Ægir", 88.25, 4), (None, 140.0, 2), ("Nørd", None, 4), ("Tern", 12.0, None)])
    source.execute("CREATE TABLE seals (no INTEGER, stamp BLOB)")
    source.executemany("INSERT INTO seals VALUES (?, ?)", [(n, bytes(range(n))) for n in (5, 0, 2)])
    source.commit()
    uri = "file:" + str(path)
    table = import_sqlite(db, uri, "berths", source_table="berth-log (2)")
    stored = sorted(map(tuple, table.to_df().select("quay", "ship", "metres").collect()), key=str)
    assert stored == sorted([(4, "Ægir", 88.25), (2, None, 140.0), (4, "Nørd", None), (None, "Tern", 12.0)], key=str)
    import_sqlite(table, uri, sql='SELECT upper(ship) AS ship, metres / 2 AS metres, quay FROM "berth-log (2)"'
                                  " WHERE quay = ? AND metres > ?", params=(4, 50.5))
    assert table.to_df().filter("metres = 44.125").first().quay == 4 and table.count_rows() == 5
    with pytest.raises(Exception):
        import_sqlite(table, uri, sql="SELECT tonnage FROM seals")
    for bad in (dict(source_table="seals", sql="SELECT no FROM seals"), dict()):
        with pytest.raises(ValueError):
            import_sqlite(table, uri, **bad)
    assert table.count_rows() == 5, "a failed import leaves the table alone"
    stamps = read_sqlite(spark, uri, source_table="seals")
    assert {r.no: bytes(r.stamp) for r in stamps.collect()} == {n: bytes(range(n)) for n in (0, 2, 5)}
    with pytest.raises(Exception):
        read_sqlite(spark, uri, sql="SELECT quay AS mixed FROM \"berth-log (2)\" WHERE quay > 3 UNION ALL SELECT ship"
                                    " FROM \"berth-log (2)\" WHERE ship = 'Tern'").collect()
    shards = "file:" + str(tmp_path / "shards")
    rows = spark.range(1000).select("id", (F.col("id") * 0.5).alias("half")).repartition(3)
    assert write_sqlite(rows, shards, "t") == 1000
    back = read_sqlite(spark, shards, source_table="t", rows_per_partition=100)
    assert back.rdd.getNumPartitions() > 3
    assert sorted(back.collect()) == sorted(rows.collect())


def test_arrow_layouts(db, spark, tmp_path):
    gauges = pa.table({
        "gauge": pa.array([70, 12, 55, 31], pa.int64()),
        "frame": pa.array([None, bytes(range(250, 256)), b"", b"\n"], pa.large_binary()),
        "tag": pa.array([b"QX9", None, b"\x00\x00\x00", b"zz!"], pa.binary(3)),
        "ticks": pa.array([[], [-5, 40, 2**31 - 1], [8], None], pa.large_list(pa.int32())),
        "heading": pa.array([[0.5, -2, 8], None, [1, 1, 1], [-0.25, 0, 3]], pa.list_(pa.float32(), 3)),
        "level": pa.array([None, -0.125, 1e300, 6.0]),
        "river": pa.array(["Łyna", "Ób", "Łyna", None]).dictionary_encode(),
        "small": pa.array([200, 0, None, 255], pa.uint8()),
        "big": pa.array([2**63, 9, 2**64 - 1, None], pa.uint64()),
        "since": pa.array([45_000_000_000_007, 3, None, 0], pa.time64("ns")),
        "site": pa.array([None, {"bank": -7, "crew": []}, {"bank": None, "crew": ["Io", "Mo"]}, {"bank": 300, "crew": None}],
                         pa.struct([("bank", pa.int16()), ("crew", pa.list_(pa.string()))])),
    })
    frame = from_arrow(spark, gauges)
    assert vector_dims(frame.schema) == {"heading": 3}
    rows = {r.gauge: r for r in frame.collect()}
    assert (rows[31].small, int(rows[55].big), rows[70].since) == (255, 2**64 - 1, 45_000_000_000_007)
    assert (rows[12].ticks, rows[70].ticks, rows[31].ticks) == ([-5, 40, 2**31 - 1], [], None)
    assert rows[12].heading is None and list(rows[70].heading) == [0.5, -2, 8]
    assert rows[55].site.crew == ["Io", "Mo"] and rows[31].site.crew is None and rows[70].site is None
    assert bytes(rows[55].tag) == bytes(3) and rows[12].tag is None and rows[55].river == "Łyna"
    assert vector_dims(db.create_table("gauges", gauges).schema) == {"heading": 3}
    folder = tmp_path / "dumps"
    folder.mkdir()
    for name, open_, step in (("one.arrow", ipc.new_stream, 3), ("two.arrow", ipc.new_file, 2)):
        with open_(str(folder / name), gauges.schema) as writer:
            writer.write_table(gauges, max_chunksize=step)
    again = read_arrow(spark, "file:" + str(folder))
    assert sorted(r.gauge for r in again.collect()) == sorted(2 * gauges["gauge"].to_pylist())
    out, part = "file:" + str(tmp_path / "out"), frame.select("river", "gauge", "ticks")
    assert write_arrow(part, out) == 4
    assert {r.gauge: r for r in read_arrow(spark, out).collect()} == {r.gauge: r for r in part.collect()}
    with pytest.raises(ValueError):
        from_arrow(spark, pa.table({"lag": pa.array([90, None], pa.duration("ms"))}))


def test_media_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    for name, data in (("a.bin", b"\x01\x02"), ("b.bin", b"\x00"), ("c.txt", b"skip")):
        (tmp_path / "m" / name).write_bytes(data)
    found = read_media(spark, "file:" + str(tmp_path / "m"), "*.bin")
    assert sorted(bytes(r.content) for r in found.collect()) == [b"\x00", b"\x01\x02"]
    facts = media_facts(found, "path").collect()
    assert {r.n_bytes for r in facts} == {1, 2}


def test_imports_need_a_name_or_table(db, tmp_path):
    with pytest.raises(ValueError):
        import_csv(db, put(tmp_path, "a.csv", "id\n1\n"))
    with pytest.raises(TableNotFound):
        db.open_table("missing")
    table = db.create_table("t", {"id": [1], "v": [np.float32(1.0).item()]})
    with pytest.raises(SchemaMismatch):
        import_csv(table, put(tmp_path, "b.csv", "id\n1\n"), types={"id": "bigint"})


# ---------------------------------------------------------------- documents of any size

def flat(values):
    return [tuple(sorted(v.asDict().items())) for v in values]


HARD = [{"t": 'a,b"]}[{,', "n": [1, 2]}, {"t": "back\\slash\\", "n": []}, {"t": "\\\",\\u00e9 é\U0001f600", "n": None}, {"t": "", "n": [3]}]


@pytest.mark.parametrize("size", [50, 10_000])
def test_json_documents_cut_at_every_byte(spark, tmp_path, size):
    """Ranges so short that records, strings, keys and brackets lie across several of them."""
    rows = [dict(HARD[i % 4], i=i) for i in range(5)]
    pretty = "﻿ \n" + json.dumps(rows, indent=2, ensure_ascii=False) + "\n\n"
    columns = {"i": [r["i"] for r in rows], "k,e:y\"[": [r["t"] for r in rows], "n": [r["n"] for r in rows]}
    one, two = put(tmp_path, "rows.json", pretty), put(tmp_path, "columns.json", json.dumps(columns, indent=1, ensure_ascii=False))
    three = put(tmp_path, "tight.json", json.dumps(columns, ensure_ascii=False, separators=(",", ":")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        wanted = sorted((r["i"], r["t"], r["n"]) for r in rows)
        assert sorted((r.i, r.t, r.n) for r in read_json(spark, one).collect()) == wanted
        for path in (two, three):
            assert sorted((r.i, r['k,e:y"['], r.n) for r in read_json(spark, path).collect()) == wanted
        if size > 1000:
            assert read_json(spark, [two, three]).count() == 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_items_of_a_column_travel_together():
    """A row for a run of items, not for each of them, and none for a comma inside a string, a list or an object."""
    from types import SimpleNamespace

    from karst.sources.json_cut import WHOLE, _cut
    items = [['"a,\\",["', "[1,2]", '{"x":[3,"]"]}', "\n 7 ", '"é\U0001f600"'][i % 5] for i in range(5000)]
    pieces = ('{"k":[' + ",".join(items) + '],"m":[]}').split(",")
    rows = pa.table({"file": ["f"] * len(pieces), "start": pa.array([0] * len(pieces), pa.int64()), "value": pieces})
    out = pa.Table.from_batches(_cut(SimpleNamespace(value={("f", 0): (False, 0)}), 2, iter(rows.to_batches(max_chunksize=2000)))).to_pylist()
    assert len(out) < 20 and [r["seq"] for r in out] == list(range(len(out)))
    found = [r for r in out if r["kind"] == "item" and r["part"] == WHOLE and r["col"] == 1]
    assert [v for r in found for v in r["values"]] == items
    assert [r["at"] for r in found] == np.cumsum([0, *(len(r["values"]) for r in found[:-1])]).tolist()
    assert all(r["size"] == len("".join(r["values"]).encode()) for r in out)


def test_column_documents_meet_in_blocks(spark, tmp_path, monkeypatch):
    """Ranges and blocks that do not begin together, in two documents with the columns in another order."""
    from karst.sources import json_cut
    monkeypatch.setattr(json_cut, "BLOCK_ROWS", 7)
    rows = [{"n": i, "s": f"{i},[" * (i % 4), "l": list(range(i % 3))} for i in range(100)]
    one = {c: [r[c] for r in rows[:61]] for c in ("n", "s", "l")}
    two = {c: [r[c] for r in rows[61:]] for c in ("l", "n", "s")}
    paths = [put(tmp_path, "one.json", json.dumps(one)), put(tmp_path, "two.json", json.dumps(two, indent=1))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 400)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        assert sorted((r.n, r.s, r.l) for r in read_json(spark, paths).collect()) == [(r["n"], r["s"], r["l"]) for r in rows]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("text", ['[{"a":1}', '[{"a":1}]]', '[{"a":1}][{"a":2}]', '[{"a":1}] x', 'x [{"a":1}]', '[{"a":"1}]', '{"a":[1]', '{"a":[1]} {"a":[2]}',
                                  '{"a":[1],"b":{"c":[2]}}', '{"a" [1]}', '{"a":[1] "b":[2]}', ""])
def test_json_documents_that_are_no_documents(spark, tmp_path, text):
    with pytest.raises(Exception):
        read_json(spark, put(tmp_path, "bad.json", text)).collect()


def test_empty_lists_and_columns(spark, tmp_path):
    assert read_json(spark, put(tmp_path, "e.json", '{"a":[ ],"b":[]}')).count() == 0
    found = read_json(spark, put(tmp_path, "f.json", '{"a":[[ ],[1]],"b":[null,"x"]}'))
    assert sorted((r.a, r.b or "") for r in found.collect()) == [([], ""), ([1], "x")]


def test_large_json_array_in_several_tasks(spark, tmp_path):
    """300 MB in one file."""
    path = tmp_path / "large.json"
    body = "x, y [\\\"z\\\"] " * 24
    count = 0
    with open(path, "w") as file:
        file.write("[")
        while file.tell() < 300 << 20:
            file.write(("," if count else "") + ",".join(f'{{"id":{i},"body":"{body}"}}' for i in range(count, count + 2000)))
            count += 2000
        file.write("]")
    found = read_json(spark, "file:" + str(path), types={"id": "bigint", "body": "string"})
    assert fragments(spark, "file:" + str(path)).rdd.getNumPartitions() > 2
    assert tuple(found.agg(F.count("*"), F.sum("id"), F.countDistinct("body")).first()) == (count, count * (count - 1) // 2, 1)


@pytest.mark.parametrize("columnar", [False, True])
def test_documents_of_partitions_without_rows_or_with_many_batches(spark, tmp_path, columnar):
    """A split of a Parquet file that holds no row group gives a task no batch."""
    from karst.workload.imports import write_documents
    path = "file:" + str(tmp_path / "docs")
    rows = spark.range(1, 60_001, 1, 3).filter("id > 20000").selectExpr("id", "concat('a, ', id) AS name")
    write_documents(rows, path, columnar)
    found = read_json(spark, path)
    assert found.exceptAll(rows).isEmpty() and found.count() == 40_000


def test_row_documents_are_written_a_batch_at_a_time():
    from karst.workload.imports import array_lines
    batch = pa.record_batch({"id": pa.array(range(1000)), "s": pa.array(["a,]"] * 1000)})
    found = list(array_lines(iter([batch.slice(0, 0), batch, batch])))
    assert [len(lines) for lines in found] == [1000, 1000, 1]
    assert json.loads("\n".join(line for lines in found for line in lines)) == batch.to_pylist() * 2
    assert list(array_lines(iter([batch.slice(0, 0)]))) == []
