"""Named indexes of a stored table: which segments they cover and where they live."""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from karst.functions.metrics import check_metric
from karst.operators import cells as C
from karst.operators import layouts as L
from karst.operators.numbering import smallest
from karst.operators.scan import where as apply_where
from karst.operators.search import DISTANCE, knn, vector_column
from karst.plans import files
from karst.schema import is_integral
from karst.session import materialise

SEGMENT = "_segment"
VECTOR_KINDS = ("ivf_flat", "ivf_pq", "ivf_sq")
SCALAR_KINDS = ("btree", "bitmap", "labellist")
# Accepted spellings of the index kinds.  The graph variants keep
# their quantiser; the graph itself is a single-node structure.
ALIASES = {"ivfflat": "ivf_flat", "ivfpq": "ivf_pq", "ivfsq": "ivf_sq", "ivfhnswpq": "ivf_pq",
           "ivfhnswsq": "ivf_sq", "label_list": "labellist"}


class IndexNotFound(KeyError):
    pass


class IndexExists(ValueError):
    pass


@dataclass
class Fragment:
    name: str
    number: int
    segments: list[str]


@dataclass
class IndexRecord:
    name: str
    kind: str
    columns: list[str]
    options: dict = field(default_factory=dict)
    fragments: list[Fragment] = field(default_factory=list)
    model: dict = field(default_factory=dict)

    def covered(self) -> list[str]:
        return [s for f in self.fragments for s in f.segments]


@dataclass(frozen=True)
class IndexStats:
    num_indexed_rows: int
    num_unindexed_rows: int
    num_indices: int


def canonical(kind: str, allowed: Sequence[str]) -> str:
    name = kind.lower().replace("-", "_")
    name = ALIASES.get(name.replace("_", ""), name)
    if name not in allowed:
        raise ValueError(f"unknown index type {kind!r}; use one of {', '.join(allowed)}")
    return name


def _pack(array: np.ndarray) -> dict:
    return {"shape": list(array.shape), "type": str(array.dtype),
            "data": base64.b64encode(np.ascontiguousarray(array).tobytes()).decode()}


def _unpack(raw: dict) -> np.ndarray:
    return np.frombuffer(base64.b64decode(raw["data"]), raw["type"]).reshape(raw["shape"]).copy()


class Indexes:
    """Index records of one table: ``_indexes/<name>/<number>.json`` plus layout directories."""

    def __init__(self, table):
        self.table = table
        self.spark = table.spark
        self.root = f"{table.path}/_indexes"

    # ---------------------------------------------------------------- records

    def names(self) -> list[str]:
        return [name for name, is_dir, _ in files.children(self.spark, self.root)
                if is_dir and self._numbers(name)]

    def _numbers(self, name: str) -> list[int]:
        return sorted(int(n[:-5]) for n, is_dir, _ in files.children(self.spark, f"{self.root}/{name}")
                      if n.endswith(".json") and not is_dir)

    def read(self, name: str) -> IndexRecord:
        numbers = self._numbers(name)
        if not numbers:
            raise IndexNotFound(f"index does not exist: {name}")
        raw = json.loads(files.read_text(self.spark, f"{self.root}/{name}/{numbers[-1]:06d}.json"))
        raw["fragments"] = [Fragment(**f) for f in raw["fragments"]]
        return IndexRecord(**raw)

    def _save(self, record: IndexRecord) -> None:
        numbers = self._numbers(record.name)
        number = numbers[-1] + 1 if numbers else 1
        files.write_new(self.spark, f"{self.root}/{record.name}/{number:06d}.json",
                        json.dumps(asdict(record), ensure_ascii=False))

    def drop(self, name: str) -> None:
        self.read(name)
        files.delete(self.spark, f"{self.root}/{name}")

    def for_column(self, column: str) -> IndexRecord | None:
        """The vector index of a column, if there is one."""
        for name in self.names():
            record = self.read(name)
            if record.kind in VECTOR_KINDS and record.columns == [column]:
                return record
        return None

    def stats(self, name: str) -> IndexStats:
        record = self.read(name)
        covered = set(record.covered())
        segments = self.table.commit().segments
        inside = sum(s.rows for s in segments if s.name in covered)
        return IndexStats(inside, sum(s.rows for s in segments) - inside, len(record.fragments))

    # ------------------------------------------------------------------ build

    def build(self, kind: str, columns: Sequence[str], options: dict, replace: bool) -> IndexRecord | None:
        name = "_".join(columns) + "_idx"
        exists = name in self.names()
        if exists and not replace:
            raise IndexExists(f"index exists: {name}; pass replace=True")
        record = IndexRecord(name, kind, list(columns), dict(options))
        segments = [s.name for s in self.table.commit().segments]
        # fragments of a replaced index stay until the new record is written
        old = self.read(name).fragments if exists else []
        rows = self.table.segments_frame(segments)
        if kind in VECTOR_KINDS:
            self._train(record, rows)
        self._write_fragment(record, segments)
        self._save(record)
        for fragment in old:
            files.delete(self.spark, f"{self.root}/{name}/{fragment.name}")
        return record

    def extend(self, name: str) -> None:
        """Index the segments written since the last build; drop fragments that became empty."""
        record = self.read(name)
        live = [s.name for s in self.table.commit().segments]
        covered = set(record.covered())
        fresh = [s for s in live if s not in covered]
        dead = [f for f in record.fragments if not set(f.segments) & set(live)]
        if not fresh and len(dead) == len(record.fragments):
            dead = dead[:-1]     # an emptied table keeps one, whose columns its readers need
        if not fresh and not dead:
            return
        record.fragments = [f for f in record.fragments if f not in dead]
        if fresh:
            self._write_fragment(record, fresh)
        self._save(record)
        for fragment in dead:
            files.delete(self.spark, f"{self.root}/{name}/{fragment.name}")

    def _train(self, record: IndexRecord, rows: DataFrame) -> None:
        column = record.columns[0]
        o = record.options
        cells = C.train_cells(rows, column, o["metric"], o.get("num_partitions"), o.get("max_iterations"),
                              o.get("sample_rate"))
        record.model = {"centres": _pack(cells.centres), "shares": cells.shares}
        if record.kind == "ivf_pq":
            codec = C.train_product_codes(C.assign_cells(rows, column, cells), column, cells, o.get("num_sub_vectors"))
            record.model["books"], record.model["group"] = _pack(codec.books), _pack(codec.group)
        elif record.kind == "ivf_sq":
            codec = C.train_scalar_codes(C.assign_cells(rows, column, cells), column, cells)
            record.model |= {"low": _pack(codec.low), "step": _pack(codec.step)}

    def _write_fragment(self, record: IndexRecord, segments: list[str]) -> None:
        numbers = [f.number for f in record.fragments]
        fragment = Fragment(f"part-{uuid.uuid4().hex}", max(numbers) + 1 if numbers else 0, segments)
        path = f"{self.root}/{record.name}/{fragment.name}"
        rows = self.table.segments_frame(segments, with_segment=True)
        if record.kind in VECTOR_KINDS:
            column = record.columns[0]
            cells = self.cells(record)
            assigned = C.assign_cells(rows, column, cells)
            codec = self.codec(record)
            if codec is not None:
                assigned = C.add_codes(assigned, column, cells, codec)
            C.write_cells(assigned, cells, path, fragment.number)
        elif record.kind == "btree":
            L.write_range_layout(rows, record.columns, path)
        elif record.kind == "bitmap":
            L.write_value_layout(rows, record.columns[0], path)
        elif record.kind == "labellist":
            key = record.options["key"]
            (rows.select(F.explode(F.array_distinct(F.col(f"`{record.columns[0]}`"))).alias("label"), f"`{key}`", SEGMENT)
             .filter("label IS NOT NULL").repartitionByRange("label", key).sortWithinPartitions("label")
             .write.parquet(path))
        else:
            key = record.options["key"]
            postings = L.text_postings(rows, record.columns, **record.options, carry=[SEGMENT])
            # the range shuffle reads its input twice
            postings = materialise(postings, "postings")
            postings.repartitionByRange("term", key).sortWithinPartitions("term").write.parquet(path)
        record.fragments.append(fragment)

    # ------------------------------------------------------------------- read

    def cells(self, record: IndexRecord) -> C.Cells:
        return C.Cells(_unpack(record.model["centres"]), record.options["metric"], record.model["shares"])

    def codec(self, record: IndexRecord):
        if record.kind == "ivf_pq":
            return C.ProductCodes(_unpack(record.model["books"]), _unpack(record.model["group"]) if "group" in record.model else None)
        if record.kind == "ivf_sq":
            return C.ScalarCodes(_unpack(record.model["low"]), _unpack(record.model["step"]))
        return None

    def layout(self, record: IndexRecord) -> DataFrame | None:
        """Indexed rows that are still part of the table."""
        live = {s.name for s in self.table.commit().segments}
        if not record.fragments:
            return None
        frames = []
        for fragment in record.fragments:
            reader = self.spark.read
            if record.kind == "bitmap":
                # the directory names must be read with the type of the column
                reader = reader.schema(T.StructType([
                    *self.table.schema.fields, T.StructField(SEGMENT, T.StringType()),
                    T.StructField("_part", self.table.schema[record.columns[0]].dataType)]))
            frame = reader.parquet(f"{self.root}/{record.name}/{fragment.name}")
            kept = [s for s in fragment.segments if s in live]
            if len(kept) < len(fragment.segments):
                frame = frame.filter(F.col(SEGMENT).isin(kept)) if kept else frame.limit(0)
            frames.append(frame)
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def uncovered(self, record: IndexRecord) -> DataFrame | None:
        covered = set(record.covered())
        fresh = [s.name for s in self.table.commit().segments if s.name not in covered]
        return self.table.segments_frame(fresh) if fresh else None

    def scan(self, name: str, predicate: str | Column | None = None) -> DataFrame:
        """Table rows through a range or value layout, plus rows not indexed yet."""
        record = self.read(name)
        if record.kind not in ("btree", "bitmap"):
            raise ValueError(f"index {name} has no row layout")
        names = [f"`{n}`" for n in self.table.schema.names]
        rows = self.layout(record)
        if record.kind == "bitmap" and predicate is not None:
            # Directories stand in for the column, so the predicate prunes them.  Null and
            # empty values share the default directory and are told apart by the stored column.
            column = record.columns[0]
            named = (rows.filter("_part IS NOT NULL").withColumnRenamed(column, "_stored")
                     .withColumnRenamed("_part", column))
            found = apply_where(named, predicate).drop(column).withColumnRenamed("_stored", column).select(*names)
            out = found.unionByName(apply_where(rows.filter("_part IS NULL"), predicate).select(*names))
        else:
            out = apply_where(rows, predicate).select(*names)
        rest = self.uncovered(record)
        return out if rest is None else out.unionByName(apply_where(rest, predicate))

    def rows_with_labels(self, name: str, labels: Sequence, require: str = "any") -> DataFrame:
        record = self.read(name)
        key = record.options["key"]
        postings = self.layout(record).drop(SEGMENT)
        rest = self.uncovered(record)
        if rest is not None:
            postings = postings.unionByName(L.label_postings(rest, record.columns[0], key))
        return L.rows_with_labels(self.table.to_df(), postings, key, labels, require)

    def postings(self, name: str) -> DataFrame:
        """Text postings of the indexed rows."""
        record = self.read(name)
        if record.kind != "fts":
            raise ValueError(f"index {name} holds no postings")
        return self.layout(record).drop(SEGMENT)

    def search(self, record: IndexRecord, query, k: int, nprobes: int | None, refine_factor: int | None,
               where, prefilter: bool, select, key, offset: int) -> DataFrame:
        """Approximate search over the index, exact search over rows not indexed yet."""
        column = record.columns[0]
        cells, codec = self.cells(record), self.codec(record)
        names = [c for c in (select or self.table.schema.names) if c != DISTANCE]
        order = [] if key is None else [key] if isinstance(key, str) else list(key)
        wide = list(dict.fromkeys([*names, *order, *([] if prefilter else self.table.schema.names)]))
        common = dict(key=key, select=wide, where=where if prefilter else None)
        layout = self.layout(record)
        if codec is None:
            found = C.ivf_search(layout, cells, query, k + offset, column, nprobes, **common)
        else:
            found = C.code_search(layout, cells, codec, query, k + offset, column, nprobes=nprobes,
                                  refine_factor=refine_factor, **common)
        rest = self.uncovered(record)
        if rest is not None:
            found = found.unionByName(knn(rest, query, k + offset, column, metric=cells.metric, **common))
        found = smallest(found, [DISTANCE, *order], k, offset)
        if not prefilter:
            found = apply_where(found, where)
        return found.select(*[f"`{c}`" for c in names], DISTANCE)


def create_vector_index(table, column: str | None = None, type: str = "auto", *, num_partitions: int = -1,
                        num_sub_vectors: int = -1, max_iterations: int = -1, sample_rate: float = 0.0,
                        metric: str = "l2", replace: bool = False) -> str:
    """Build a vector index and return its name; ``auto`` clusters the vectors, a small table into few cells."""
    column = vector_column(table.schema, column)
    kind = canonical(type, (*VECTOR_KINDS, "auto"))
    if kind == "auto":
        kind = "ivf_flat"
    options = {"metric": check_metric(metric), "num_partitions": num_partitions, "num_sub_vectors": num_sub_vectors,
               "max_iterations": max_iterations, "sample_rate": sample_rate}
    return table.indexes.build(kind, [column], options, replace).name


def create_scalar_index(table, columns: str | Sequence[str], type: str = "btree", *, key: str | None = None,
                        replace: bool = False) -> str:
    """Build a range, value or label layout on columns of the table."""
    names = [columns] if isinstance(columns, str) else list(columns)
    kind = canonical(type, SCALAR_KINDS)
    unknown = [n for n in names if n not in table.schema.names]
    if unknown or not names:
        raise ValueError(f"column does not exist: {', '.join(unknown) or '(none)'}")
    if kind != "btree" and len(names) != 1:
        raise ValueError(f"a {kind} index takes one column")
    if kind == "bitmap" and not (is_integral(table.schema[names[0]].dataType) or isinstance(
            table.schema[names[0]].dataType, (T.StringType, T.BooleanType, T.DateType))):
        raise ValueError("a bitmap index takes an integer, string, boolean or date column")
    if kind == "labellist" and not isinstance(table.schema[names[0]].dataType, T.ArrayType):
        raise ValueError("a labellist index takes an array column")
    options = {"key": key or table.schema.names[0]} if kind == "labellist" else {}
    return table.indexes.build(kind, names, options, replace).name


def create_fts_index(table, columns: str | Sequence[str], *, key: str | None = None, base_tokenizer: str = "simple",
                     language: str = "English", max_token_length: int = -1, lowercase: bool = True,
                     stem: bool = False, remove_stop_words: bool = False, ascii_folding: bool = False,
                     replace: bool = False) -> str:
    """Build text postings; ``key`` names the document id, the first column by default."""
    names = [columns] if isinstance(columns, str) else list(columns)
    L.check_text_options(names, max_token_length, language, stem)
    options = {"key": key or table.schema.names[0], "tokenizer": base_tokenizer, "language": language,
               "lowercase": lowercase, "stem": stem, "remove_stop_words": remove_stop_words,
               "ascii_folding": ascii_folding, "max_token_length": max_token_length}
    return table.indexes.build("fts", names, options, replace).name
