"""Commit records: one small JSON file per version, written last.

A record names the segments (Parquet directories) that make up the version.
Creating the next number fails if another writer was faster; there is no
further concurrency control, so one writer per table is assumed.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from karst.plans import files


@dataclass
class Segment:
    name: str
    rows: int
    files: int = 0


@dataclass
class Commit:
    version: int
    operation: str
    schema: str
    segments: list[Segment]
    timestamp_ns: int = 0
    table_metadata: dict[str, str] = field(default_factory=dict)
    summary: dict[str, str] = field(default_factory=dict)
    tokens: dict[str, int] = field(default_factory=dict)


def _encode(record: Commit) -> str:
    return json.dumps(asdict(record), ensure_ascii=False)


def _decode(text: str) -> Commit:
    raw = json.loads(text)
    raw["segments"] = [Segment(**s) for s in raw["segments"]]
    return Commit(**raw)


class CommitLog:
    """Numbered records below one directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return sorted(int(name[:-5]) for name, is_dir, _ in files.children(self.spark, self.path)
                      if not is_dir and name.endswith(".json") and name[:-5].isdigit())

    def read(self, version: int) -> Commit:
        return _decode(files.read_text(self.spark, f"{self.path}/{version:012d}.json"))

    def latest(self) -> Commit | None:
        versions = self.versions()
        return self.read(versions[-1]) if versions else None

    def append(self, record: Commit) -> Commit:
        record.timestamp_ns = time.time_ns()
        files.write_new(self.spark, f"{self.path}/{record.version:012d}.json", _encode(record))
        return record

    def forget(self, version: int) -> None:
        files.delete(self.spark, f"{self.path}/{version:012d}.json")
