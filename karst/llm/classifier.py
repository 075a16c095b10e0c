"""Quality classifier: kernel ridge scores by random Fourier features, calibrated to probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from karst.llm import kernels as K
from karst.llm.statistics import FEATURES, features
from karst.operators.bounds import left_join_unique
from karst.session import materialise, ship

#: random features, width of the Gaussian kernel in standard deviations, ridge per random feature
RANDOM, WIDTH, RIDGE, SEED = 256, 4.0, 1e-2, 7
#: bins of raw scores that calibration works on
BINS = 1000
THRESHOLD = 0.7
_CLIP = 6.0


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.utf8(batch.column("text"))
        for first, end, part, bounds in K.chunks(data, offsets):
            values = features(part, bounds)
            edges = (np.arange(end - first + 1) * len(FEATURES)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, end - first),
                 pa.ListArray.from_arrays(pa.array(edges), pa.array(values.ravel()))], ["doc_id", "x"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


@dataclass
class Model:
    """Everything that scores a row of statistics; its size does not depend on the data."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """cos(Wx + b): inner products approximate a Gaussian kernel.  A last column of ones is the offset."""
        random = np.random.default_rng(SEED)
        directions = random.normal(0.0, 1.0 / WIDTH, (x.shape[1], RANDOM))
        phases = random.uniform(0.0, 2 * np.pi, RANDOM)
        z = np.clip((x - self.mean) / self.deviation, -_CLIP, _CLIP)
        return np.hstack([np.sqrt(2.0 / RANDOM) * np.cos(z @ directions + phases), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.levels)


def _equations(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of z z' and z y over a partition."""
    total = np.zeros((RANDOM + 1, RANDOM + 2))
    for batch in batches:
        x, y = _matrix(batch), batch.column("y").to_numpy(zero_copy_only=False)
        for at in range(0, len(x), 4096):
            z = model.fourier(x[at:at + 4096])
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ y[at:at + 4096]
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((RANDOM + 1) * (RANDOM + 2))
    for batch in batches:
        for value in batch.column("sums"):
            total += np.frombuffer(value.as_py())
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def isotonic(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Non-decreasing means of neighbouring bins that fit best in weighted squares."""
    blocks: list[list[float]] = []
    for count, total in zip(counts, sums):
        blocks.append([total, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, count, size = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += count
            blocks[-1][2] += size
    return np.concatenate([np.full(size, total / count) for total, count, size in blocks])


def fit(train: DataFrame) -> Model:
    """Fit on ``train(x, y, calibrate)``; rows marked ``calibrate`` only set the calibration.

    All rows are used.  Only sums of fixed size and the bins reach the driver.
    With no rows, or one class, every score is the share of that class.
    """
    size = len(FEATURES)
    each = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(size) for n, f in (
        ("m", F.avg), ("s", F.stddev_pop))]
    facts = train.agg(F.count("*").alias("n"), F.avg("y").alias("y"), *each).first()
    if not facts["n"] or facts["y"] in (0.0, 1.0):
        level = 0.5 if not facts["n"] else facts["y"]
        return Model(np.zeros(size), np.ones(size), np.zeros(RANDOM + 1), np.array([0.0, 1.0]), np.array([level, level]))
    deviation = np.array([facts[f"s{i}"] for i in range(size)])
    model = Model(np.array([facts[f"m{i}"] for i in range(size)]), np.where(deviation > 1e-9, deviation, 1.0),
                  np.zeros(RANDOM + 1), np.zeros(2), np.zeros(2))
    parts = train.filter("not calibrate").select("x", "y").mapInArrow(lambda b: _equations(model, b), "sums binary")
    parts = parts.repartition(4).mapInArrow(_add, "sums binary").collect()
    sums = sum(np.frombuffer(r["sums"]) for r in parts).reshape(RANDOM + 1, RANDOM + 2)
    ridge = np.eye(RANDOM + 1) * RIDGE
    ridge[-1, -1] = 1e-9
    model.weights = np.linalg.solve(sums[:, :-1] + ridge, sums[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch)), -1.0, 2.0)
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(raw * BINS / 3).astype(np.int64)), pa.array(raw),
                                              batch.column("y")], ["bin", "raw", "y"])

    bins = (train.select("x", "y", "calibrate").filter("calibrate").mapInArrow(binned, "bin bigint, raw double, y double")
            .groupBy("bin").agg(F.avg("raw").alias("at"), F.count("*").alias("n"), F.sum("y").alias("y")).toPandas()
            .sort_values("bin"))
    if len(bins):
        # one imagined row of the overall share keeps the ends off 0 and 1
        model.edges = bins["at"].to_numpy()
        model.levels = isotonic(bins["n"].to_numpy(dtype=float) + 0.01, bins["y"].to_numpy() + 0.01 * facts["y"])
    else:
        model.edges, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    ``labels(doc_id, quality)`` gives 0 or 1; rows whose crc32(doc_id) mod 4 is
    2 are held out.  Three in four of the others fit the ridge weights, the
    rest calibrate.  Inputs are statistics of the whole text only.

    Null and empty texts have zeros for statistics and are scored like others.
    Labels that are null or belong to no document are ignored; a document
    labelled several times counts for each.  A null doc_id is never held out
    and never learnt from.  Repeated rows get the same score.  Of several texts
    with one doc_id one is learnt from.  Very
    long texts count whole; an empty table gives no rows; other columns are
    ignored.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialise(texts.mapInArrow(_features, "doc_id bigint, x array<double>"), "statistics")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    known = known.filter(F.col("y").isin(0.0, 1.0) & (remainder != 2))
    # a label's side is the unique one: a repeated document is learnt from once
    train = left_join_unique(known, rows.dropDuplicates(["doc_id"]), ["doc_id"], F.col("y"), "inner", small=False)
    train = materialise(train.withColumn("calibrate", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0), "train")
    model = docs.sparkSession.sparkContext.broadcast(fit(train))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.clip(model.value.score(_matrix(batch)), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    out = rows.mapInArrow(scored, "doc_id bigint, score double")
    return out.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
