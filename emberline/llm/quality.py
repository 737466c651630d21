"""Quality classifier by compression: two zstandard dictionaries, built from good and from bad labelled text.

A text, in lower case, is cut into blocks of BLOCK bytes, and each block is compressed under both dictionaries. The
difference of the two total sizes over their sum, one number per whole text, becomes a probability by logistic calibration
on labelled rows that the dictionaries have not seen.

Learning reads a bounded number of labelled rows (SAMPLE_ROWS of each class for the dictionaries and as many for the
calibration, chosen by a hash of doc_id), always their whole texts, and on the executors: the driver gets two dictionaries
of DICT_BYTES and a number for each row of the calibration.

Nulls and odd input: null and empty texts get the score of a difference of zero; labels that are null are ignored, the
lowest of repeated labels counts, and the least of the texts that share a labelled doc_id; without rows of both labels each
score is the share of label 1, or 0.5 without labels. A null doc_id is not held out. Repeated rows are scored alike; other
columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Scratch, materialize, quoted, small_batches, trimmed

FOLDS = 5
SAMPLE_ROWS = 2000
DICT_BYTES = 64 << 10
BLOCK = 256
LEVEL = 1
THRESHOLD = 0.3


def prepared(text: str | None) -> bytes:
    return (text or "").lower().encode()


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the logistic curve over the size difference; without dictionaries only the prior."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def scorer(self):
        if not self.good:
            return lambda text: 1 / (1 + math.exp(-self.intercept))
        good, bad = compressors((self.good, self.bad))

        def score(text: str | None) -> float:
            z = self.slope * size_difference(prepared(text), good, bad) + self.intercept
            return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

        return score


def size_difference(data: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    g = b = 0
    for i in range(0, max(1, len(data)), BLOCK):
        block = data[i : i + BLOCK]
        g += len(good.compress(block))
        b += len(bad.compress(block))
    return (b - g) / (b + g)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a weak ridge so that separable data stay finite."""
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        grad = design.T @ (y - p) - 0.05 * w * (1, 0)
        hess = design.T @ (design * (p * (1 - p))[:, None]) + np.diag([0.05, 1e-6])
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    dicts = [zstandard.ZstdCompressionDict(d) for d in dictionaries]
    for d in dicts:
        d.precompute_compress(level=LEVEL)
    return [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False) for d in dicts]


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of the blocks of all texts; empty if they are too few."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, [b for t in texts for b in blocks(t)]).as_bytes()
    except zstandard.ZstdError:
        return b""


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _learn(table: pa.Table) -> pa.Table:
    """One label's rows: its dictionary."""
    rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))
    return pa.table({"label": pa.array([table.column("label")[0].as_py()], pa.int32()), "found": pa.array([dictionary([prepared(t) for _, t in rows])], pa.binary())})


def _differences(dictionaries: tuple[bytes, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = compressors(dictionaries)
        for batch in batches:
            x = pa.array([size_difference(prepared(t), good, bad) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), x], names=["doc_id", "label", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows outside fold 0: folds from 2 on make the dictionaries, fold 1 the calibration."""
    small_batches(docs.sparkSession)
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
    known = known.withColumn("part", F.when(fold(F.col("doc_id")) == 1, 1).when(fold(F.col("doc_id")) > 1, 0)).filter("part IS NOT NULL")
    picked = []
    for label in (0, 1):
        for part in (0, 1):
            own = known.filter((F.col("label") == label) & (F.col("part") == part))
            picked += own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).collect()
    if not picked:
        return Model(b"", b"", 0.0, 0.0)
    with Scratch():
        return _fitted(docs, docs.sparkSession.createDataFrame(picked, known.schema))  # 4 x SAMPLE_ROWS rows of ids at most


def _fitted(docs: DataFrame, sample: DataFrame) -> Model:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = materialize(texts.groupBy("doc_id", "label", "part").agg(F.min("text").alias("text")), "labelled")
    found = rows.groupBy("part", "label").agg(F.count("*").alias("n")).collect()  # 4 rows at most
    share = (sum(r.n for r in found if r.label) + 0.5) / (sum(r.n for r in found) + 1)
    prior = Model(b"", b"", 0.0, math.log(share / (1 - share)))
    if len(found) < 4:
        return prior
    made = dict(rows.filter("part = 0").groupBy("label").applyInArrow(_learn, "label int, found binary").collect())
    good, bad = bytes(made[1]), bytes(made[0])
    if not good or not bad:
        return prior
    measured = sorted(map(tuple, rows.filter("part = 1").mapInArrow(trimmed(_differences((good, bad))), "doc_id long, label int, x double").collect()))
    return Model(good, bad, *_logistic(np.array([x for _, _, x in measured]), np.array([q for _, q, _ in measured], float)))


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = pa.array([score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("rest"), scores], names=["rest", "score"])

    return run


def score_documents(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a column of that name, which replaces another: how likely label 1 is."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != name]
    packed = docs.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("rest"), "text")
    scored = packed.mapInArrow(trimmed(_scorer(model)), T.StructType([packed.schema["rest"], T.StructField("score", T.DoubleType())]))
    return scored.select(*[F.col(f"rest.{quoted(c)}").alias(c) for c in kept], F.col("score").alias(name))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    scored = score_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that are not rejected."""
    name = "_" * (1 + max(map(len, docs.columns))) + "good"  # longer than any other name
    return score_documents(docs, fit(docs, labels), name).filter(F.col(name) >= THRESHOLD).drop(name)
