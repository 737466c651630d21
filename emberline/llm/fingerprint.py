"""Quartile bucket digests: a locality-sensitive fingerprint of bytes.

Hashed byte triplets are counted in buckets; each bucket is encoded by the quartile its count falls in (two bits), after a
header with the length and the ratios of the quartiles. Two digests are compared by a bounded sum of code differences.

Nulls and odd input: a null text is empty; a text of under three bytes has no triplets and an all-zero body; rows with the
same doc_id are ordered by a hash of their text, null ids come first. One row in the table is its own next document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, shuffle_partitions, small_batches, trimmed

BUCKETS = 256
#: Cost of codes that differ by 0, 1, 2 and 3 quartiles.
COST = np.array([0, 1, 2, 4])
_BITS = BUCKETS.bit_length() - 1


def codes(data: bytes) -> tuple[np.ndarray, int, int]:
    """The quartile code of each bucket, the length byte and the byte of quartile ratios."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    length = min(255, round(16 * math.log2(len(data) + 1) / 2))
    if len(b) < 3:
        return np.zeros(BUCKETS, np.uint8), length, 0
    t = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
    counts = np.bincount(t >> np.uint32(32 - _BITS), minlength=BUCKETS)
    s = np.sort(counts)
    q1, q2, q3 = (int(s[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    ratios = 0 if not q3 else (q1 * 15 // q3) << 4 | q2 * 15 // q3
    return code.astype(np.uint8), length, ratios


def digest(data: bytes) -> str:
    code, length, ratios = codes(data)
    c = code.reshape(-1, 4)
    body = c[:, 0] << 6 | c[:, 1] << 4 | c[:, 2] << 2 | c[:, 3]
    return bytes((length, ratios)).hex() + body.astype(np.uint8).tobytes().hex()


def _read(fp: str) -> tuple[np.ndarray, int, int]:
    raw = np.frombuffer(bytes.fromhex(fp), np.uint8)
    body = raw[2:]
    return np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], 1).ravel(), int(raw[0]), int(raw[1])


def likeness(a: str, b: str) -> float:
    """1 for equal digests, down to 0: the code differences, the header's at most a tenth, as a share of the bound."""
    if a == b:
        return 1.0
    (x, n, r), (y, m, s) = _read(a), _read(b)
    body = int(COST[np.abs(x.astype(np.int8) - y.astype(np.int8))].sum()) / (BUCKETS * 1.5)
    head = min(1.0, abs(n - m) / 64) * 0.05 + (abs((r >> 4) - (s >> 4)) + abs((r & 15) - (s & 15))) / 30 * 0.05
    return max(0.0, 1.0 - min(1.0, body) * 0.9 - head)


_OUT = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())])
_DDL = "part int, kind int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"
ROW, HEAD, TAIL = 0, 1, 2


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _finish(doc_id, text: str, fp: str, next_text: str, next_fp: str) -> tuple:
    edited = edited_text(text, next_text)
    raw = edited.encode()
    efp = fp if edited == text else digest(raw)
    return (doc_id, len(text), hashlib.sha256(raw).hexdigest(), fp, efp, likeness(fp, efp), likeness(fp, next_fp))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_OUT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of one range of ids. The first text and the last one go on, to meet those of other ranges."""
    part = TaskContext.get().partitionId()
    last = None
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            fp = digest(text.encode())
            if last is None:
                out.append((part, HEAD, doc_id, None, None, fp, None, None, None, text))
            else:
                out.append((part, ROW, *_finish(*last, text, fp), None))
            last = doc_id, text, fp
        yield _batch(out)
    if last is not None:
        yield _batch([(part, TAIL, last[0], None, None, last[2], None, None, None, last[1])])


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row is a range's last text with the first text of the next range."""
    for batch in batches:
        yield _batch([(0, ROW, *_finish(r["doc_id"], r["text"], r["fp"], r["next_text"], r["next_fp"]), None) for r in batch.to_pylist()])


def fingerprint_documents(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness; see edited_text.

    Texts are shuffled once, by ranges of (doc_id, hash). The last text of each range meets the first of the next range that
    holds rows by an equi-join on the range's number; the driver sees only which ranges hold rows."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    ranged = src.repartitionByRange(parts or shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    done = materialize(ranged.select("doc_id", "text").mapInArrow(trimmed(_within), _DDL), "fingerprints")
    tails = done.filter(F.col("kind") == TAIL).select("part", "doc_id", "text", F.col("fingerprint").alias("fp"))
    held = sorted(r.part for r in tails.select("part").collect())  # a number for each range
    follows = spark.createDataFrame(list(zip(held, held[1:] + held[:1], strict=True)), "part int, next int")
    heads = done.filter(F.col("kind") == HEAD).select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fp"))
    edges = tails.join(follows, "part").join(heads, "next").mapInArrow(trimmed(_between), _DDL)
    return done.filter(F.col("kind") == ROW).unionByName(edges).drop("part", "kind", "text")
