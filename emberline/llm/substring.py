"""Substring deduplication by prefix-partitioned suffix trees: words that repeat in windows of 35 are removed everywhere.

Suffixes (word positions) are split by prefixes of variable length into groups that fit a task: grams of 16 words, of 28 and
of 35 where a shorter one would group too many (see _repeats). Of each batch of groups the suffixes are sorted by ranks of
growing prefixes, and common prefixes of neighbours are read off those ranks: the leaves of the subtree in order, and the
depths of its internal nodes. Leaves below an internal node of depth 35 or more repeat, and so does a leaf that stands for
several occurrences. Equal segments enter the tree once, with their multiplicity.

Nulls and odd input: null texts have no words; rows equal in id and text are one document and answered alike; a null doc_id
is a document; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._repeats import Kind, Words, covered, find_marks, marks_of, source, with_marks
from ._shared import trimmed
from .suffixarray import suffix_order

WINDOW, GRAMS = 35, (16, 28)


def common_prefixes(levels: list[tuple[int, np.ndarray]], t: np.ndarray, p: np.ndarray, q: np.ndarray, stop: int) -> np.ndarray:
    """Common prefix of the suffixes at p and at q, up to stop or a little more. levels: (step, rank of each position by its
    first step symbols), ascending."""
    n = len(t)
    depth = np.zeros(len(p), np.int64)
    for step, rank in [*levels[::-1], (1, t)]:
        live = np.flatnonzero(depth < stop)
        while len(live):
            a, b = p[live] + depth[live], q[live] + depth[live]
            inside = (a < n) & (b < n)
            live, a, b = live[inside], a[inside], b[inside]
            live = live[rank[a] == rank[b]]
            depth[live] += step
            live = live[depth[live] < stop]
    return depth


def judge(window: int):
    def run(kinds: list[Kind]) -> Iterator[tuple[int, int, int, bool]]:
        number = defaultdict(count(1).__next__)
        texts = [[number[w] for w in k[0].split(b" ")] for k in kinds]
        sizes = np.array([len(x) + 1 for x in texts])
        base = np.r_[0, np.cumsum(sizes)[:-1]]
        t = np.array([x for words in texts for x in (*words, 0)], np.int64)
        windows, multi = np.array([k[1] for k in kinds]), np.array([k[2] for k in kinds])
        levels: list[tuple[int, np.ndarray]] = []
        order = suffix_order(t, window, levels)
        kind_of = np.repeat(np.arange(len(kinds)), sizes)
        order = order[order - base[kind_of[order]] < windows[kind_of[order]]]  # leaves of whole windows
        node = np.cumsum(np.r_[0, common_prefixes(levels, t, order[:-1], order[1:], window) < window])
        k = kind_of[order]
        repeated = np.bincount(node, 1 + multi[k])[node] > 1
        marked = np.sort(order[repeated])
        if not len(marked):
            return
        k, i = kind_of[marked], marked - base[kind_of[marked]]
        start = np.flatnonzero(np.r_[True, (np.diff(marked) != 1) | (np.diff(k) != 0)])
        lengths = np.diff(np.r_[start, len(marked)])
        for a, b, m in zip(k[start].tolist(), i[start].tolist(), lengths.tolist(), strict=True):
            yield a, b, m, False

    return run


_OUT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _apply(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, marks in zip(batch.column("text").to_pylist(), marks_of(batch), strict=True):
                words = text.encode().split()
                kept, last, gone = [], 0, 0
                for a, b in covered(marks, window, len(words)):
                    kept += words[last:a]
                    last, gone = b, gone + b - a
                left = b" ".join(kept + words[last:])
                rows.append((len(words), gone, hashlib.sha256(left).hexdigest(), left.decode() if with_text else None))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def dedup_words(docs: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): kept is the text of the words that stay, joined by spaces."""
    src = source(docs)
    marks = find_marks(src.drop("doc_id"), Words(window, grams), judge(window))
    return with_marks(src, marks).mapInArrow(trimmed(_apply(window, with_text)), _OUT_DDL)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
pos AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM w),
a AS (SELECT pos.doc_id, count(*) AS n, count(cov.j) AS gone, string_agg(word, ' ' ORDER BY pos.j) FILTER (WHERE cov.j IS NULL) AS kept FROM pos LEFT JOIN cov ON cov.doc_id = pos.doc_id AND cov.j = pos.j GROUP BY pos.doc_id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN a USING (doc_id)
"""
