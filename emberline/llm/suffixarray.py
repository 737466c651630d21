"""Suffix-array deduplication of bytes by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Candidate segments come in groups that fit a task, split by grams of 32, 64 and 100 bytes (see _repeats); equal segments are
one kind, with its multiplicity. Groups are judged many at a time: the segments of all their kinds are joined with
separators, and of the suffix order the Burrows-Wheeler transform and its mapping to longer suffixes are made. From the
interval of the empty string, intervals are extended backwards by one byte, breadth first; the first time an interval ends
at a rank, its length is the common prefix there, so prefixes appear by increasing value. The search stops at WINDOW: ranks
without a value by then share WINDOW bytes or more with their neighbour. Each such set of suffixes is one string; the
earliest start of all its kinds' occurrences stays, all later ones are marked.

Nulls and odd input: null texts are empty; rows equal in id and text are one document and answered alike; a null doc_id is
the last document; rows that share an id are ordered by a hash of their text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._repeats import Bytes, Kind, covered, find_marks, marks_of, source, with_marks
from ._shared import trimmed

WINDOW, GRAMS = 100, (32, 64)
#: Bytes of segments that are judged at once.
GATHER = 256 << 10


def suffix_order(t: np.ndarray, depth: int, levels: list[tuple[int, np.ndarray]] | None = None) -> np.ndarray:
    """Positions of t (from 0) in the order of their suffixes' first depth symbols or more; ties in any order. levels, if
    given, gets (step, rank of each position by its first step symbols) of each round."""
    n = len(t)
    present = np.flatnonzero(np.bincount(t))
    dense = np.zeros(int(t.max()) + 1, np.int64)
    dense[present] = np.arange(len(present))
    bits = max(1, (len(present) - 1).bit_length())
    step = 63 // bits  # symbols that the first sort key packs
    padded = np.r_[dense[t], np.zeros(step, np.int64)]
    key = np.zeros(n, np.int64)
    for i in range(step):
        key = key << bits | padded[i : i + n]
    order = np.argsort(key)
    ordered = key[order]
    differ = ordered[1:] != ordered[:-1]  # of neighbours in the order
    rank = np.empty(n, np.int64)
    each = n.bit_length()  # bits of a rank
    while True:
        new = np.cumsum(np.r_[0, differ])
        done = step >= depth or new[-1] == n - 1
        if done and levels is None:
            return order
        rank[order] = new
        if levels is not None:
            levels.append((step, rank.copy()))
        if done:
            return order
        # only suffixes that are equal so far are sorted again, in the places they have
        tied = np.flatnonzero(np.r_[False, ~differ] | np.r_[~differ, False])
        at = order[tied]
        key = new[tied]
        # a key packs the ranks of as many steps as 63 bits hold, two at least
        for i in range(1, 63 // each):
            ahead = at + i * step
            key = key << each | np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
            if (i + 1) * step >= depth:
                break
        step *= i + 1
        again = np.argsort(key)
        order[tied] = at[again]
        key = key[again]
        beside = np.flatnonzero(tied[1:] == tied[:-1] + 1)
        differ[tied[beside]] = key[beside + 1] != key[beside]


def common_prefixes(t: np.ndarray, order: np.ndarray, stop: int) -> np.ndarray:
    """For each rank but the first, the common prefix with the rank before, by breadth-first backward extension; stop where
    it is stop or more. Symbols are 0 .. max; each 0 ends a string. Exact between suffixes with stop symbols before their 0;
    after a suffix that ends sooner the value can be too high, as strings that hold a 0 are not enumerated. Such a suffix
    sorts before all others it is a prefix of, so that no two longer ones are joined by it."""
    n = len(t)
    counts = np.bincount(t)
    symbols = np.flatnonzero(counts)
    dense = np.zeros(len(counts), np.int64)
    dense[symbols] = np.arange(len(symbols))
    many = len(symbols)
    code = dense[t[order - 1]]  # the transform; of the first suffix the last symbol: t ends with 0
    # where the suffix that is longer by the symbol before stands: suffixes that begin with a symbol keep the order of what follows
    longer = np.empty(n, np.int64)
    longer[np.argsort(code.astype(np.uint8 if many <= 256 else np.uint16), kind="stable")] = np.arange(n)
    lcp = np.full(n + 1, -1, np.int64)
    lcp[: int((t == 0).sum()) + 1] = 0  # separators sort first and differ
    lcp[n] = 0
    lo, hi = np.array([0]), np.array([n])
    for length in range(stop + 1):
        # hi is where an interval of a string of this length ends; its first visit fixes the prefix there
        if length:
            fresh = lcp[hi] < 0
            lo, hi = lo[fresh], hi[fresh]
            lcp[hi] = length - 1
        if not len(lo) or length == stop:
            break
        # where one symbol precedes all suffixes of an interval, it is the only extension
        a, b = longer[lo], longer[hi - 1] + 1
        alone = (code[lo] == code[hi - 1]) & (b - a == hi - lo)
        keep = alone & (code[lo] > 0)
        los, his = [a[keep]], [b[keep]]
        lo, hi = lo[~alone], hi[~alone]
        if len(lo):
            # the symbols before the suffixes of each other interval, and the first place that each leads to
            size = hi - lo
            at = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
            key = np.repeat(np.arange(len(lo)), size) * many + code[at]
            if len(lo) * many <= 4 * len(key):
                each = np.bincount(key, minlength=len(lo) * many)
                first = np.empty(len(each), np.int64)
                first[key[::-1]] = longer[at[::-1]]  # the last to be written is the first of its kind
                found = np.flatnonzero(each)
                a, each = first[found], each[found]
            else:
                by = np.argsort(key)
                found = key[by]
                start = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
                a, each, found = np.minimum.reduceat(longer[at[by]], start), np.diff(np.r_[start, len(by)]), found[start]
            letter = found % many > 0
            los.append(a[letter])
            his.append((a + each)[letter])
        lo, hi = np.concatenate(los), np.concatenate(his)
    out = lcp[:n].copy()
    out[out < 0] = stop
    return out


def judge(window: int):
    def run(kinds: list[Kind]) -> Iterator[tuple[int, int, int, bool]]:
        sizes = np.array([len(k[0]) + 1 for k in kinds])
        base = np.r_[0, np.cumsum(sizes)[:-1]]
        t = np.frombuffer(b"".join(k[0] + b"\0" for k in kinds), np.uint8).astype(np.int64) + 1
        t[base + sizes - 1] = 0
        order = suffix_order(t, window)
        lcp = common_prefixes(t, order, window)
        kind_of = np.repeat(np.arange(len(kinds)), sizes)
        windows, multi = np.array([k[1] for k in kinds]), np.array([k[2] for k in kinds])
        run_id = np.cumsum(lcp < window)
        s = kind_of[order]
        i = order - base[s]
        valid = i < windows[s]
        s, i, run_id = s[valid], i[valid], run_id[valid]
        # equal windows have equal keys, so those of two groups are never equal
        doc_rank = {d: k for k, d in enumerate(sorted({k[3][:2] for k in kinds}))}
        where = np.array([doc_rank[k[3][:2]] << 32 | k[3][2] for k in kinds])[s] + i
        bounds = np.flatnonzero(np.r_[True, run_id[1:] != run_id[:-1]])
        earliest = np.repeat(np.minimum.reduceat(where, bounds), np.diff(np.r_[bounds, len(where)]))
        for rest, chosen in ((False, where != earliest), (True, (where == earliest) & multi[s])):
            marked = np.sort(s[chosen] << 32 | i[chosen])
            if len(marked):
                start = np.flatnonzero(np.r_[True, marked[1:] != marked[:-1] + 1])
                for m, n in zip(marked[start].tolist(), np.diff(np.r_[start, len(marked)]).tolist(), strict=True):
                    yield m >> 32, m & 0xFFFFFFFF, n, rest

    return run


_OUT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _apply(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, marks in zip(batch.column("text").to_pylist(), marks_of(batch), strict=True):
                data = text.encode()
                kept, last, gone = [], 0, 0
                spans = covered(marks, window, len(data))
                for a, b in spans:
                    kept.append(data[last:a])
                    last, gone = b, gone + b - a
                left = b"".join(kept) + data[last:]
                rows.append((len(data), gone, len(spans), hashlib.sha256(left).hexdigest(), left if with_text else None))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_bytes(docs: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): kept is the bytes that stay; they may split a character."""
    src = source(docs)
    marks = find_marks(src.drop("doc_id"), Bytes(window, grams), judge(window), GATHER)
    return with_marks(src, marks).mapInArrow(trimmed(_apply(window, with_text)), _OUT_DDL)


#: Two hexadecimal digits a byte, so that a string of 100 bytes is 200 digits from digit 2 i + 1 on.
ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER w + 100 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM cov) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y, a FROM runs UNION ALL SELECT doc_id, max(b), NULL, max(b) FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN y IS NULL THEN substr(h, 2 * x + 1) ELSE substr(h, 2 * x + 1, 2 * (y - x)) END, '' ORDER BY a, y NULLS LAST) AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
s AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN s.doc_id IS NULL THEN d.h ELSE kept.h END)) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
