"""Where windows of W units (words or bytes) repeat: a candidate search that misses nothing, shared by the exact
substring operators, which judge the groups it finds by their own structures.

Every window is keyed by the smallest hash of the grams inside it, so that equal windows have equal keys, and neighbouring
windows mostly share one: a run. A key stands for a suffix, the one that starts at its gram, and the gram for that suffix's
prefix. Keys that occur once drop out. The text of a run is a segment; equal segments of a key are one kind, which is cut
from its first occurrence and stands for all of them with its multiplicity.

Kinds are grouped by key, and a group is judged in one piece. Grams have variable length: a key of more than LIMIT kinds is
split by the next longer gram, of those kinds' segments, until the group fits; the last gram is as long as the window, and
a group of it has a single kind. Each group of any gram is judged by the same structure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import discard, materialize, shuffle_partitions, small_batches, trimmed

#: Kinds of a group; one of more is split by a longer gram.
LIMIT = 4000
#: Segments (bytes) that a task gathers before it judges them; a single group may be larger, up to LIMIT kinds.
GATHER = 4 << 20
BROADCAST_ROWS = 100_000
_LAST = 2**63 - 1
_P = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1


class Bytes:
    """Units are bytes. grams: ascending, shorter than the window; the window itself comes last."""

    def __init__(self, window: int, grams: tuple[int, ...]):
        self.window, self.grams = window, (*grams, window)

    def sequence(self, text: str) -> bytes:
        return text.encode()

    def numbers(self, data: bytes) -> np.ndarray:
        """A number for each unit of encoded text."""
        return np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)

    def cut(self, seq: bytes, a: int, b: int) -> bytes:
        return seq[a:b]


class Words(Bytes):
    """Units are words, split at ASCII white space."""

    def __init__(self, window: int, grams: tuple[int, ...]):
        super().__init__(window, grams)
        self.known: dict[bytes, int] = {}

    def sequence(self, text: str) -> list[bytes]:
        return text.encode().split()

    def numbers(self, data: bytes) -> np.ndarray:
        words, known = data.split(), self.known
        if len(known) > 400_000:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.array([known[w] for w in words], np.uint64)

    def cut(self, seq: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(seq[a:b])


def gram_hashes(u: np.ndarray, k: int) -> np.ndarray:
    """Mixed polynomial hashes of k consecutive units."""
    h, n, p = u, 1, _P  # h: of n units, p: the multiplier's n-th power
    for bit in bin(k)[3:]:
        h, n, p = h[:-n] * np.uint64(p) + h[n:], n * 2, p * p & _M64
        if bit == "1":
            h, n, p = h[:-1] * np.uint64(_P) + u[n:], n + 1, p * _P & _M64
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(h: np.ndarray, span: int) -> np.ndarray:
    n = 1
    while n * 2 <= span:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    return np.minimum(h[: len(h) - (span - n)], h[span - n :]) if span > n else h


def runs_of(u: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(key, segment's hash, first window, number of windows, may repeat itself) of each run."""
    if len(u) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(bool)
    g, span = gram_hashes(u, gram), window - gram + 1
    m = sliding_min(g, span)
    a = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
    b = np.r_[a[1:], len(m)]
    own = np.zeros(len(a), bool)
    ordered = np.sort(g)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):  # only a gram that the text holds twice can lie twice in a run
        doubt = np.flatnonzero(np.isin(m[a], twice))
        reach = np.arange(span)
        left = a[doubt] + g[a[doubt][:, None] + reach].argmin(1)
        right = b[doubt] - 1 + span - 1 - g[(b[doubt] - 1)[:, None] + reach[::-1]].argmin(1)
        own[doubt] = left != right
    # a run around one gram is no longer than its first and last window
    w = gram_hashes(u, window)
    same = (w[a] * np.uint64(3) + (b - a).astype(np.uint64)) * np.uint64(_P) ^ w[b - 1]
    for i in np.flatnonzero(own).tolist():
        same[i] = xxhash.xxh3_64_intdigest(u[a[i] : b[i] + window - 1].tobytes())
    return m[a].view(np.int64), same.view(np.int64), a, b - a, own


def _fields(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in map(str.split, ddl.split(", "))])


_RUNS_DDL = "key long, same long, ord long, tie long, a int, n int, own boolean"
_KINDS_DDL = "key long, same long, ord long, tie long, a int, n int, own boolean, multi boolean, hot boolean, seg binary"
_SUB_DDL = "up_key long, up_same long, off int, key long, same long, ord long, tie long, a int, n int, own boolean, multi boolean, seg binary"
_VERDICTS_DDL = "key long, same long, i int, m int, rest boolean, ord long, tie long, a int"
_RUNS, _KINDS, _SUB, _VERDICTS = map(_fields, (_RUNS_DDL, _KINDS_DDL, _SUB_DDL, _VERDICTS_DDL))


def _columns(cols: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _find_runs(units: Bytes, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords, ties = batch.column("ord").to_pylist(), batch.column("tie").to_pylist()
            parts = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                key, same, a, n, own = runs_of(units.numbers(text.encode()), units.window, gram)
                if len(key):
                    parts.append((key, same, np.full(len(key), ords[i]), np.full(len(key), ties[i]), a.astype(np.int32), n.astype(np.int32), own))
            if parts:
                yield _columns([np.concatenate(c) for c in zip(*parts, strict=True)], _RUNS)

    return run


def _cut_kinds(units: Bytes):
    """Of texts with the kinds that first occur in them: each kind with its segment."""
    w, names = units.window, ("key", "same", "a", "n", "own", "multi", "hot")

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("kinds")
        flat = lists.flatten()
        col = {x: flat.field(x).to_numpy(zero_copy_only=False) for x in names}
        counts = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(counts)), counts)
        ords, ties = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("ord", "tie"))
        starts, stops = col["a"].tolist(), (col["a"] + col["n"] + w - 1).tolist()
        segs, first = [], 0
        for text, end in zip(batch.column("text").to_pylist(), np.cumsum(counts).tolist(), strict=True):
            seq = units.sequence(text)
            segs += [units.cut(seq, starts[j], stops[j]) for j in range(first, end)]
            first = end
        return _columns([col["key"], col["same"], ords[row], ties[row], col["a"], col["n"], *(col[x].astype(bool) for x in ("own", "multi", "hot")), segs], _KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                yield part(pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(lo, 128)]) for c in batch.columns], names=batch.schema.names))

    return run


def _split_kinds(units: Bytes, gram: int):
    """The runs, by that gram, of the segments of kinds."""
    w = units.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for up_key, up_same, o, t, at, multi, seg in zip(*(batch.column(c).to_pylist() for c in ("key", "same", "ord", "tie", "a", "multi", "seg")), strict=True):
                seq = seg if type(units) is Bytes else seg.split(b" ")
                for key, same, a, n, own in zip(*(x.tolist() for x in runs_of(units.numbers(seg), w, gram)), strict=True):
                    rows.append((up_key, up_same, a, key, same, o, t, at + a, n, own, multi, units.cut(seq, a, a + n + w - 1)))
                if len(rows) > 20_000:
                    yield _columns(list(zip(*rows, strict=True)), _SUB)
                    rows = []
            if rows:
                yield _columns(list(zip(*rows, strict=True)), _SUB)

    return run


#: A kind: its segment, its windows, whether it has more than one occurrence, and the first (ord, tie, a).
Kind = tuple[bytes, int, bool, tuple[int, int, int]]
#: Judges whole groups of kinds at once: (kind's number, first window, windows, rest) of what repeats; rest: its first
#: occurrence is the earliest of all and only the others count.
Judge = Callable[[list[Kind]], Iterator[tuple[int, int, int, bool]]]


def _judge_groups(judge: Judge, gather: int):
    """Rows come sorted by key. Gathers whole groups up to gather bytes and lets judge look at them."""

    def flush(names: list[tuple[int, int]], kinds: list[Kind]) -> pa.RecordBatch:
        rows = [(*names[k], i, m, rest, *(kinds[k][3] if rest else (None, None, None))) for k, i, m, rest in judge(kinds)] if kinds else []
        return _columns(list(zip(*rows, strict=True)) or [()] * len(_VERDICTS), _VERDICTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple[int, int]] = []
        kinds: list[Kind] = []
        size, key, now = 0, None, {}

        def close() -> int:
            if len(now) > 1 or any(own or k[2] for own, k in now.values()):
                names.extend((key, same) for same in now)
                kinds.extend(k for _, k in now.values())
                return sum(len(k[0]) for _, k in now.values())
            return 0

        for batch in batches:
            plain = [batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("key", "same", "ord", "tie", "a", "n", "own", "multi")]
            for k, same, o, t, a, n, own, multi, seg in zip(*plain, batch.column("seg").to_pylist(), strict=True):
                if k != key:
                    size += close()
                    key, now = k, {}
                    if size > gather:
                        yield flush(names, kinds)
                        names, kinds, size = [], [], 0
                now[same] = (own, (seg, n, multi, (o, t, a)))
        close()
        yield flush(names, kinds)

    return run


_WHERE = ("ord", "tie", "a")


def _hot(kinds: DataFrame) -> DataFrame:
    """kinds with hot: whether their key has more than LIMIT of them."""
    hot = materialize(kinds.groupBy("key").agg(F.count("*").alias("d")).filter(F.col("d") > LIMIT).select("key", F.lit(True).alias("hot")), "repeat-hot")
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    return kinds.drop("hot").join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


def _verdicts(kinds: DataFrame, units: Bytes, judge: Judge, gather: int, level: int = 0) -> DataFrame:
    """Verdicts on kinds, grouped by grams of that level; hot ones by longer grams."""
    light = kinds.filter(~F.col("hot")).repartition(shuffle_partitions(kinds.sparkSession), "key").sortWithinPartitions("key")
    judged = materialize(light.mapInArrow(trimmed(_judge_groups(judge, gather)), _VERDICTS_DDL), "repeat-verdicts")
    hot = kinds.filter("hot").drop("hot")
    if level + 1 == len(units.grams) or hot.isEmpty():
        return judged
    sub = materialize(hot.repartition(shuffle_partitions(kinds.sparkSession)).mapInArrow(trimmed(_split_kinds(units, units.grams[level + 1])), _SUB_DDL), "repeat-split")
    where = F.struct(*_WHERE)
    again = sub.groupBy("key", "same", "seg").agg(F.min(where).alias("first"), F.max(where).alias("last"), F.max("n").alias("n"), F.max("own").alias("own"), F.max("multi").alias("multi"))
    again = materialize(again.select("key", "same", "first.*", "n", "own", (F.col("multi") | (F.col("first") != F.col("last"))).alias("multi"), F.lit(False).alias("hot"), "seg"), "repeat-kinds")
    if level + 2 < len(units.grams):
        again = materialize(_hot(again), "repeat-kinds")
    found = _verdicts(again, units, judge, gather, level + 1).withColumnsRenamed({c: f"v_{c}" for c in (*_WHERE, "key", "same")})
    met = sub.drop("n", "own", "multi", "seg").join(found, (F.col("key") == F.col("v_key")) & (F.col("same") == F.col("v_same")))
    rest = F.col("rest") & (F.col("ord") == F.col("v_ord")) & (F.col("tie") == F.col("v_tie")) & (F.col("a") == F.col("v_a"))
    back = met.withColumn("rest", rest).select(
        F.col("up_key").alias("key"), F.col("up_same").alias("same"), (F.col("off") + F.col("i")).alias("i"), "m", "rest",
        F.when(rest, F.col("ord")).alias("ord"), F.when(rest, F.col("tie")).alias("tie"), F.when(rest, F.col("a") - F.col("off")).alias("a"),
    )
    return judged.unionByName(materialize(back, "repeat-verdicts"))


def find_marks(docs: DataFrame, units: Bytes, judge: Judge, gather: int = GATHER) -> DataFrame:
    """(ord, tie, a, b): windows a .. b-1 of a document (ord, tie, text) that repeat, as judge says."""
    small_batches(docs.sparkSession)
    runs = materialize(docs.mapInArrow(trimmed(_find_runs(units, units.grams[0])), _RUNS_DDL), "repeat-runs")
    # written, so that the join reads plain exchanges, of which adaptive execution can split those of common keys
    keys = materialize(runs.groupBy("key").agg(F.count("*").alias("c"), F.max("own").alias("any_own")).filter("c > 1 OR any_own").select("key"), "repeat-keys")
    found = materialize(runs.join(keys, "key"), "repeat-found")
    discard(runs)
    discard(keys)
    where = F.struct(*_WHERE)
    kinds = found.groupBy("key", "same").agg(F.min(where).alias("first"), F.max(where).alias("last"), F.max("n").alias("n"), F.max("own").alias("own"))
    kinds = materialize(kinds.select("key", "same", "first.*", "n", "own", (F.col("first") != F.col("last")).alias("multi")), "repeat-kinds")
    per = _hot(kinds).groupBy("ord", "tie").agg(F.collect_list(F.struct("key", "same", "a", "n", "own", "multi", "hot")).alias("kinds"))
    cut = docs.join(per.hint("shuffle_hash"), ["ord", "tie"]).select("ord", "tie", "text", "kinds").mapInArrow(trimmed(_cut_kinds(units)), _KINDS_DDL)
    segments = materialize(cut, "repeat-segments")
    discard(kinds)
    verdicts = _verdicts(segments, units, judge, gather).withColumnsRenamed({c: f"v_{c}" for c in _WHERE})
    other = ~F.col("rest") | (F.col("ord") != F.col("v_ord")) | (F.col("tie") != F.col("v_tie")) | (F.col("a") != F.col("v_a"))
    start = (F.col("a") + F.col("i")).cast("long")
    out = materialize(found.join(verdicts, ["key", "same"]).filter(other).select("ord", "tie", start.alias("a"), (start + F.col("m")).alias("b")), "repeat-marks")
    discard(segments)
    discard(found)
    return out


def marks_of(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int]]]:
    """The marks (a, b) of each row, in order."""
    lists = batch.column("marks")
    flat = lists.flatten()
    pairs = list(zip(*(flat.field(c).to_numpy(zero_copy_only=False).tolist() for c in ("a", "b")), strict=True))
    at = 0
    for n in pc.fill_null(pc.list_value_length(lists), 0).to_pylist():
        yield sorted(pairs[at : at + n]) if n else []
        at += n


def covered(marks: list[tuple[int, int]], window: int, n: int) -> list[tuple[int, int]]:
    """Disjoint unit ranges, in order, that the marked windows (a .. b-1, in order) cover."""
    out: list[list[int]] = []
    for a, b in marks:
        end = min(n, b + window - 1)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([a, end])
    return [(a, b) for a, b in out]


def source(docs: DataFrame) -> DataFrame:
    """(ord, tie, text, doc_id): null ids come last, null texts are empty; rows equal in id and text are one document."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("ord"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id")).select("ord", F.xxhash64("text").alias("tie"), "text", "doc_id")


def with_marks(src: DataFrame, marks: DataFrame) -> DataFrame:
    per = marks.groupBy("ord", "tie").agg(F.collect_list(F.struct("a", "b")).alias("marks"))
    return src.join(per.hint("shuffle_hash"), ["ord", "tie"], "left").select("doc_id", "text", "marks")
