"""Sequence packing by non-negative least squares over a histogram of piece lengths.

Documents become token ids with a closing id 1, cut at every WINDOW ids. The lengths of all pieces make a histogram of
WINDOW entries at most, the only thing the driver sees. In bins of BIN ids, all combinations of up to DEPTH bins that fill
a window exactly are enumerated, and non-negative least squares (Lawson and Hanson) finds how often to repeat each against
the histogram. Rounded repeats become patterns of exact lengths; what is left is packed greedily, first by patterns that
fill a window to FILL, then end to end, cut where a window ends. A plan is therefore a list of rank ranges per length.

Each piece carries its rank among the pieces of its length in its own task, and the tasks' counts give the ranks' starts,
so that no length, however common, has to be sorted or counted in one place.

Nulls and odd input: a null text is empty (its only id is 1); repeated rows are packed each; a null doc_id is kept as null;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from typing import TypeVar
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialize, small_batches, trimmed

WINDOW, DEPTH, BIN, FILL = 2048, 3, 8, 0.99
END_ID = 1
T = TypeVar("T")
LONG_WORD = 48
#: Letter words that a worker keeps (about 200 bytes each), and characters that it encodes at once.
KEPT, BATCH_CHARS = 200_000, 6 << 20
OUT_ROWS = 2000
BROADCAST_ROWS = 1_000_000


def _byte_level() -> dict[int, str]:
    """The usual characters of bytes: visible ones stand for themselves, the others for 256, 257, ..."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LEVEL = _byte_level()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, many at a time. The tokenizer splits at white space, so each different word of a batch is encoded once
    and its ids are gathered wherever it stands. Lower-case letter words, which words share, are kept from batch to batch:
    KEPT at most, in two generations, of which the old one goes when the young one is full."""

    def __init__(self, path: str, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code, self.dtype = ("H", "<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("I", "<u4")
        self.half, self.letters, self.old = max(1, kept // 2), {}, {}

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_model(self, word: str) -> bytes:
        """What the tokenizer's other steps make of lower-case letters in composed form: each byte as a character."""
        if not word.isascii():
            if not word.isalpha() or not is_normalized("NFC", word):
                return self._ids(word)
            word = word.encode().decode("latin-1").translate(BYTE_LEVEL)
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _of_letters(self, word: str) -> bytes:
        ids = self.letters.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None:
                ids = self._of_model(word)
            if len(self.letters) >= self.half:
                self.letters, self.old = {}, self.letters
            self.letters[word] = ids
        return ids

    def _of_word(self, word: str) -> bytes:
        # a run of letters is a unit of its own, in either case; a final sigma's lower case depends on its place
        if len(word) > LONG_WORD or "\u03a3" in word:
            return self._ids(word)
        if word.isalpha():
            return self._of_letters(word.lower())
        if word and word[-1] in ".," and word[:-1].isalpha():
            return self._of_letters(word[:-1].lower()) + self._of_letters(word[-1])
        return self._ids(word)

    def _of_words(self, words: pa.LargeStringArray) -> list[bytes]:
        """The ids of different words. ASCII letters, with a full stop or comma after them or not, are by far the most; they
        are put in lower case together, so that each letter word is looked up once."""
        dot, comma = pc.ends_with(words, "."), pc.ends_with(words, ",")
        marked = pc.or_(dot, comma)
        core = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        plain = pc.and_(pc.ascii_is_alpha(core), pc.less_equal(pc.binary_length(core), LONG_WORD))
        odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        low = pc.ascii_lower(core.filter(plain)).dictionary_encode()
        letters = list(map(self._of_letters, low.dictionary.to_pylist()))
        ends = [b"", self._of_letters("."), self._of_letters(",")]
        mark = pc.add(pc.cast(dot, pa.int8()), pc.multiply(pc.cast(comma, pa.int8()), pa.scalar(2, pa.int8()))).filter(plain)
        out = [letters[i] + ends[k] if k else letters[i] for i, k in zip(low.indices.to_pylist(), mark.to_pylist(), strict=True)]
        if not len(odd):
            return out
        every: list[bytes] = [b""] * len(words)
        for i, ids in zip(np.flatnonzero(plain.to_numpy(zero_copy_only=False)).tolist(), out, strict=True):
            every[i] = ids
        for i, w in zip(odd.tolist(), words.take(pa.array(odd)).to_pylist(), strict=True):
            every[i] = self._of_word(w)
        return every

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. ASCII white space ends a word for the tokenizer too; other spaces are left to it."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        found = words.flatten().dictionary_encode()
        each = self._of_words(found.dictionary)
        size = np.dtype(self.dtype).itemsize
        lengths = np.fromiter(map(len, each), np.int64, len(each)) // size
        starts = np.r_[0, np.cumsum(lengths)[:-1]] if len(each) else lengths
        ids = np.frombuffer(b"".join(each), self.dtype)
        word = found.indices.to_numpy()
        n = lengths[word]
        ends = np.r_[0, np.cumsum(n)]
        out = ids[np.repeat(starts[word] - ends[:-1], n) + np.arange(ends[-1])]
        at = ends[words.offsets.to_numpy()].tolist()
        return [out[a:b] for a, b in zip(at, at[1:], strict=False)]

    def batches(self, rows: Iterator[tuple[T, str | None]]) -> Iterator[tuple[T, np.ndarray]]:
        """The ids of each row's text in turn, encoded in batches of about BATCH_CHARS characters."""
        keys, now, size = [], [], 0
        for key, t in rows:
            keys.append(key)
            now.append(t or "")
            size += len(now[-1])
            if size >= BATCH_CHARS:
                yield from zip(keys, self.encode(now), strict=True)
                keys, now, size = [], [], 0
        yield from zip(keys, self.encode(now), strict=True)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_PIECES = pa.schema([("chunk", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("rank", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
_PIECES_DDL = "chunk int, doc_id long, start long, length int, doc_tokens long, rank long, crc long, ids binary"


def _tokenize(path: str, window: int, keep_all: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, chunk, ranks = encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        closing = np.array([END_ID], words.dtype)
        wide = words.dtype == "<u4"
        texts = (row for batch in batches for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True))
        out = []
        for doc_id, found in words.batches(texts):
            ids = np.concatenate((found, closing))
            for start in range(0, len(ids), window):
                piece = ids[start : start + window]
                n = len(piece)
                crc = zlib.crc32(piece.tobytes() if wide else piece.astype("<u4").tobytes())
                out.append((chunk, doc_id, start, n, len(ids), ranks[n], crc, piece.tobytes() if keep_all or n < window else None))
                ranks[n] += 1
            if len(out) >= OUT_ROWS:
                yield _rows(out)
                out = []
        yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [()] * len(_PIECES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECES, strict=True)], schema=_PIECES)


def combinations(total: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Descending tuples of at most depth positive bins that sum to total."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], rest: int, most: int) -> None:
        if rest == 0:
            out.append(head)
        elif len(head) == depth - 1:
            if rest <= most:
                out.append((*head, rest))
        else:
            for b in range(min(rest, most), 0, -1):
                extend((*head, b), rest - b, b)

    extend((), total, total)
    return out


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that minimises |A x - target|, column j of A counting the entries of columns[j] (bins from 1)."""
    scale = float(target.max()) or 1.0
    b = target / scale
    width = max(map(len, columns))
    at = np.array([(*c, *[0] * (width - len(c))) for c in columns])  # row 0 stands for no bin
    x, active = np.zeros(len(columns)), []
    dense = np.zeros((len(b) + 1, 0))
    for _ in range(rounds):
        rest = np.r_[0.0, b - (dense[1:] @ x[active] if active else 0)]
        gain = rest[at].sum(1)
        gain[active] = -1
        j = int(gain.argmax())
        if gain[j] <= 1e-9:
            break
        active.append(j)
        column = np.zeros((len(b) + 1, 1))
        np.add.at(column[:, 0], at[j], 1)
        dense = np.hstack([dense, column])
        while True:
            a = dense[1:]
            s = np.linalg.solve(a.T @ a + 1e-10 * np.eye(len(active)), a.T @ b)
            if (s > 0).all():
                x[active] = s
                break
            now = x[active]
            low = s <= 0
            step = (now[low] / (now[low] - s[low])).min()
            now = np.maximum(0, now + step * (s - now))
            now[low & (now < 1e-12)] = 0
            keep = [i for i, v in enumerate(now) if v > 0]
            x[active] = now
            active = [active[i] for i in keep]
            dense = dense[:, keep]
            if not active:
                break
    return x * scale


def patterns(counts: dict[int, int], window: int = WINDOW, bin_width: int = BIN, depth: int = DEPTH, fill: float = FILL) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """((lengths, repeats), ...) of sequences of whole pieces, and the counts that no pattern takes."""
    left = {n: c for n, c in counts.items() if c}
    made: list[tuple[tuple[int, ...], int]] = []
    if full := left.pop(window, 0):
        made.append(((window,), full))
    bins: dict[int, list[int]] = defaultdict(list)
    for n in sorted(left, reverse=True):
        bins[-(-n // bin_width)].append(n)
    total = window // bin_width
    usable = [c for c in combinations(total, depth) if all(b in bins for b in c)]
    if usable:
        target = np.zeros(total)
        for b, lengths in bins.items():
            target[b - 1] = sum(left[n] for n in lengths)
        repeats = np.rint(nnls(usable, target)).astype(int)
        for j in np.argsort(-repeats, kind="stable"):
            more = int(repeats[j])
            while more > 0:
                taken: list[int] = []
                for b in usable[j]:
                    if (n := next((n for n in bins[b] if left[n] > taken.count(n)), None)) is None:
                        break
                    taken.append(n)
                if len(taken) < len(usable[j]):
                    break
                k = min(more, *(left[n] // taken.count(n) for n in taken))
                made.append((tuple(taken), k))
                more -= k
                for n in taken:
                    left[n] -= k
    lengths = sorted((n for n in left if left[n]), reverse=True)
    for first in lengths:
        while left[first]:
            gap, use = window - first, {first: 1}
            for n in lengths:
                if n <= gap and (k := min(left[n] - use.get(n, 0), gap // n)) > 0:
                    use[n] = use.get(n, 0) + k
                    gap -= n * k
            if gap > window * (1 - fill):
                break
            k = min(left[n] // u for n, u in use.items())
            made.append((tuple(n for n, u in use.items() for _ in range(u)), k))
            for n, u in use.items():
                left[n] -= u * k
    return made, {n: c for n, c in left.items() if c}


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows (length, first rank, sequence, offset, tape): from that rank on, pieces of that length go to successive
    sequences at that offset, or, where tape is 1, end to end from position offset of the tape that starts at sequence."""
    made, rest = patterns(counts, window)
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for lengths, k in made:
        at = 0
        for n in lengths:
            rows.append((n, taken[n], sequence, at, 0))
            taken[n] += k
            at += n
        sequence += k
    at = 0
    for n in sorted(rest, reverse=True):
        rows.append((n, taken[n], sequence, at, 1))
        at += n * rest[n]
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


_PLACED = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
_PLACED_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _place(rows: np.ndarray, window: int, with_ids: bool, path: str):
    base = rows[:, 0] << 44 | rows[:, 1]
    schema = pa.schema([*_PLACED, ("ids", pa.binary())] if with_ids else _PLACED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = None
        for batch in batches:
            if not batch.num_rows:
                continue
            dtype = dtype or encoder(path).dtype
            col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("start", "length", "doc_tokens", "rank", "crc")}
            n = col["length"].astype(np.int64)
            run_of = rows[np.searchsorted(base, n << 44 | col["rank"], "right") - 1]
            nth = col["rank"] - run_of[:, 1]
            tape = run_of[:, 4] == 1
            position = run_of[:, 3] + np.where(tape, nth * n, 0)
            sequence = run_of[:, 2] + np.where(tape, position // window, nth)
            offset = np.where(tape, position % window, position)
            cut = np.nonzero(offset + n > window)[0]
            first = n.copy()
            first[cut] = window - offset[cut]
            crc = col["crc"].copy()
            ids = batch.column("ids")
            tails = []
            for i in cut.tolist():
                piece = np.frombuffer(ids[i].as_py(), dtype).astype("<u4")
                c = int(first[i])
                crc[i] = zlib.crc32(piece[:c].tobytes())
                tails.append(zlib.crc32(piece[c:].tobytes()))
            parts = [(np.arange(len(n)), col["start"], first, crc, sequence, offset), (cut, (col["start"] + first)[cut], (n - first)[cut], np.array(tails, np.int64), sequence[cut] + 1, np.zeros(len(cut), np.int64))]
            for k, (at, start, length, check, seq, off) in enumerate(parts):
                if len(at):
                    arrays = [batch.column("doc_id").take(pa.array(at)), pa.array(start), pa.array(length), pa.array(check), pa.array(col["doc_tokens"][at]), pa.array(seq), pa.array(off)]
                    if with_ids:
                        whole = [np.frombuffer(ids[int(i)].as_py(), dtype).astype("<u4") for i in at]
                        arrays.append(pa.array([(w[:m] if k == 0 else w[len(w) - m :]).tobytes() for w, m in zip(whole, length.tolist(), strict=True)], pa.binary()))
                    yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    return run


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece; with_ids adds its ids, unsigned
    little-endian 32-bit."""
    small_batches(docs.sparkSession)
    path = path or tokenizer_path()
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(src.mapInArrow(trimmed(_tokenize(path, window, with_ids)), _PIECES_DDL), "pieces")
    counts = materialize(pieces.groupBy("chunk", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # window entries at most
    rows = plan(histogram, window)
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("chunk", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank0"))
    if counts.count() <= BROADCAST_ROWS:  # else the pieces are shuffled with their ids, by (chunk, length)
        firsts = F.broadcast(firsts)
    ranked = pieces.join(firsts, ["chunk", "length"]).withColumn("rank", F.col("rank") + F.col("rank0")).drop("rank0")
    return ranked.mapInArrow(trimmed(_place(rows, window, with_ids, path)), _PLACED_DDL + (", ids binary" if with_ids else ""))
