"""Secret scans with corpus-wide ownership frequency.

Every whole text is scanned for credential patterns. Each candidate value is hashed, and the hashes are counted over the
corpus by distinct owners and repositories: values that many owners carry are copied examples, values that belong to one
owner look live. The counts also admit high-entropy tokens that no pattern names, but only where one owner holds them.

Nulls and odd input: a null text is empty; a null owner is an owner of its own; repeated rows are scanned separately and
count as one repository; columns beside those named are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, small_batches, trimmed

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
CUES = ("password", "passwd", "secret", "token", "api")
MIN_ENTROPY = 3.6


def _digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode(), digest_size=16).digest()


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, index of kind, end, hash of the value) of the matches of the three patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(c in low for c in CUES):
        out += [(m.start(), 0, m.end(), _digest(m[2])) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), _digest(m[0])) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), _digest(m[0])) for m in HEX.finditer(text)]
    return sorted(out)


def token_spans(text: str, base: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, bytes]]:
    """High-entropy tokens of mixed case with digits that touch no base span; both lists are walked once."""
    out, k, reach = [], 0, 0  # reach: where the base spans that start before this token's end have ended
    for m in TOKEN.finditer(text):
        start, end = m.span()
        while k < len(base) and base[k][0] < end:
            reach = max(reach, base[k][2])
            k += 1
        v = m[0]
        if reach <= start and any(c.isdigit() for c in v) and v.lower() != v and v.upper() != v and entropy(v) >= MIN_ENTROPY:
            out.append((start, 3, end, _digest(v)))
    return out


_CAND = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("h", pa.binary())])
_SCAN = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("owner", pa.string()), ("repo", pa.string()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("cands", pa.list_(_CAND))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {name: batch.column(name) for name in ("row", "doc_id", "owner", "repo")}
        counts, shas, cands = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            counts.append([sum(k == i for _, k, _, _ in base) for i in range(3)])
            shas.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in base).encode()).hexdigest())
            cands.append([dict(start=a, kind=k, end=b, h=h) for a, k, b, h in base + token_spans(text, base)])
        n = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([rows["row"], rows["doc_id"], rows["owner"], rows["repo"], *n, pa.array(shas, pa.string()), pa.array(cands, pa.list_(_CAND))], schema=_SCAN)


_SCAN_DDL = "row long, doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, base_sha256 string, cands array<struct<start:long,kind:int,end:long,h:binary>>"


def scan_secrets(docs: DataFrame, owner: str = "source", repo: str = "doc_id", live_owners: int = 1, live_repos: int = 3) -> DataFrame:
    """One row per row of docs (doc_id, text, owner, repo): counts and hash of the base spans, all spans, and how many of
    the candidate values look live (held by at most live_owners owners and live_repos repositories) or copied."""
    small_batches(docs.sparkSession)
    src = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"), F.coalesce("text", F.lit("")).alias("text")
    )
    scanned = materialize(src.mapInArrow(trimmed(_scan), _SCAN_DDL), "secrets-scan")
    flat = scanned.select("row", "owner", "repo", F.explode("cands").alias("c")).select("row", "owner", "repo", "c.*")
    # each step combines on the map side first, so a value that a third of all documents hold stays small
    per_owner = flat.groupBy("h", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("h", "owner").agg(F.count("*").alias("repos"))
    freq = per_owner.groupBy("h").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    # written, so that the join reads plain exchanges, of which adaptive execution can split that of a common value
    judged = flat.join(materialize(freq, "secret-owners"), "h").withColumn("live", (F.col("owners") <= live_owners) & (F.col("repos") <= live_repos))
    judged = judged.filter((F.col("kind") < 3) | F.col("live"))
    spans = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_copied"), F.count_if(F.col("kind") == 3).alias("n_owned"),
    )
    kind = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform("all", lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scanned.drop("cands", "owner", "repo").join(spans, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(text, F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied", "n_owned")],
    )
