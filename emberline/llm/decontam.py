"""Benchmark decontamination, by DataFrame functions only.

Windows of a document as long as a benchmark item (in words) are compared with the items of that length. Only windows that
open with a shingle of an item of that length are looked at: a window that is similar to an item can be moved right to the
next shingle they share, and grows no less similar (at the end of a document it gets shorter). Windows and items get
128-bit SimHash fingerprints of their shingles. A multi-index of BLOCKS blocks of WIDTH bits finds every item within RADIUS
bits of a window: two such fingerprints differ by RADIUS // BLOCKS bits or fewer in some block, and the index holds the
Hamming balls of that radius around the items' blocks, so that a block fetches 697 of 65,536 values. Weighted-shingle
similarity (multiset Jaccard of 5-word shingles) then verifies each candidate exactly, on the shingles' 64-bit hashes. At a
similarity of exactly 0.8 fingerprints differ by 19 bits with a deviation of 4, so that RADIUS, three deviations off,
keeps 99.8 % of the pairs there, and more of those that are closer.

The corpus is read once for the shingles that items share, whatever the benchmark's size: up to SEED_ROWS of them are
broadcast, more are shuffled. Texts with a hit are read a second time for their windows.

Nulls and odd input: null texts have no words; an item without words matches nothing; an item of fewer than five words is one
shingle; null ids are kept as null; rows with the same doc_id and text are one document; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, materialize

K, SIMILARITY = 5, 0.8
BLOCKS, WIDTH, RADIUS = 8, 16, 31
SEED_ROWS = 200_000
_SPLIT = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPLIT, -1), lambda w: w != "")


def _shingle_hash(ws: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(ws, i + j) for j in range(k)])


def _starts(ws: Column, k: int) -> Column:
    """0 .. n-k, or null where there is no shingle."""
    return F.when(F.size(ws) >= k, F.sequence(F.lit(0), F.size(ws) - k))


def _hashes(ws: Column, k: int) -> Column:
    return F.transform(_starts(ws, k), lambda i: _shingle_hash(ws, i, k))


def _fingerprint(sums: list[Column], n: Column, lanes: int) -> Column:
    """One 64-bit half: sums[j] holds, in each of its lanes, how many hashes have bit j + lane * len(sums).

    What is added to each lane carries into its last bit but one where the count is over half of n, so that all lanes of a
    sum are decided at once; the last bit stays free, as sums are signed."""
    width = 64 // lanes
    each, top = sum(1 << (i * width) for i in range(lanes)), width - 2
    lift = (F.lit((1 << top) - 1).cast("long") - F.floor(n / 2)) * F.lit(each)
    bits = [F.shiftleft(F.shiftrightunsigned(v + lift, top).bitwiseAND(F.lit(each)), j) for j, v in enumerate(sums)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def with_fingerprint(df: DataFrame, k: int, longest: int) -> DataFrame:
    """(row, n_sh, fp0, fp1) and df's columns but ws: the SimHash, of 128 bits, of the k-word shingles of its column ws.

    Sums are in lanes of a long, four of 16 bits where the longest ws allows it, else two of 32."""
    lanes = 4 if longest < 1 << 14 else 2
    step = 64 // lanes
    mask = F.lit(sum(1 << (i * step) for i in range(lanes)))
    shingles = df.select("row", F.explode(_hashes(F.col("ws"), k)).alias("h0")).withColumn("h1", F.xxhash64(F.lit("second"), "h0"))
    names = {f"{h}_{j}": F.sum(F.shiftrightunsigned(h, j).bitwiseAND(mask)) for h in ("h0", "h1") for j in range(step)}
    sums = shingles.groupBy("row").agg(F.count("*").alias("n_sh"), *[c.alias(n) for n, c in names.items()])
    halves = [_fingerprint([F.col(f"{h}_{j}") for j in range(step)], F.col("n_sh"), lanes).alias(f"fp{i}") for i, h in enumerate(("h0", "h1"))]
    return df.drop("ws").join(sums.select("row", "n_sh", *halves), "row")


def _block(b: int, fp0: Column, fp1: Column) -> Column:
    half = 64 // WIDTH
    return F.shiftrightunsigned(fp0 if b < half else fp1, b % half * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _blocks(name: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _block(b, F.col("fp0"), F.col("fp1")).alias(name)) for b in range(BLOCKS)]))


def ball(width: int = WIDTH, radius: int = RADIUS // BLOCKS) -> list[int]:
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def fetched(windows: DataFrame, index: DataFrame) -> DataFrame:
    """(row, item, apart): what the index fetches for windows (row, n, fp0, fp1) among items (item, n, fp0, fp1), once each:
    those of the same n with a block within RADIUS // BLOCKS bits; apart is the whole distance."""
    masks = F.array(*[F.lit(m).cast("long") for m in ball()])
    held = index.select("item", "n", F.col("fp0").alias("i0"), F.col("fp1").alias("i1"), _blocks("own").alias("at")).select("item", "n", "i0", "i1", "at.block", F.explode(F.transform(masks, lambda m: F.col("at.own").bitwiseXOR(m))).alias("value"))
    near = windows.select("row", "n", "fp0", "fp1", _blocks("value").alias("at")).select("row", "n", "fp0", "fp1", "at.*").join(held.hint("shuffle_hash"), ["n", "block", "value"])
    x0, x1 = F.col("fp0").bitwiseXOR(F.col("i0")), F.col("fp1").bitwiseXOR(F.col("i1"))
    # a pair is fetched once for each block that is near; the first such block answers for it
    earlier = reduce(lambda c, b: c | ((F.col("block") > b) & (F.bit_count(_block(b, x0, x1)) <= RADIUS // BLOCKS)), range(BLOCKS - 1), F.lit(False))
    return near.filter(~earlier).select("row", "item", (F.bit_count(x0) + F.bit_count(x1)).alias("apart"))


def _members(texts: DataFrame, key: str, k: int) -> DataFrame:
    """(key, h, c): how often each shingle occurs in each text."""
    return texts.select(key, F.explode(_hashes(F.col("ws"), k)).alias("h")).groupBy(key, "h").agg(F.count("*").alias("c"))


def _leaks(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Matches for items whose shingles have k words."""
    items = materialize(items.withColumn("item", F.monotonically_increasing_id()), "items")
    longest = items.agg(F.max("n")).first()[0]
    seeds = items.select("n", F.explode(F.array_distinct(_hashes(F.col("ws"), k))).alias("h")).groupBy("h").agg(F.sort_array(F.collect_set("n")).alias("lengths"))
    if seeds.count() <= SEED_ROWS:
        seeds = F.broadcast(seeds)
    at = docs.withColumn("ws", words(F.col("text"))).select("doc_id", "tie", F.posexplode(_hashes(F.col("ws"), k)).alias("i", "h"))
    hits = materialize(at.join(seeds, "h").select("doc_id", "tie", "i", F.explode("lengths").alias("n")), "leak-hits")
    per = hits.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("i", "n")).alias("at"))
    # texts are shuffled to their hits at any size: broadcast hits would save that only while the corpus is small
    cut = docs.join(per.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(per["doc_id"]) & (docs["tie"] == per["tie"])).select(docs["doc_id"], docs["tie"], "text", "at")
    cut = cut.withColumn("ws", words(F.col("text"))).select("doc_id", "tie", F.explode(F.transform("at", lambda a: F.struct(a["i"].alias("i"), a["n"].alias("n"), F.slice("ws", a["i"] + 1, a["n"]).alias("ws")))).alias("w"))
    windows = materialize(cut.select("doc_id", "tie", "w.*").withColumn("row", F.monotonically_increasing_id()), "windows")
    pairs = fetched(with_fingerprint(windows, k, longest), with_fingerprint(items.withColumn("row", F.col("item")), k, longest)).filter(F.col("apart") <= RADIUS)
    pairs = materialize(pairs.select("row", "item"), "leak-pairs")
    wanted = windows.join(pairs.select("row").distinct(), "row")
    own, theirs = _members(wanted, "row", k), _members(items, "item", k).withColumnRenamed("c", "d")
    both = pairs.join(own, "row").join(theirs, ["item", "h"]).groupBy("row", "item").agg(F.sum(F.least("c", "d")).alias("both"))
    sizes = both.join(wanted.select("row", "doc_id", "tie", "i", (F.size("ws") - k + 1).alias("n_row")), "row").join(items.select("item", "item_id", (F.size("ws") - k + 1).alias("n_item")), "item")
    return sizes.withColumn("similarity", F.col("both") / (F.col("n_row") + F.col("n_item") - F.col("both"))).filter(F.col("similarity") >= SIMILARITY).select("doc_id", "tie", "item_id", "similarity", "i")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, tie, item_id, similarity, start): each document and item whose best window reaches SIMILARITY, and the
    first word of the first such window. tie is xxhash64 of the text ('' for null)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("ws")).withColumn("n", F.size("ws")).filter("n > 0")
    sizes = sorted(r.k for r in items.select(F.least(F.lit(K), "n").alias("k")).distinct().collect())  # K values at most
    found = [_leaks(d, items.filter(F.least(F.lit(K), F.col("n")) == k), k) for k in sizes]
    if not found:
        return d.sparkSession.createDataFrame([], "doc_id long, tie long, item_id long, similarity double, start long")
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "tie", "item_id").agg(F.max(F.struct("similarity", (-F.col("i")).alias("back"))).alias("m"))
    return best.select("doc_id", "tie", "item_id", F.col("m.similarity").alias("similarity"), (-F.col("m.back")).cast("long").alias("start"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a leak, with their columns."""
    with Scratch() as scratch:
        leaked = scratch.keep(materialize(find_leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).distinct(), "leaked"))
    keyed = F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == leaked["_tie"]
    return docs.join(leaked, keyed & docs["doc_id"].cast("long").eqNullSafe(leaked["_id"]), "left_anti")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start); rows that share a doc_id are reported as one."""
    with Scratch() as scratch:
        found = scratch.keep(materialize(find_leaks(docs, benchmark), "leaks"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("m"))
    return best.select("doc_id", "item_id", F.round("m.similarity", 6).alias("similarity"), (-F.col("m.back")).alias("start"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, w, len(w) AS n FROM (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark)),
bs AS (SELECT item_id, n, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT *, unnest(range(1, n - 3)) AS i FROM b WHERE n >= 5)),
ds AS (SELECT doc_id, w, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT DISTINCT doc_id, i, item_id, n FROM ds JOIN bs USING (s)),
win AS (SELECT hit.doc_id, hit.i, item_id, w[hit.i:hit.i + n - 1] AS x FROM hit JOIN d ON hit.doc_id = d.doc_id),
ws AS (SELECT doc_id, i, item_id, array_to_string(x[j:j+4], ' ') AS s, count(*) AS c FROM (SELECT *, unnest(range(1, len(x) - 3)) AS j FROM win) GROUP BY ALL),
bc AS (SELECT item_id, s, count(*) AS c FROM bs GROUP BY ALL),
na AS (SELECT doc_id, i, item_id, sum(c) AS n FROM ws GROUP BY ALL),
nb AS (SELECT item_id, sum(c) AS n FROM bc GROUP BY ALL),
o AS (SELECT ws.doc_id, ws.i, ws.item_id, sum(least(ws.c, bc.c)) AS both_n FROM ws JOIN bc ON ws.item_id = bc.item_id AND ws.s = bc.s GROUP BY ALL),
sim AS (SELECT o.doc_id, o.item_id, o.i, CAST(both_n AS DOUBLE) / CAST(na.n + nb.n - both_n AS DOUBLE) AS v
  FROM o JOIN na ON o.doc_id = na.doc_id AND o.i = na.i AND o.item_id = na.item_id JOIN nb ON o.item_id = nb.item_id)
SELECT doc_id, item_id, round(max(v), 6) AS similarity, CAST(arg_max(i, (v, -i)) - 1 AS BIGINT) AS start FROM sim WHERE v >= 0.8 GROUP BY doc_id, item_id
"""
