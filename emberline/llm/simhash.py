"""SimHash near-duplicates by multi-index hashing.

A fingerprint has one bit per majority over the XXH64 hashes of the text's word shingles. Links join fingerprints that
differ in at most RADIUS bits. Fingerprints are cut into SEGMENTS segments, each with a table of its own from segment values
to fingerprints. Two fingerprints within RADIUS bits differ by RADIUS // SEGMENTS bits or fewer in some segment, so the small
Hamming balls enumerated around a fingerprint's segments fetch all its neighbours, and others besides; the complete
distance of each fetched pair decides. Equal fingerprints are one class with one entry, however many documents share it;
a segment value that very many classes share is subdivided by pieces of the other segment, which loses no neighbour.

Nulls and odd input: null and empty texts have fingerprint zero; a null doc_id is answered with its own row and never names
a component unless its group has no other id; repeated rows are each answered; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, materialize, shuffle_partitions, small_batches, trimmed
from .graph import connected_components

SEGMENTS, RADIUS = 2, 2
WIDTH = 64 // SEGMENTS
#: Pieces of the other segment by which a value of more than COMMON fingerprints is subdivided.
PARTS, COMMON = RADIUS + 1, 2000
BROADCAST_ROWS = 100_000
SEED = 42


def shingles(text: str, k: int = 3) -> list[bytes]:
    """k-word shingles with repeats; of fewer words the whole sequence; of none, none."""
    words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return []
    if len(words) <= k:
        return [b" ".join(words)]
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    return [joined[a : b - 1] for a, b in zip(starts, ends[k - 1 :], strict=False)]


def simhash(parts: list[bytes]) -> int:
    """The majority bit of the parts' hashes, for each of 64 bits; unsigned."""
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for i in range(0, len(parts), 65536):
        h = np.array([digest(p, SEED) for p in parts[i : i + 65536]], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(parts), bitorder="little").view("<u8")[0])


_OUT = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("fp", pa.int64())])


def _fingerprints(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(shingles(t, k)) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(fps)], schema=_OUT)

    return run


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, tie, fp): the fingerprint as a signed long of each row of docs, and a hash of its text."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    return src.mapInArrow(trimmed(_fingerprints(k)), "doc_id long, tie long, fp long")


def ball(width: int, radius: int) -> list[int]:
    """All XOR masks of radius bits or fewer, of width bits."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _segment(fp: Column, s: int) -> Column:
    return F.shiftrightunsigned(fp, s * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _parts(fp: Column, segment: Column) -> Column:
    """(part, bits) of the segment that is not the given one, cut into PARTS pieces."""
    other = F.when(segment == 0, _segment(fp, 1)).otherwise(_segment(fp, 0))
    piece = -(-WIDTH // PARTS)
    return F.array(*[F.struct(F.lit(j).alias("part"), F.shiftrightunsigned(other, j * piece).bitwiseAND(F.lit((1 << piece) - 1)).alias("bits")) for j in range(PARTS)])


def candidates(classes: DataFrame, common: int = COMMON) -> DataFrame:
    """(a, b): pairs of fingerprints, a < b, that the index fetches: within RADIUS // SEGMENTS bits in some segment.

    The table of a segment holds each fingerprint at its own value; probes enumerate the ball around theirs. A value that
    more than common fingerprints hold is subdivided by the pieces of the other segment: fingerprints within RADIUS bits
    agree in one of RADIUS + 1 pieces. A pair is fetched once: by its first near segment, at its first equal piece."""
    fps = classes.select("fp").repartition(shuffle_partitions(classes.sparkSession))
    table = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), _segment(F.col("fp"), s).alias("value")) for s in range(SEGMENTS)])).alias("at")).select("fp", "at.*")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(WIDTH, RADIUS // SEGMENTS)])
    probes = table.select("fp", "segment", F.explode(F.transform(masks, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))
    held = materialize(table.groupBy("segment", "value").agg(F.count("*").alias("n")).filter(F.col("n") > common).select("segment", "value", F.lit(True).alias("held")), "simhash-common")
    if held.count() <= BROADCAST_ROWS:
        held = F.broadcast(held)
    whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("bits")))

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        marked = rows.join(held, ["segment", "value"], "left")
        keys = F.when(F.col("held"), _parts(F.col("fp"), F.col("segment"))).otherwise(whole)
        return marked.select(F.col("fp").alias(name), "segment", "value", F.explode(keys).alias("k")).select(name, "segment", "value", "k.*")

    met = keyed(probes, "a").join(keyed(table, "b"), ["segment", "value", "part", "bits"]).filter(F.col("a") < F.col("b"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    earlier = reduce(lambda c, s: c | ((F.col("segment") > s) & (F.bit_count(_segment(apart, s)) <= RADIUS // SEGMENTS)), range(SEGMENTS - 1), F.lit(False))
    equal = F.transform(_parts(apart, F.col("segment")), lambda p: p["bits"] == 0)
    first = F.when(F.col("part") >= 0, F.array_position(equal, F.lit(True)) - 1 == F.col("part")).otherwise(True)
    return met.filter(~earlier & first).select("a", "b")


def link_classes(classes: DataFrame, common: int = COMMON) -> DataFrame:
    """(src, dst): all pairs of the fingerprints (fp, distinct) of classes that differ in RADIUS bits or fewer."""
    near = candidates(classes, common).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    return near.select(F.col("a").alias("src"), F.col("b").alias("dst"))


def near_duplicates(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; links are at RADIUS differing bits or fewer."""
    with Scratch() as scratch:
        fps = scratch.keep(materialize(fingerprints(docs, k), "simhash"))
        named = scratch.keep(materialize(_named(fps), "simhash-components"))
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _named(fps: DataFrame) -> DataFrame:
    """(fp, component_id) of each fingerprint."""
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = connected_components(link_classes(classes)).withColumnRenamed("node", "fp")
    grouped = classes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return grouped.select("fp", "component").join(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")


def keep_first(docs: DataFrame, k: int = 5) -> DataFrame:
    """The document of each group of near-duplicates with the smallest doc_id; all of docs' rows and columns otherwise.
    Near-duplicates are at a similarity of 0.8 in k-word shingles or more, directly or through others (see similar.py); the
    two bits of near_duplicates are the query's own contract. Rows equal in id and text stay or go together, and so do rows
    of one group that share its smallest id; rows with a null doc_id all stay. Empty texts are one group."""
    from .similar import similar_groups

    with Scratch() as scratch:
        gone = similar_groups(docs, k).filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).distinct()
        gone = scratch.keep(materialize(gone, "near-duplicates"))
    keyed = F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_tie"]
    return docs.join(gone, keyed & (docs["doc_id"].cast("long") == gone["_id"]), "left_anti")
