"""Line deduplication against levelled sorted runs of line hashes.

Documents arrive in batches, in ascending order of doc_id. A batch's line keys are reduced to one row per key with the
smallest document that holds it, and merge-joined with the runs; keys that no run holds make a new run of level 0. Runs are
bucketed by hash and sorted, so that a batch is shuffled to the runs and they stay where they are. When a level holds FANOUT
runs they are merged into one run of the next level. A line is dropped where a smaller document, of a run or of the batch
itself, holds its key.

Keys are 128-bit hashes, so that no two different lines are taken for each other. Texts are read twice and shuffled once,
to meet the positions of their dropped lines.

Nulls and odd input: a null or empty text is one empty line; a null doc_id counts as one document after all others; rows
that share a doc_id are one document; where counts are asked for, input columns of their
names are replaced; others are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import SPACES, ascii_lower, discard, materialize, quoted, shared_dir, shuffle_partitions, small_batches, trimmed

FANOUT = 3
#: Batches: one for each BATCH_ROWS documents, BATCHES at least.
BATCHES, BATCH_ROWS = 4, 200_000_000
MIN_CHARS = 10
_LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


class RunStore:
    """Runs of (h1, h2, owner), by level; every hash is in one run only.

    A run is a table in the shared folder, in buckets by hash, each one sorted file, so that merge joins with it need neither
    a shuffle nor a sort of the run. close() deletes what is left."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels, self.tables = spark, fanout, [], {}
        self.buckets = shuffle_partitions(spark)

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name).filter("fresh").select("h1", "h2", "owner")

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables[name] = f"{shared_dir(self.spark)}/{name}"
        rows.write.option("path", self.tables[name]).option("compression", "zstd").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Take a batch (ord, tie, pos, h1, h2) and return (ord, tie, pos) of the lines to drop from it."""
        known = self.runs()
        met = lines.groupBy("h1", "h2").agg(F.min("ord").alias("own"), F.max("ord").alias("last"))
        for i, run in enumerate(known):
            met = met.join(self.read(run).withColumnRenamed("owner", f"owner{i}").hint("merge"), ["h1", "h2"], "left")
        older = F.coalesce(*[F.col(f"owner{i}") for i in range(len(known))], F.lit(None).cast("long"))
        judged = met.select("h1", "h2", F.coalesce(older, "own").alias("owner"), "last", older.isNull().alias("fresh"))
        name = self._write(judged)
        # read as plain files: of a plain exchange adaptive execution can split a line that very many documents hold
        repeated = self.spark.read.schema(judged.schema).parquet(self.tables[name]).filter("owner < last").select("h1", "h2", "owner")
        drop = materialize(lines.join(repeated, ["h1", "h2"]).filter(F.col("owner") < F.col("ord")).select("ord", "tie", "pos"), "line-drops")
        self._push(name, 0)
        return drop

    def _push(self, run: str, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            rows = reduce(DataFrame.unionByName, [self.read(r) for r in old])
            merged = self._write(rows.withColumn("fresh", F.lit(True)).repartition(self.buckets, "h1", "h2").sortWithinPartitions("h1", "h2"))
            for r in old:
                self._delete(r)
            self._push(merged, level + 1)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.tables.pop(name))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        for name in list(self.tables):
            self._delete(name)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        for text, pos in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist(), strict=True):
            lines = text.split("\n")
            gone = set(pos or ())
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
        yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=["rest", "text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, batches: int | None = None, min_chars: int = MIN_CHARS, fanout: int = FANOUT, counts: bool = True) -> DataFrame:
    """docs with the kept lines as text and, with counts, n_lines (before) and n_dropped."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    added = ("n_lines", "n_dropped") if counts else ()
    rest = [c for c in docs.columns if c not in ("text", *added)]
    ordinal = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    src = docs.select(ordinal.alias("ord"), F.coalesce("text", F.lit("")).alias("text"), F.struct(*[F.col(quoted(c)) for c in rest]).alias("rest")).withColumn("tie", F.xxhash64("text"))
    batches = batches or max(BATCHES, -(-docs.count() // BATCH_ROWS))
    cuts = sorted(set(docs.select(ordinal.cast("double").alias("ord")).approxQuantile("ord", [i / batches for i in range(1, batches)], 0.1 / batches)))
    batch = reduce(lambda c, cut: c + (F.col("ord") > F.lit(min(int(cut), _LAST - 1))).cast("int"), cuts, F.lit(0))
    lines = src.select("ord", "tie", batch.alias("batch"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars)
    lines = materialize(lines.select("batch", "ord", "tie", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")), "lines", partition_by="batch")
    store = RunStore(spark, fanout)
    # a bucket is one sorted file, so that reading it in order needs no sort
    ordering = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(ordering, "false")
    spark.conf.set(ordering, "true")
    try:
        drops = [store.add(lines.filter(F.col("batch") == i).drop("batch")) for i in range(len(cuts) + 1)]
    finally:
        spark.conf.set(ordering, before)
        store.close()
    discard(lines)
    drop = reduce(DataFrame.unionByName, drops).groupBy("ord", "tie").agg(F.collect_set("pos").alias("drop"))
    met = src.join(drop.hint("shuffle_hash"), ["ord", "tie"], "left").select("rest", "text", "drop")
    kind = T.StructType([met.schema["rest"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    done = met.mapInArrow(trimmed(_assemble), kind)
    first = [F.col("text") if c == "text" else F.col(f"rest.{quoted(c)}").alias(c) for c in docs.columns if c not in added]
    return done.select(*first, *added)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of dedup_lines."""
    return dedup_lines(docs.select("doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), owner AS (SELECT k, min(doc_id) AS first_id FROM l WHERE length(k) >= 10 GROUP BY k)
SELECT l.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE o.first_id < l.doc_id) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE o.first_id IS NULL OR o.first_id >= l.doc_id), '')) AS kept_sha256
FROM l LEFT JOIN owner o ON l.k = o.k GROUP BY l.doc_id
"""
