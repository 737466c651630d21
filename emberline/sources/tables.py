"""Tables written to the cluster's shared folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
_open: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines see: spark.checkpoint.dir. Only where all runs on one machine (tests), and it is unset,
    a temporary folder stands for it."""
    global _own_dir
    if given := spark.conf.get("spark.checkpoint.dir", None):
        return given.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="emberline-")
    return _own_dir


#: Up to how many bytes, as Spark estimates them, it broadcasts a table of itself; and the setting with its default.
BROADCAST_BYTES = 256 * 1024
_BROADCAST, _DEFAULT = "spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024


def small_broadcasts(spark: SparkSession) -> None:
    """Spark estimates a table by its compressed files, and a table of numbers that seems to be of 10 MB, its default limit, is
    of hundreds as a hash table, which the driver gathers and holds. A session's own limit stays, -1 (none) as well."""
    if spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() == _DEFAULT:
        spark.conf.set(_BROADCAST, str(BROADCAST_BYTES))


def growing(df: DataFrame) -> DataFrame:
    """df for a join that shuffles and sorts both sides whatever the session's limit of broadcasts is: tables of points and
    cells grow with the input, and the driver must never gather one."""
    return df.hint("merge")


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    if _open:
        _open[-1].append(out)
    return out


def _delete(table: DataFrame) -> None:
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def trim_driver(spark: SparkSession) -> str:
    """The driver's JVM gives what it has freed outside its heap back to the system: planning leaves more than 100 MB of it with
    the allocator. Java for Linux can, others go without; the answer says what came of it."""
    jvm, new = spark._jvm, spark.sparkContext._gateway.new_array
    args = new(jvm.java.lang.Object, 4)
    args[2], args[3] = new(jvm.java.lang.Object, 0), new(jvm.java.lang.String, 0)
    try:
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        return invoke.invoke(server, args)
    except Py4JError as e:
        return str(e)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing needs, and of the memory that went with them."""
    gc.collect()
    spark._jvm.System.gc()
    trim_driver(spark)


def discard(table: DataFrame) -> None:
    """Delete a table that materialize() wrote and nothing reads any more."""
    _delete(table)
    release(table.sparkSession)


_steps: dict[tuple, DataFrame] = {}


def _state(spark: SparkSession, path: str) -> tuple:
    """The files at path, with their sizes and times."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def step(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A step that several queries of a run start from, written once: the same table for as long as the application lasts
    and the files at source stay as they are. As the files between the steps of a batch run, but none is read when stale."""
    key = (spark.sparkContext.applicationId, name, source, _state(spark, source))
    if key not in _steps:
        global _open
        _open, held = [], _open  # belongs to no block
        try:
            _steps[key] = materialize(build(), name)
        finally:
            _open = held
    return _steps[key]


class Scratch:
    """with Scratch() as s: tables written inside go when the block ends, but those that s.keep() was given. What the block
    hands on must have been written by then."""

    def __enter__(self) -> Scratch:
        _open.append([])
        self.kept: list[DataFrame] = []
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        self.kept.append(table)
        return table

    def __exit__(self, *_: object) -> None:
        done = _open.pop()
        for table in done:
            if not any(table is k for k in self.kept):
                _delete(table)
        if _open:
            _open[-1].extend(self.kept)
        if done:
            release(done[0].sparkSession)
