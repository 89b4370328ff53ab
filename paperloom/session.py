"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_KEY = "spark.sql.shuffle.partitions"
SCAN_KEY = "spark.sql.files.minPartitionNum"
TIDY_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
OPEN_KEY = "spark.sql.maxConcurrentOutputFileWriters"
PLACED_KEY = "spark.sql.requireAllClusterKeysForCoPartition"
_local_folder: str | None = None  # of local sessions without that setting
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and timings; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paperloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Only a local session may fall back on a temporary folder.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="paperloom-")
    return _local_folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder, inside the folder of the run if there is one."""
    return os.path.join(_run_folder.get() or shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store its path names; one that is not there is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """A folder for the intermediate tables of a job that writes its result itself; removed at the end.

    Results that are still to be computed from intermediate tables must not
    leave the block.
    """
    folder = os.path.join(_run_folder.get() or shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove_path(spark, folder)


@contextmanager
def shuffles_of(spark: SparkSession, parts: int | None) -> Iterator[None]:
    """Shuffles and scans of what is written within the block have no fewer tasks than `parts`; the session's own numbers come back.

    For sums by term: dealt out by `repartition` they would lose the combining
    before the shuffle, and what a task combines grows with the files it scans,
    up to 128 MB of them. A result that is computed later is not reached.
    """
    scans = int(spark.conf.get(SCAN_KEY, None) or spark.sparkContext.defaultParallelism)
    before = {SHUFFLE_KEY: spark.conf.get(SHUFFLE_KEY), SCAN_KEY: spark.conf.get(SCAN_KEY, None)}
    wider = [] if parts is None else [k for k, n in ((SHUFFLE_KEY, int(before[SHUFFLE_KEY])), (SCAN_KEY, scans)) if n < parts]
    for key in wider:
        spark.conf.set(key, str(parts))
    try:
        yield
    finally:
        for key in wider:
            if before[key] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before[key])


@contextmanager
def _set_to(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written_once(spark: SparkSession):
    """What is written within the block leaves no shuffle files behind once it is written.

    Otherwise those of all steps of a job stay on the disks together, until the
    driver happens to collect its garbage.
    """
    return _set_to(spark, TIDY_KEY, "true")


def open_files(spark: SparkSession, most: int):
    """A task that writes within the block keeps up to `most` files open, so it need not sort its rows by file."""
    return _set_to(spark, OPEN_KEY, str(most))


def materialise(df: DataFrame, label: str, parts: int | None = None) -> DataFrame:
    """Write an intermediate table once and read it back; its shuffles and scans have no fewer tasks than `parts`.

    Later stages re-read files instead of recomputing the lineage, also after
    executors are lost, and columns they do not need are never decoded.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_of(spark, parts), written_once(spark):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def even_labels(spark: SparkSession, parts: int) -> list[int]:
    """Whole numbers of which Spark's hash sends exactly one to each of `parts` partitions, in their order."""
    found, tried = {}, 0
    while len(found) < parts:
        more = max(64, parts * (20 + parts.bit_length()))
        number = F.col("id").cast("int")
        place = F.pmod(F.hash(number), F.lit(parts))
        rows = spark.range(tried, tried + more, numPartitions=1).groupBy(place.alias("place")).agg(F.min(number).alias("label"))
        found = {r["place"]: r["label"] for r in rows.collect()} | found
        tried += more
    return [found[i] for i in range(parts)]


def materialise_placed(df: DataFrame, path: str, place: str, parts: int) -> DataFrame:
    """As `materialise`, to a given path, for rows dealt to `parts` partitions by the column `place`; what is read back still is.

    Spark learns of buckets through its catalog only: the table is entered
    there, read, and its entry removed. The files stay, as with `materialise`.
    """
    spark = df.sparkSession
    name = f"paperloom_{uuid.uuid4().hex[:24]}"
    # rows that lie together by `place` also do so by `place` and anything else: joins within the block may rely on that
    with open_files(spark, 1), written_once(spark), _set_to(spark, PLACED_KEY, "false"):
        df.write.format("parquet").bucketBy(parts, place).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def materialise_sized(df: DataFrame, label: str, row_bytes: Column) -> tuple[DataFrame, int]:
    """As `materialise`, with the total of `row_bytes` measured while writing."""
    size = Observation()
    observed = df.observe(size, F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes"))
    return materialise(observed, label), size.get["bytes"]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Even out a table that has fewer splits than the cluster has cores; a larger one stays as it is.

    A file of one row group is one task however many cores there are. Such a
    table is small against the cluster, so moving it costs little.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
