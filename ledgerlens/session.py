"""Spark session and checkpoint-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TENANT = "company_id"


def per_tenant(df: DataFrame) -> DataFrame:
    """Broadcast hint for a frame with at most one row per ``company_id``.

    Such a frame (a tenant's max date, quartiles, watermark, ...) is bounded
    by the number of registered companies, not by the data. Broadcasting it
    lets the large side join it on ``company_id`` where it stands; a hash
    exchange on a handful of tenant keys would instead move every row of a
    tenant into one task.
    """
    return F.broadcast(df)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for the plans made and run inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def get_session(master: str | None = None, app: str = "ledgerlens",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew join) and no web UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # checkpoint files of collected DataFrames are removed, not left behind
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # small enough that only dimension-sized sides are broadcast from
        # file statistics; AQE still broadcasts measured-small shuffle outputs
        .config("spark.sql.autoBroadcastJoinThreshold", str(4 * 1024 * 1024))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once.

    The grouped forecast runs library code in Python workers; on a cluster, or
    when the session starts from another folder, they cannot import it
    otherwise.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-ship-"), "ledgerlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temp folder would not survive
    the loss of an executor, so we refuse to invent one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):  # one process
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")


passing: list[list] = []  # open scopes of tables that go when their result is written: the paths written in each

#: Shuffle files of a plan go as soon as its result is written; nothing reads them again.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
PASS_BYTES = 1 << 30   # input of a pass, where a table is written in several
UNKNOWN_BYTES = (1 << 63) - 1  # what Spark takes rows from Python to have
MOST_PASSES = 4        # so a table's shuffles take at least a quarter of what one pass would


def passes_of(df: DataFrame) -> int:
    """Passes in which ``df`` is written: one for each ``PASS_BYTES`` of the files it reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    size = sum(x for x in sizes if x < UNKNOWN_BYTES)
    return max(1, min(MOST_PASSES, -(-size // PASS_BYTES)))


def in_passes(df: DataFrame, key: str | None) -> Iterator[DataFrame]:
    """The rows of ``df`` in as many parts as it is written in, dealt by a hash of ``key``.

    Joins and groupings on ``key`` let the filter through to their inputs, so a pass
    shuffles its own share only. ``df`` must give the same rows each time it is read.
    """
    n = passes_of(df) if key else 1
    for k in range(n):
        yield df.where(F.pmod(F.xxhash64(key), F.lit(n)) == k) if n > 1 else df


def scratch(spark: SparkSession, path: str) -> None:
    """``path`` is deleted when the application ends, or with the scope it was written in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    if passing:
        passing[-1].append(place)


def materialize(df: DataFrame, by: str | None = None, key: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the reliable checkpoint folder and
    read it back.

    Used where the reference stores a table that several jobs read
    (``sales``, ``sales_summary``, ...): downstream plans start from the
    written files instead of recomputing, the lineage is cut (a lost executor
    only costs re-reading those files), and, unlike an RDD checkpoint, each
    consumer's scan reads only its columns and takes its pushed filters. The
    copy is deleted when the application ends. ``by`` names a column to partition
    the files by, so a filter on it opens only the files it needs. With ``key`` a
    large input is written in passes (``in_passes``).
    """
    return materialize_parts(in_passes(df, key), by)


def materialize_parts(parts: Iterator[DataFrame], by: str | None = None) -> DataFrame:
    """``materialize`` for rows that come in parts, one written after the other."""
    path = None
    for part in parts:
        spark = part.sparkSession
        path = path or f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
        with settings(spark, FREED):
            (part.write.partitionBy(by) if by else part.write).mode("append").option("compression", "zstd").parquet(path)
    scratch(spark, path)
    return spark.read.parquet(path)


def bounded(df: DataFrame, key: str) -> DataFrame:
    """``df``, written in passes by ``key`` where its input takes several, so that the shuffle
    files of a plan that is read once are never all held at a time."""
    return materialize(df, key=key) if passes_of(df) > 1 else df


def only_read(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns; tables that were written on the way and that it does not
    read are deleted. Nothing else that reads them may leave ``make``."""
    passing.append([])
    try:
        out = make()
    finally:
        written = passing.pop()
    files = out.inputFiles() if written else []
    conf = out.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for place in written:
        if any(f"/{place.getName()}/" in f for f in files):
            if passing:
                passing[-1].append(place)
        else:
            place.getFileSystem(conf).delete(place, True)
    return out
