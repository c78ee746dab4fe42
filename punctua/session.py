"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs count on. A cluster's own value always wins: each one is
# applied only where the builder or spark-defaults left it unset.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot key of a sort-merge join even if an aggregation follows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Daily loads replace only the days they carry.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Day files written by pandas hold nanoseconds, which Spark reads as longs.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # The JVM does not compile longer methods; wide rows of texts then take several times as long.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_MADE: list[str] = []
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set each default the session's own configuration does not mention."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    if not given & {"spark.sql.shuffle.partitions", INITIAL_PARTITIONS}:
        # many small shuffle partitions to start from; AQE merges those that stay small
        spark.conf.set(INITIAL_PARTITIONS, str(4 * spark.sparkContext.defaultParallelism))
    return spark


def short_methods(spark: SparkSession) -> None:
    """The default above for jobs that build or read wide texts, in a session that lacks it."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if key not in {k for k, _ in spark.sparkContext.getConf().getAll()}:
        spark.conf.set(key, DEFAULTS[key])


def build_session(app: str = "punctua", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return apply_defaults(builder.getOrCreate())


# Shuffle files of a job go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For jobs whose result is written and read again, so that nothing needs their shuffles later.

    Without it the shuffles of all earlier steps lie on the executors' disks together. A value the
    session was given stays.
    """
    if CLEANUP in {key for key, _ in spark.sparkContext.getConf().getAll()}:
        yield
        return
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder for intermediate tables that every executor can reach.

    Taken from ``spark.checkpoint.dir``. Only a local master may do without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the executors")
        root = tempfile.mkdtemp(prefix="punctua-")
    folder = f"{root.rstrip('/')}/punctua/{purpose}-{uuid.uuid4().hex}"
    _MADE.append(folder)
    return folder


def clear_shared_folders(spark: SparkSession) -> None:
    """Delete what ``shared_folder`` has named so far in this process.

    Results that read these folders lazily must have been written or collected
    before: the job that uses a result calls this, not the function that built it.
    """
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
