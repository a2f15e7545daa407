"""Session construction and the shared scratch location for written tables."""

from __future__ import annotations

import contextlib
import itertools
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library assumes.  They are safe on a cluster:
# UTC session time, AQE for runtime re-planning (partition coalescing, skew
# splitting of joins and rebalanced writes) and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Small inputs written into many day folders: let AQE keep several write
    # tasks instead of packing everything into one (no effect on large data,
    # whose shuffle partitions are far above this size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tiersmith",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for tables this library writes and reads back.

    On a cluster this is the shared ``spark.checkpoint.dir`` named by the
    deployment (every executor and the driver can reach it); a session on a
    cluster that names none is refused, since a folder of the driver's machine
    would be out of the executors' reach.  Only a local session without one
    gets a private folder, registered as the checkpoint directory, so that
    ``DataFrame.checkpoint`` works too.

    What is written here belongs to the caller: tables under ``tables/`` stay
    until the owner of the folder clears it; Spark removes checkpoints itself
    with ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {master} share")
    local = tempfile.mkdtemp(prefix="tiersmith-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under :func:`shared_dir` for one written table."""
    return os.path.join(shared_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Gives ``stage(frame)``: the frame written once under :func:`shared_dir`
    and read back, so that later steps neither compute it again nor see changes
    of its inputs.  Unlike a checkpoint the rows are compressed columns, of which
    readers take those that they use, and they go when the block ends.  A frame
    made to lie together by some columns is written so with ``clustered``."""
    root, numbers = fresh_path(spark, "staged"), itertools.count()

    def stage(frame: DataFrame, clustered: bool = False) -> DataFrame:
        path = f"{root}/{next(numbers)}"
        with tidy_jobs(spark), clustered_joins(spark) if clustered else contextlib.nullcontext():
            frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    try:
        yield stage
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# Spark's setting for the size of a generated method from which on
# it runs a stage without whole-stage code, and the size (bytes) up to which the
# JVM compiles a method.
_METHOD_LIMIT, _COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


@contextlib.contextmanager
def compiled_stages(spark: SparkSession) -> Iterator[None]:
    """Jobs started in this block do not run generated methods that are too large
    for the JVM's compiler: such a method is interpreted for every row.  A stage
    of wide lines with parsed dates has one; without whole-stage code Spark
    computes the same columns in several smaller methods.  A lower limit of the
    session stays."""
    limit = str(min(int(spark.conf.get(_METHOD_LIMIT)), int(_COMPILED_BYTES)))
    with _setting(spark, _METHOD_LIMIT, limit):
        yield


# Fixed value: Spark's setting by which the shuffle files of a job go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def tidy_jobs(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries started in this block go when the query has ended.
    Otherwise they stay until the driver's JVM happens to collect its garbage, and
    a chain of written layers holds the shuffles of all of them on disk at once."""
    with _setting(spark, _CLEANUP, "true"):
        yield


# Fixed value: Spark's setting by which sides of a join that lie together by some of
# its keys are shuffled again by all of them.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextlib.contextmanager
def clustered_joins(spark: SparkSession) -> Iterator[None]:
    """Joins of queries started in this block leave rows where they lie together by some of the join's keys."""
    with _setting(spark, _ALL_KEYS, "false"):
        yield


_settings: dict[tuple[str, str], list] = {}
_settings_lock = threading.Lock()


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a block.  Blocks of several threads may
    overlap: the last one to end restores what the first one found."""
    at = (spark._jsparkSession.sessionUUID(), key)
    with _settings_lock:
        held = _settings.setdefault(at, [0, spark.conf.get(key)])
        held[0] += 1
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _settings_lock:
            held[0] -= 1
            if not held[0]:
                del _settings[at]
                spark.conf.set(key, held[1])


_MB = 1024 * 1024


def scale_conf(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 * _MB,
    max_shuffle_partitions: int = 200_000,
) -> dict[str, str]:
    """Sizing for a cluster run, to pass as ``extra_conf`` of :func:`build_session`.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` so a
    task's working set fits executor memory and spills rarely; the initial
    shuffle partition count covers the whole input at that size (at least two
    waves of task slots, at most ``max_shuffle_partitions`` to bound shuffle
    metadata: inputs above that many targets, 51 TB by default, get larger
    partitions unless the parameter is raised), and AQE coalesces whatever the partial aggregations shrink.
    Skew splitting triggers at four times the target.

    100 TB on 1000 executors x 8 cores -> 200,000 initial partitions of
    ~512 MB input each.
    """
    slots = max(1, executors * cores_per_executor)
    wanted = -(-input_bytes // target_partition_bytes)
    partitions = int(min(max(wanted, 2 * slots), max_shuffle_partitions))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * _MB),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
