"""Helpers shared by the operators: durable cuts of the lineage, gapless
ranks without a hot group, deterministic bounded samples, text patterns."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiersmith.session import fresh_path, shared_dir

# Fixed value: a word is a run without space, tab, newline, VT, FF or CR.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Bits of monotonically_increasing_id below the partition number.
RID_BITS = 33


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of the session: what follows
    reads the written rows, so row ids and samples stay the same when an
    executor is lost, and nothing upstream is computed twice."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    release(df.sparkSession)
    return out


class Scratch:
    """Tables written one after the other into a folder of their own in the
    shared folder, and read back with the size of their files.  (A checkpoint
    keeps the estimated size of its plan, and such estimates multiply with
    every join: a chain of rounds ends in numbers of millions of digits.)"""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.count = spark, fresh_path(spark, name), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage.  Spark removes the shuffle files and
    checkpoints of plans that nobody holds any more only once the driver's JVM
    has collected them, by default every half hour; a chain of many short jobs
    would pile them up on the executors' disks until then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """While it lasts, Python gets that many rows at a time: the working sets
    of texts and their tokens are a batch each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidied(run):
    """For a function over batches: once it ends, its memory goes back to the
    system.  Python workers are reused, and what each kind of work leaves
    unused in them would add up from stage to stage."""
    @functools.wraps(run)
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidy


def with_rid(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Adds a unique row id.  It depends on the partitioning: materialize
    before the id is used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def gapless_rank(df: DataFrame, keys: Sequence[str], name: str, rid: str = "_rid") -> DataFrame:
    """Adds ``name``: a gapless rank from 0 within ``keys``.

    ``df`` must be materialized and carry ``rid`` from :func:`with_rid`.  Rows
    are ranked within (keys, partition of the row id), so no task gets more
    rows of one key than one input partition held; the offsets of these
    pieces come from their counts (pre-aggregated, one row per piece).
    """
    keys = list(keys)
    rows = df.withColumn("_piece", F.shiftright(rid, RID_BITS))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))).drop("_n"))
    inside = Window.partitionBy(*keys, "_piece").orderBy(rid)
    return (rows.join(offsets, [*keys, "_piece"])
            .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
            .drop("_piece", "_offset"))


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def sample_key(doc_id: str = "doc_id"):
    """Uniform in [0, 1), the same for an id wherever and whenever it is read."""
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def json_bytes(path: str) -> str:
    """Text of a vocabulary file, read once by the driver and sent to the
    tasks, so executors need no copy (a vocabulary is a few MB at any scale)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
