"""File sources and sinks: the raw CSV feed and the day-partitioned parquet
layers (bronze, silver, gold)."""

from __future__ import annotations

import contextlib
import functools
import zlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tiersmith.session import clustered_joins, compiled_stages, tidy_jobs

# The raw feed's columns and read types.  Dates stay text at
# this point; parsing happens in silver (or in bronze for the partition key).
SOURCE_SCHEMA = StructType([
    StructField("Row ID", LongType()),
    StructField("Order ID", StringType()),
    StructField("Order Date", StringType()),
    StructField("Ship Date", StringType()),
    StructField("Ship Mode", StringType()),
    StructField("Customer ID", StringType()),
    StructField("Customer Name", StringType()),
    StructField("Segment", StringType()),
    StructField("Country", StringType()),
    StructField("City", StringType()),
    StructField("State", StringType()),
    StructField("Postal Code", StringType()),
    StructField("Region", StringType()),
    StructField("Product ID", StringType()),
    StructField("Category", StringType()),
    StructField("Sub-Category", StringType()),
    StructField("Product Name", StringType()),
    StructField("Sales", DoubleType()),
    StructField("Quantity", StringType()),
])

PARTITION_COLUMNS = ("year", "month", "day")
_CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType = SOURCE_SCHEMA, multi_line: bool = True,
             observation: Observation | None = None, file_column: str | None = None) -> DataFrame:
    """Header CSV, typed by column *name*: every column is read as text (no
    inference pass over the data), then each column named in ``schema`` is
    ``try_cast`` to its type -- a bad value becomes null instead of failing
    the job.  Optional columns may be absent and extra columns are kept as
    text; column order in the file does not matter, but all files of one read
    must have the same header: a file whose header differs stops the job with
    its name.

    Fields may be quoted, with quotes doubled inside; with ``multi_line`` they
    may hold line breaks.  Such a file is not split, so deliver many files
    rather than one large one, or pass ``False`` for files without line breaks
    in fields.  ``observation`` receives ``rows`` and ``malformed`` (rows with
    too few or too many fields) while the files are read.  ``file_column`` names
    a column for the path of each row's file."""
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
              .option("multiLine", multi_line).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    names = reader.csv(path).columns
    text = StructType([StructField(c, StringType()) for c in [*names, _CORRUPT]])
    raw = (reader.schema(text).option("enforceSchema", False).option("columnNameOfCorruptRecord", _CORRUPT).csv(path))
    if observation is not None:
        raw = raw.observe(observation, F.count(F.lit(1)).alias("rows"), F.count(_CORRUPT).alias("malformed"))
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        (F.col(f"`{c}`").try_cast(types[c]) if not isinstance(types[c], StringType) else F.col(f"`{c}`")).alias(c)
        if c in types else F.col(f"`{c}`")
        for c in names
    ], *([F.col("_metadata.file_path").alias(file_column)] if file_column else []))


def _first_line(spark: SparkSession, path) -> str:
    """First line of a file of Spark's file systems (an empty one gives '')."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        return jvm.java.io.BufferedReader(text).readLine() or ""
    finally:
        stream.close()


def csv_layouts(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """Files below ``path`` by their header line (one line); empty files are
    left out.  The driver reads the first line of each file, no more."""
    jvm = spark.sparkContext._jvm
    found: dict[str, list[str]] = {}
    for uri in sorted(spark.read.text(path).inputFiles()):
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        header = _first_line(spark, file).removeprefix("\ufeff").rstrip("\r")
        if header:
            found.setdefault(header, []).append(file.toString())
    return found


def read_csv_layouts(spark: SparkSession, path: str | Sequence[str], schema: StructType = SOURCE_SCHEMA, multi_line: bool = True,
                     file_column: str | None = None, layout_column: str | None = "_layout") -> DataFrame:
    """Like :func:`read_csv`, for deliveries whose headers differ: the files of
    each header are one read with their own column order, and the reads are
    united by name (columns that a layout lacks are null).  Declared columns
    come first, in their order; then extra ones by name.  ``layout_column``
    records each row's layout: the checksum of its header, which stays the same
    whatever other files come.  Nothing but empty files gives no rows."""
    layouts = csv_layouts(spark, path)
    reads = []
    for header, files in sorted(layouts.items()):
        rows = read_csv(spark, files, schema, multi_line, file_column=file_column)
        reads.append(rows.withColumn(layout_column, F.lit(f"{zlib.crc32(header.encode()):08x}")) if layout_column else rows)
    if not reads:
        added = [StructField(c, StringType()) for c in (file_column, layout_column) if c]
        return spark.createDataFrame([], StructType(schema.fields + added))
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reads)
    added = [c for c in (file_column, layout_column) if c]
    extra = sorted(set(rows.columns) - set(schema.fieldNames()) - set(added))
    return rows.select(*[F.col(f"`{c}`") for c in [*[c for c in schema.fieldNames() if c in rows.columns], *extra, *added]])


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, gzipped, that keeps text exactly (edge whitespace, quotes and
    line breaks included).  A file that may hold line breaks is not split
    anyway, so compression costs its readers no parallelism."""
    with compiled_stages(df.sparkSession), tidy_jobs(df.sparkSession):
        (df.write.mode("overwrite").option("compression", "gzip").option("header", True).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_layer(spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """A parquet layer; ``year/month/day`` directories become int columns.
    ``columns`` re-selects the original order (partition columns come last
    after a partitioned write).  A layer without rows has no files to take a
    schema from: it is read with the declared ``schema``, if one is given."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if schema is None or exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    mode: str = "overwrite",
    dynamic: bool = False,
    max_records_per_file: int = 5_000_000,
    observation=None,
    extra_metrics=(),
    clustered: bool = False,
) -> None:
    """Snappy parquet, one directory per partition value.

    Rows are ``rebalance``d on the partition columns first: adaptive execution
    then packs small days together and splits a day that is too large for one
    task into several files, so one hot day never lands in a single task.
    ``dynamic=True`` replaces only the partitions present in ``df`` (daily
    re-runs); otherwise the whole table is replaced.  ``mode="append"`` adds files.
    Rows that already lie together by partition value (``clustered``) are written
    where they are, without that shuffle.

    ``observation`` (a ``pyspark.sql.Observation``) receives ``rows``, the
    number of rows written, and any ``extra_metrics`` aggregate columns.  It
    is attached after the shuffle, in the writing (result) stage, whose
    metric updates Spark applies exactly once per partition even when tasks
    are retried or executors lost.
    """
    cols = list(partition_by)
    out = df.hint("rebalance", *cols) if cols and not clustered else df
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"), *extra_metrics)
    writer = (out.write.mode(mode).option("compression", "snappy")
              .option("maxRecordsPerFile", max_records_per_file)
              .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    if cols:
        writer = writer.partitionBy(*cols)
    spark = df.sparkSession
    with compiled_stages(spark), tidy_jobs(spark), clustered_joins(spark) if clustered else contextlib.nullcontext():
        writer.parquet(path)


def write_plain(df: DataFrame, path: str, mode: str = "overwrite", observation=None) -> None:
    """Unpartitioned snappy parquet (``observation`` as in :func:`write_partitioned`)."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    with tidy_jobs(df.sparkSession):
        df.write.mode(mode).option("compression", "snappy").parquet(path)


def count_rows(spark: SparkSession, path: str, schema: StructType | None = None) -> int:
    """Rows of a written parquet layer.  No column is read: Spark answers
    from the row-group metadata in the file footers."""
    return read_layer(spark, path, schema=schema).count()


def write_verified(df: DataFrame, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS,
                   name: str = "write") -> tuple[DataFrame, DataFrame]:
    """Write ``df`` and check the read-back.

    Returns ``(read_back, verification)``.  The written row count is observed
    in the writing stage itself (``Observation``, no second pass over ``df``); the
    verification frame compares it with the rows and columns read back:
    ``(rows_written, rows_read, columns_match)``.
    """
    from pyspark.sql import Observation

    spark = df.sparkSession
    obs = Observation(name)
    if partition_by:
        write_partitioned(df, path, partition_by, observation=obs)
    else:
        write_plain(df, path, observation=obs)
    written = obs.get["rows"]
    back = read_layer(spark, path, df.columns)
    same_cols = sorted(spark.read.parquet(path).columns) == sorted(df.columns)
    verification = back.agg(F.count(F.lit(1)).cast("bigint").alias("rows_read")).select(
        F.lit(written).cast("bigint").alias("rows_written"), "rows_read",
        F.lit(same_cols).alias("columns_match"))
    return back, verification


def read_first_existing(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Read the first of ``paths`` that exists (e.g. a preferred location
    with a fallback); any other error of that path is raised.  Only the driver
    lists folders; no data is read here."""
    last: Exception | None = None
    for p in paths:
        try:
            found = spark.read.parquet(p)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            last = exc
            continue
        return found.select(*columns) if columns else found
    raise FileNotFoundError(f"none of {list(paths)} exists") from last
