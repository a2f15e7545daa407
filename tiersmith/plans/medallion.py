"""The four layer jobs and the run that chains them.

Layers talk only through parquet directories (and optionally catalog
tables), so each job can be re-run on its own after a failure.  Every job
writes in one of three modes: ``replace`` the table, replace the ``days`` that
its input holds (a daily run that keeps the other days), or, for bronze,
``append``.  Rows written are observed in the writing stage (``Observation``,
once per partition); source rows are observed while they are read, so they
come out too high if an executor is lost and its part is read again; rows read
from a layer come from its parquet footers, not from a pass over the data.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tiersmith.functions.dates import parse_date, parse_date_or_fail, partition_keys
from tiersmith.functions.text import strip_whitespace
from tiersmith.operators.cleanse import cleanse
from tiersmith.operators.customers import customer_metrics
from tiersmith.operators.quarantine import KEPT, VERDICT, judged_lines
from tiersmith.operators.sales import sales_orders
from tiersmith.session import staging
from tiersmith.sources.catalog import BRONZE_TABLE, SILVER_TABLE
from tiersmith.sources.files import PARTITION_COLUMNS, count_rows, read_csv, read_layer, write_partitioned

MODES = ("replace", "days", "append")

# Folder name of each layer under the lake root.
LAYER_DIRS = {
    "bronze": "bronze/retail_sales",
    "silver": "silver/retail_sales",
    "gold_sales": "gold/sales",
    "gold_customer": "gold/customer",
}


@dataclass
class StageResult:
    stage: str
    records_in: int
    records_out: int
    path: str
    latest_order_date: _dt.date | None = None
    malformed: int = 0
    duplicates: int = 0
    rejected: int = 0


def _write_mode(mode: str) -> dict:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return {"mode": "append" if mode == "append" else "overwrite", "dynamic": mode == "days"}


def _write_counted(df: DataFrame, path: str, name: str, mode: str = "replace", partition_by=PARTITION_COLUMNS) -> int:
    """Write and return the rows written (observed in the writing stage)."""
    obs = Observation(name)
    write_partitioned(df, path, partition_by, observation=obs, **_write_mode(mode))
    return int(obs.get["rows"])


def _write_silver(df: DataFrame, path: str, mode: str = "replace") -> tuple[int, _dt.date | None]:
    """Write silver that lies clustered by day; observe rows written and the latest order date (``max``
    is exact even if a stage is retried), which becomes gold's anchor."""
    obs = Observation("silver_out")
    write_partitioned(df, path, PARTITION_COLUMNS, observation=obs, clustered=True,
                      extra_metrics=[F.max("order_date").alias("latest")], **_write_mode(mode))
    got = obs.get
    return int(got["rows"]), got.get("latest")


def bronze_frame(source: DataFrame, on_bad_date: str = "fail", date_col: str = "Order Date") -> DataFrame:
    """Source rows plus ``year/month/day`` of the order date.  ``on_bad_date``:
    ``fail`` stops the job on an unparseable date, ``null`` keeps the row in
    the null partition."""
    if on_bad_date not in ("fail", "null"):
        raise ValueError("on_bad_date must be 'fail' or 'null'")
    parse = parse_date_or_fail if on_bad_date == "fail" else parse_date
    d = parse(strip_whitespace(date_col))
    return source.withColumns(partition_keys(d))


def ingest_bronze(spark: SparkSession, source_path: str, out_path: str, on_bad_date: str = "fail",
                  source: DataFrame | None = None, mode: str = "replace", delivery: str | None = None,
                  file_column: str | None = None) -> StageResult:
    """CSV (or a given source frame) -> day-partitioned bronze parquet.
    ``mode='days'`` replaces only the days of this delivery, ``'append'`` adds
    to what is there.  Undated rows belong to no day: in ``days`` mode those of
    other deliveries stay, those that an earlier run of this ``delivery`` left
    are replaced.  A delivery is named by ``source_path`` unless a name is
    given; an unnamed frame goes by its first and last day, which takes a pass.
    ``file_column`` names a column for the path of each row's CSV file."""
    read = Observation("bronze_in")
    if source is not None:
        src = source.observe(read, F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("malformed"))
    else:
        src = read_csv(spark, source_path, observation=read, file_column=file_column)
    frame = bronze_frame(src, on_bad_date)
    if mode == "days" and on_bad_date == "null":
        if not (delivery or source_path):
            day = F.make_date("year", "month", "day")
            delivery = "..".join(str(d) for d in bronze_frame(source, on_bad_date).agg(F.min(day), F.max(day)).first())
        n = _write_days(spark, frame, out_path, delivery or source_path)
    else:
        n = _write_counted(frame, out_path, "bronze", mode)
    return StageResult("bronze", int(read.get["rows"]), n, out_path, malformed=int(read.get["malformed"] or 0))


def _write_days(spark: SparkSession, frame: DataFrame, out_path: str, delivery: str) -> int:
    """Replace the days of ``frame``, and the undated rows of its delivery.

    A record of each delivery's undated rows lies in a folder of the table that
    readers skip.  It is written after the table: a run that dies in between
    must be run again under the same name before the next delivery, and may
    leave its own undated rows twice until the run after that."""
    record = f"{out_path}/_undated/{hashlib.sha256(delivery.encode()).hexdigest()[:32]}"
    undated = F.col("year").isNull()

    def undated_rows(path: str) -> DataFrame:
        try:
            return spark.read.schema(frame.schema).parquet(path).where(undated).select(*frame.columns)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], frame.schema)

    with staging(spark) as stage:
        # Written first, since the partition they are read from is written again.
        kept = stage(undated_rows(out_path).exceptAll(undated_rows(record)))
        n = _write_counted(frame.unionByName(kept), out_path, "bronze", "days") - kept.count()
        undated_rows(out_path).exceptAll(kept).write.mode("overwrite").parquet(record)
    return n


def silver_frame(bronze: DataFrame, strict: bool = False, stage: Callable[[DataFrame], DataFrame] | None = None,
                 only: DataFrame | None = None) -> DataFrame:
    """Bronze rows -> cleansed silver rows with partition columns; with ``stage``
    (:func:`tiersmith.session.staging`) clustered by them, to be written at once,
    and if asked for ``only`` the lines of some row ids (``_row``) and those without one."""
    src = bronze.drop(*[c for c in PARTITION_COLUMNS if c in bronze.columns])
    return cleanse(src, strict=strict, stage=stage, only=only).withColumns(partition_keys("order_date"))


def build_silver(spark: SparkSession, bronze_path: str, out_path: str, strict: bool = False,
                 records_in: int | None = None, mode: str = "replace") -> StageResult:
    """``records_in`` may pass the bronze count already known (else it is read
    from the bronze footers).  All of bronze is cleansed; to bring only what
    changed up to date see :mod:`tiersmith.streaming.incremental`."""
    bronze = read_layer(spark, bronze_path, schema=BRONZE_TABLE)
    with staging(spark) as stage:
        n_out, latest = _write_silver(silver_frame(bronze, strict, stage), out_path, mode)
    n_in = records_in if records_in is not None else count_rows(spark, bronze_path, BRONZE_TABLE)
    return StageResult("silver", n_in, n_out, out_path, latest)


def build_silver_quarantined(spark: SparkSession, bronze_path: str, out_path: str, strict: bool = False,
                             source: DataFrame | None = None) -> StageResult:
    """Silver and what it refuses, from bronze (or ``source``), which is read for
    its row ids and dates and once more whole, and one write: ``verdict=kept`` holds the days of silver, ``verdict=rejected``
    the days of the refused lines with their reasons
    (:func:`tiersmith.operators.quarantine.judged_lines`; read them with
    :func:`read_judged`).  ``records_in`` comes from the footers of bronze, the
    others are counted while writing: ``records_in == records_out + duplicates
    + rejected`` (of a given ``source``, which has no footers, it is their sum)."""
    written = Observation("judged_out")
    src = source if source is not None else read_layer(spark, bronze_path, schema=BRONZE_TABLE)
    kept = F.col(VERDICT) == KEPT
    with staging(spark) as stage:
        judged = judged_lines(src.drop(*PARTITION_COLUMNS), strict=strict, stage=stage)
        judged = judged.withColumns(partition_keys(F.coalesce("order_date", "ship_date")))
        write_partitioned(judged, out_path, [VERDICT, *PARTITION_COLUMNS], observation=written, clustered=True, extra_metrics=[
            F.count_if(kept).alias("kept"), F.sum(F.col("copies") - 1).alias("duplicates"), F.max(F.when(kept, F.col("order_date"))).alias("latest")])
    got = written.get
    rows, n_out, duplicates = (int(got[c] or 0) for c in ("rows", "kept", "duplicates"))
    n_in = rows + duplicates if source is not None else count_rows(spark, bronze_path, BRONZE_TABLE)
    return StageResult("silver", n_in, n_out, out_path, got.get("latest"), duplicates=duplicates, rejected=rows - n_out)


def read_judged(spark: SparkSession, path: str, verdict: str) -> DataFrame:
    """The lines of one verdict (only its folders are read); of kept ones the
    columns of silver, of rejected ones also their reasons and texts."""
    more = [StructField(VERDICT, StringType()), StructField("copies", LongType()), StructField("reason", StringType())]
    rows = read_layer(spark, path, schema=StructType(SILVER_TABLE.fields + more))
    rows = rows.where(F.col(VERDICT) == verdict).drop(VERDICT)
    return rows.drop("reason", "copies", *[c for c in rows.columns if c.endswith("_text")]) if verdict == KEPT else rows


def gold_sales_frame(silver: DataFrame) -> DataFrame:
    return sales_orders(silver).withColumns(partition_keys("order_date"))


def build_gold_sales(spark: SparkSession, silver_path: str, out_path: str,
                     records_in: int | None = None, mode: str = "replace") -> StageResult:
    silver = read_layer(spark, silver_path, schema=SILVER_TABLE)
    n_out = _write_counted(gold_sales_frame(silver), out_path, "sales_out", mode)
    n_in = records_in if records_in is not None else count_rows(spark, silver_path, SILVER_TABLE)
    return StageResult("gold_sales", n_in, n_out, out_path)


def gold_customer_frame(silver: DataFrame, anchor: _dt.date | str | None = None, by: str = "first") -> DataFrame:
    """Customer metrics partitioned by the customer's first order date
    (``by='latest'``: latest order date); the helper dates are dropped."""
    if by not in ("first", "latest"):
        raise ValueError("by must be 'first' or 'latest'")
    m = customer_metrics(silver, anchor=anchor, keep_order_dates=True)
    d = "first_order_date" if by == "first" else "latest_order_date"
    return m.withColumns(partition_keys(d)).drop("first_order_date", "latest_order_date")


def build_gold_customer(spark: SparkSession, silver_path: str, out_path: str,
                        anchor: _dt.date | str | None = None, records_in: int | None = None,
                        by: str = "first", mode: str = "replace") -> StageResult:
    """``anchor=None``: the latest order date in silver (a one-column scan
    inside the plan).  ``by``: partition by each customer's ``first`` or
    ``latest`` order date."""
    silver = read_layer(spark, silver_path, schema=SILVER_TABLE)
    n_out = _write_counted(gold_customer_frame(silver, anchor, by), out_path, "customer_out", mode)
    n_in = records_in if records_in is not None else count_rows(spark, silver_path, SILVER_TABLE)
    return StageResult("gold_customer", n_in, n_out, out_path)


def run_medallion(spark: SparkSession, source_path: str | None, lake_root: str, anchor=None,
                  source: DataFrame | None = None, on_bad_date: str = "fail",
                  parallel_gold: bool = False, database: str | None = None, mode: str = "replace") -> DataFrame:
    """Bronze -> silver -> gold sales and gold customer on one session.
    ``on_bad_date`` is the bronze rule (``fail`` by default, ``null`` keeps
    such rows in the null partition; silver drops them either way).
    Returns ``(stage, records_in, records_out, malformed_rows, success_rate)``
    (success rate = out / in x 100, rounded to 4 places, null without input);
    any failure propagates (fail fast).  ``mode='days'`` replaces only the days
    of this delivery in bronze and rebuilds the layers above.  The two gold jobs depend only on silver: with
    ``parallel_gold`` they are submitted concurrently from two driver threads
    and share the cluster.  ``database`` also registers the four layers as
    catalog tables."""
    paths = {k: os.path.join(lake_root, v) for k, v in LAYER_DIRS.items()}
    bronze = ingest_bronze(spark, source_path or "", paths["bronze"], on_bad_date, source, mode)
    known = bronze.records_out if mode == "replace" else None
    silver = build_silver(spark, paths["bronze"], paths["silver"], records_in=known)
    results = [bronze, silver]
    # the anchor observed while writing silver spares gold a scan of silver
    gold_anchor = anchor if anchor is not None else silver.latest_order_date
    gold = [lambda: build_gold_sales(spark, paths["silver"], paths["gold_sales"], records_in=silver.records_out),
            lambda: build_gold_customer(spark, paths["silver"], paths["gold_customer"], gold_anchor,
                                        records_in=silver.records_out)]
    if parallel_gold:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=2) as pool:
            futures = [pool.submit(job) for job in gold]
            results.extend(f.result() for f in futures)
    else:
        results.extend(job() for job in gold)
    if database:
        from tiersmith.sources.catalog import register_layers

        register_layers(spark, database, paths)
    rows = [(r.stage, r.records_in, r.records_out, r.malformed) for r in results]
    summary = spark.createDataFrame(rows, "stage string, records_in bigint, records_out bigint, malformed_rows bigint")
    rate = F.try_divide(F.col("records_out").cast("double") * 100, F.col("records_in"))
    return summary.withColumn("success_rate", F.round(rate, 4))
