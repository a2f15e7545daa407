"""Partition keys, partition listings and pruned scans of day-partitioned layers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.functions.dates import date_from_keys, partition_keys

DateLike = _dt.date | str


def _as_date(d: DateLike) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d)


def add_partition_columns(df: DataFrame, date_col: str = "order_date", padded: bool = False) -> DataFrame:
    """Add ``year``, ``month``, ``day`` from a date column (ints, or two-digit
    strings for month/day when ``padded``)."""
    return df.withColumns(partition_keys(date_col, padded))


def partition_list(df: DataFrame) -> DataFrame:
    """Distinct ``(year, month, day)`` present in ``df``."""
    return df.select("year", "month", "day").distinct()


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per ``(year, month, day)`` -- what a write logs per partition."""
    return df.groupBy("year", "month", "day").agg(F.count(F.lit(1)).cast("bigint").alias("records"))


def partition_predicate(year: int | None = None, month: int | None = None, day: int | None = None):
    """Conjunction of equality tests on the given partition columns, as a
    ``Column`` (all-true when none are given)."""
    cond = F.lit(True)
    for name, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            cond = cond & (F.col(name) == F.lit(int(value)))
    return cond


def partition_predicate_sql(year: int | None = None, month: int | None = None, day: int | None = None) -> str:
    """The same test as SQL text (``year = 2018 AND month = 12``), for
    ``spark.sql`` or ``DataFrame.filter``; ``TRUE`` when nothing is given."""
    parts = [f"{n} = {int(v)}" for n, v in (("year", year), ("month", month), ("day", day)) if v is not None]
    return " AND ".join(parts) if parts else "TRUE"


def pruned_scan(spark: SparkSession, path: str, year: int | None = None, month: int | None = None,
                day: int | None = None) -> DataFrame:
    """Read only the directories matching the given year/month/day; the test
    appears as ``PartitionFilters`` in the plan, so other days are never listed
    into tasks or opened."""
    return spark.read.parquet(path).filter(partition_predicate(year, month, day))


def range_scan(spark: SparkSession, path: str, start: DateLike, end: DateLike) -> DataFrame:
    """Days ``start``..``end`` inclusive.  The bound is written on the
    partition columns (``make_date(year, month, day)``), so it prunes
    directories instead of filtering rows after reading them."""
    d = date_from_keys()
    return spark.read.parquet(path).filter(d.between(F.lit(_as_date(start)), F.lit(_as_date(end))))


def range_calendar(spark: SparkSession, start: DateLike, end: DateLike) -> DataFrame:
    """One row per day ``start``..``end`` inclusive (see :func:`calendar`)."""
    bounds = spark.range(1).select(F.lit(_as_date(start)).alias("start"), F.lit(_as_date(end)).alias("end"))
    return calendar(bounds)


def calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Expand each ``(start, end)`` row into its days: ``date, year, month,
    day, partition_path`` (``year=2001/month=06/day=30``, zero padded) --
    the partition directories a date range covers.  The array is as long as
    the date span (days), never proportional to the data."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.date_format("date", "'year='yyyy'/month='MM'/day='dd").alias("partition_path"),
    )
