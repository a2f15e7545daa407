"""Data-quality metrics returned as DataFrames (one aggregation pass each)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiersmith.operators.cleanse import dated_lines
from tiersmith.operators.dedup import _long


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for every column, from a single aggregate."""
    cols = list(columns) if columns is not None else df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "null_count")


def metric_inconsistencies(df: DataFrame, months: Sequence[str] = ("orders_last_month", "orders_last_6_months",
                                                                  "orders_total")) -> DataFrame:
    """Rows breaking ``last_month <= last_6_months <= total`` (any adjacent pair)."""
    cond = None
    for a, b in zip(months, months[1:]):
        c = F.col(a) > F.col(b)
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def cleanse_metrics(
    source: DataFrame,
    row_key: str = "Row ID",
    order_date: str = "Order Date",
    ship_date: str = "Ship Date",
) -> DataFrame:
    """Silver run metrics as ``(metric, value bigint)`` rows.

    The survivors of :func:`cleanse` are chosen by their dates first, so the
    key and the dates are all that is read and shuffled: one aggregation per
    key (partial before the shuffle) and one global one.
    """
    lines = dated_lines(source.select(row_key, order_date, ship_date), row_key, order_date, ship_date)
    order, ship = F.col(order_date), F.col(ship_date)
    ranked = F.struct(order.isNull(), order.alias("o"), F.col("_ship").isNull(), F.col("_ship"), ship.isNull(), ship.alias("s"))
    usable = F.col("_row").isNotNull()
    kept = (lines.where(usable).groupBy("_row").agg(F.min(ranked).alias("f"), F.count(F.lit(1)).alias("n"))
            .union(lines.where(~usable).select("_row", ranked, F.lit(1).cast("bigint"))))
    o, s = F.col("f.o"), F.col("f.s")
    one = kept.agg(
        F.sum("n").alias("source_records"),
        F.sum(F.col("n") - 1).alias("duplicates_removed"),
        F.count_if(F.col("_row").isNull()).alias("invalid_row_ids"),
        F.count_if(o.isNull()).alias("invalid_order_dates"),
        F.count_if(s.isNull()).alias("invalid_ship_dates"),
        F.count_if(o.isNull()).alias("null_order_dates_removed"),
        F.count_if(o.isNotNull() & (s < o)).alias("invalid_ship_dates_before_order"),
        F.count_if(o.isNotNull()).alias("final_records"),
    ).withColumn("records_removed", F.col("source_records") - F.col("final_records"))
    return _long(one, ["source_records", "duplicates_removed", "invalid_row_ids", "invalid_order_dates", "invalid_ship_dates",
                       "null_order_dates_removed", "invalid_ship_dates_before_order", "final_records",
                       "records_removed"])


def schema_report(spark: SparkSession, df: DataFrame, expected: Sequence[str] | StructType) -> DataFrame:
    """Expected vs actual columns: ``(column_name, status)`` with status
    ``present``, ``missing`` or ``extra``.  Built from schema metadata only."""
    names = expected.fieldNames() if isinstance(expected, StructType) else list(expected)
    actual = df.columns
    rows = [(c, "present" if c in actual else "missing") for c in names]
    rows += [(c, "extra") for c in actual if c not in names]
    return spark.createDataFrame(rows, "column_name string, status string")


def schema_check(spark: SparkSession, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required-column validation as a frame ``(column_name, present)``;
    :func:`tiersmith.operators.cleanse.validate_required_columns` raises instead."""
    return spark.createDataFrame([(c, c in df.columns) for c in required], "column_name string, present boolean")
