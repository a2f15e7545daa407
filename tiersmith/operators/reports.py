"""Reports over the gold tables: distributions, statistics, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ship_mode_distribution(sales: DataFrame) -> DataFrame:
    """Orders per shipment mode, most frequent first."""
    return (sales.groupBy("shipment_mode").agg(F.count(F.lit(1)).cast("bigint").alias("orders"))
            .orderBy(F.desc("orders"), F.asc("shipment_mode")))


def segment_distribution(customers: DataFrame) -> DataFrame:
    """Customers and mean total orders per segment, largest segment first."""
    return (customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"),
        F.round(F.avg("orders_total"), 6).alias("avg_orders"))
        .orderBy(F.desc("customers"), F.asc("customer_segment")))


def customer_stats(customers: DataFrame) -> DataFrame:
    """Mean/max order counts over all customers (one row)."""
    return customers.agg(
        F.round(F.avg("orders_total"), 6).alias("avg_total"),
        F.max("orders_total").cast("bigint").alias("max_total"),
        F.round(F.avg("orders_last_6_months"), 6).alias("avg_6m"),
        F.round(F.avg("orders_last_month"), 6).alias("avg_1m"),
    )


def customer_summary(customers: DataFrame) -> DataFrame:
    """``unique_customers`` and the sum of their total orders (one row)."""
    return customers.agg(
        F.count(F.lit(1)).cast("bigint").alias("unique_customers"),
        F.sum("orders_total").cast("bigint").alias("total_orders"),
    )


def active_customers(customers: DataFrame) -> DataFrame:
    """Customers with orders in the last month / 6 months, and their share (%;
    null without customers)."""
    n = F.count(F.lit(1))
    m1 = F.count_if(F.col("orders_last_month") > 0)
    m6 = F.count_if(F.col("orders_last_6_months") > 0)
    return customers.agg(
        n.cast("bigint").alias("customers"),
        m1.cast("bigint").alias("active_last_month"),
        m6.cast("bigint").alias("active_last_6_months"),
        F.round(F.try_divide(m1.cast("double") * 100, n), 4).alias("pct_active_last_month"),
        F.round(F.try_divide(m6.cast("double") * 100, n), 4).alias("pct_active_last_6_months"),
    )


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with most orders (ties: smaller id first).
    Planned as a single ``TakeOrderedAndProject``: each partition keeps its own
    top ``n`` before anything moves."""
    return (customers.select("customer_id", "customer_first_name", "customer_last_name",
                             "orders_last_month", "orders_last_6_months", "orders_total")
            .orderBy(F.desc("orders_total"), F.asc("customer_id")).limit(n))


def date_range(df: DataFrame, column: str = "order_date") -> DataFrame:
    """First and last date (one row)."""
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def distinct_counts(df: DataFrame, columns) -> DataFrame:
    """``(column_name, distinct_values)`` per column (nulls not counted), all
    from one aggregate over one scan of ``df``; Spark expands each row once
    per column and de-duplicates map-side before the shuffle."""
    columns = list(columns)
    one = df.agg(*[F.count_distinct(c).cast("bigint").alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "distinct_values")
