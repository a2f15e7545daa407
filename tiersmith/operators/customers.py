"""Gold customer: per-customer distinct-order counts over trailing months.

Plan shape (two hash shuffles, no joins, no ``Expand``):

1. ``groupBy(customer_id, order_id)`` -- partial aggregation on the map side --
   keeps each order's latest date plus, for every attribute, the earliest
   non-null value by ``(order_date, row_id)``;
2. ``groupBy(customer_id)`` counts orders conditionally on the order's latest
   date.  An order counts in a window if any of its lines falls in it.

A customer holding a large share of all rows is spread over all reducers in
step 1 (its key is paired with ``order_id``) and pre-aggregated per map
partition in step 2, so no task receives all its rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.dates import months_before
from tiersmith.functions.text import first_name, last_token, rest_name
from tiersmith.session import shared_dir

# Gold customer columns, in order.
GOLD_CUSTOMER_COLUMNS = (
    "customer_id", "customer_first_name", "customer_last_name", "customer_segment",
    "country", "orders_last_month", "orders_last_6_months", "orders_total",
)

_ATTRIBUTES = ("customer_name", "segment", "country")


def window_column(months: int) -> str:
    return "orders_last_month" if months == 1 else f"orders_last_{months}_months"


def parse_names(df: DataFrame, name_col: str = "customer_name", rule: str = "first_space") -> DataFrame:
    """Add ``customer_first_name`` / ``customer_last_name``.

    ``first_space``: split at the first space; the rest is the last name,
    ``''`` for a single word (``'A B C'`` -> ``A``, ``B C``).
    ``last_token``: first and last space-separated token; a single word is
    both (``'A B C'`` -> ``A``, ``C``; ``'Madonna'`` -> ``Madonna``, ``Madonna``).
    """
    if rule == "first_space":
        last = rest_name(name_col)
    elif rule == "last_token":
        last = last_token(name_col)
    else:
        raise ValueError(f"unknown name rule: {rule}")
    return df.withColumns({"customer_first_name": first_name(name_col), "customer_last_name": last})


def customer_orders(df: DataFrame) -> DataFrame:
    """One row per (customer, order) with the order's first and last date."""
    return df.groupBy("customer_id", "order_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def _earliest_non_null(attr: str, tie: Sequence[str]) -> Column:
    """min(struct(order_date, row_id, attr)) over rows where attr is non-null:
    the value of the earliest row, with the value itself as last tie-break."""
    fields = [F.col(c) for c in tie] + [F.col(attr).alias("v")]
    return F.min(F.when(F.col(attr).isNotNull(), F.struct(*fields)))


def anchor_date(df: DataFrame, date_col: str = "order_date") -> Column:
    """Latest date of ``df`` as a scalar subquery (evaluated once, inside the
    query; nothing is collected by the caller)."""
    return df.select(F.max(date_col)).scalar()


def customer_metrics(
    df: DataFrame,
    anchor: _dt.date | str | Column | None = None,
    months: Sequence[int] = (1, 6),
    inclusive: bool = True,
    name_rule: str = "first_space",
    tie_break: Sequence[str] = ("order_date", "row_id"),
    keep_order_dates: bool = False,
) -> DataFrame:
    """Silver order lines -> one row per non-null ``customer_id``.

    Counts distinct non-null ``order_id`` overall and in each trailing window
    ``order_date >= anchor - n months`` (``>`` when ``inclusive=False``).
    ``anchor=None`` uses the latest order date in ``df``, which reads ``df`` a
    second time; pass the date, or :func:`anchor_date` of a narrower table,
    where there is one.  Attributes are the
    first non-null value by ``tie_break``.  ``keep_order_dates`` adds
    ``first_order_date`` / ``latest_order_date`` (used to partition the table).
    """
    tie = [c for c in tie_break if c in df.columns]
    lines = df.filter(F.col("customer_id").isNotNull())
    per_order = lines.groupBy("customer_id", "order_id").agg(
        F.max("order_date").alias("_last"),
        F.min("order_date").alias("_first"),
        *[_earliest_non_null(a, tie).alias(f"_{a}") for a in _ATTRIBUTES],
    )
    if anchor is None:
        # latest date over all lines (one pruned column scan, partial max per
        # task, no shuffle of rows), shared by every window
        anchor = anchor_date(df)
    counts = []
    for m in months:
        start = months_before(anchor, m)
        in_window = (F.col("_last") >= start) if inclusive else (F.col("_last") > start)
        counts.append(F.count(F.when(in_window, F.col("order_id"))).cast("bigint").alias(window_column(m)))
    per_customer = per_order.groupBy("customer_id").agg(
        *[F.min(f"_{a}").alias(f"_{a}") for a in _ATTRIBUTES],
        *counts,
        F.count("order_id").cast("bigint").alias("orders_total"),
        F.min("_first").alias("first_order_date"),
        F.max("_last").alias("latest_order_date"),
    )
    named = parse_names(per_customer.withColumn("customer_name", F.col("_customer_name.v")),
                        rule=name_rule)
    cols = [
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("customer_first_name"),
        F.col("customer_last_name"),
        F.col("_segment.v").alias("customer_segment"),
        F.col("_country.v").alias("country"),
        *[F.col(window_column(m)) for m in months],
        F.col("orders_total"),
    ]
    if keep_order_dates:
        cols += [F.col("first_order_date"), F.col("latest_order_date")]
    return named.select(*cols)


def customer_left_join(df: DataFrame, anchor=None, months: Sequence[int] = (1, 6),
                       tie_break: Sequence[str] = ("order_date", "row_id")) -> DataFrame:
    """The join form, kept as a user-level operator: attributes left-joined
    with one count aggregate per window, missing counts 0.  Every side comes
    from one written table of a row per (customer, order), so the lines are
    read once.  Prefer :func:`customer_metrics` (same result, no joins)."""
    tie = [c for c in tie_break if c in df.columns]
    shared_dir(df.sparkSession)  # a checkpoint folder is needed
    orders = df.groupBy("customer_id", "order_id").agg(
        F.max("order_date").alias("_last"), *[_earliest_non_null(a, tie).alias(f"_{a}") for a in _ATTRIBUTES],
    ).checkpoint()
    if anchor is None:
        anchor = orders.select(F.max("_last")).scalar()
    orders = orders.filter(F.col("customer_id").isNotNull())
    attrs = parse_names(orders.groupBy("customer_id").agg(
        *[F.min(f"_{a}").alias(f"_{a}") for a in _ATTRIBUTES]
    ).withColumn("customer_name", F.col("_customer_name.v"))).select(
        "customer_id", "customer_first_name", "customer_last_name",
        F.col("_segment.v").alias("customer_segment"), F.col("_country.v").alias("country"))
    out = attrs
    for m in months:
        w = orders.filter(F.col("_last") >= months_before(anchor, m)).groupBy("customer_id").agg(
            F.count("order_id").cast("bigint").alias(window_column(m)))
        out = out.join(w, "customer_id", "left")
    total = orders.groupBy("customer_id").agg(F.count("order_id").cast("bigint").alias("orders_total"))
    out = out.join(total, "customer_id", "left")
    return out.fillna(0, subset=[window_column(m) for m in months] + ["orders_total"])
