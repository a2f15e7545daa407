"""Deterministic "first row per key" and duplicate accounting.

The survivor of each key group is the row that sorts first by ``order_by``
and then by every remaining column (ascending; nulls first, but last in the
``nulls_last`` columns), so the result never depends on input order or
partitioning.  It is computed as
``min(struct(order_by..., rest...))`` grouped by the key: Spark aggregates
partially on the map side before the shuffle, so a key holding a large share
of all rows reaches the reducer as at most one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    group_size_col: str | None = None,
    nulls_last: Sequence[str] = (),
    candidates: Column | None = None,
) -> DataFrame:
    """One row per distinct ``keys`` (null keys form one group, as in
    ``dropDuplicates``), keeping the first row in the total order
    ``order_by`` + all other columns.  Column order is preserved.

    ``group_size_col`` adds the number of input rows of each group.  With
    ``candidates`` only rows that pass this test are compared and shuffled, and
    groups without one give no row.
    """
    keys = list(keys)
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [x for c in order for x in ([F.col(c).isNull().alias(f"_no_{c}"), F.col(c)] if c in nulls_last else [F.col(c)])]
    row = F.struct(*ranked, *[F.col(c) for c in rest])
    aggs = [F.min(row if candidates is None else F.when(candidates, row)).alias("_first")]
    if group_size_col:
        aggs.append(F.count(F.lit(1)).alias(group_size_col))
    grouped = df.groupBy(*keys).agg(*aggs)
    if candidates is not None:
        grouped = grouped.where(F.col("_first").isNotNull())
    out = [F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns]
    if group_size_col:
        out.append(F.col(group_size_col))
    return grouped.select(*out)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long-format ``(metric, value)``: ``records``, ``distinct_keys`` and
    ``duplicates`` (= records - distinct keys; a null key counts as one key,
    as in ``dropDuplicates``).  Two aggregations, the first partial on the
    map side, no join."""
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.agg(
        F.sum("_n").cast("bigint").alias("records"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
    ).withColumn("duplicates", F.col("records") - F.col("distinct_keys"))
    return _long(totals, ["records", "distinct_keys", "duplicates"])


def _long(one_row: DataFrame, metrics: Sequence[str], value_type: str = "bigint") -> DataFrame:
    """Turn a one-row frame of metrics into ``(metric string, value)`` rows."""
    return one_row.select(
        *[F.coalesce(F.col(m).cast(value_type), F.lit(0).cast(value_type)).alias(m) for m in metrics]
    ).unpivot([], list(metrics), "metric", "value")
