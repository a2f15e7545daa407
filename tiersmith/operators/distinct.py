"""Distinct counts over any span of days from a state kept per day.

Distinct counts of days cannot be added up, so each day keeps what can be
merged exactly: of whole numbers bitmaps (4 KB per 32,768 neighbouring
values), of all other types the day's distinct values as text.  A span reads
the state of its days only, not the lines; a day that is delivered again
replaces its own state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tiersmith.functions.dates import date_from_keys, partition_keys
from tiersmith.sources.files import PARTITION_COLUMNS, write_partitioned


def _named_values(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """One row per line and column: ``column_name`` and ``value``, without nulls."""
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(*PARTITION_COLUMNS, F.inline(values)).where(F.col("value").isNotNull())


def distinct_state(df: DataFrame, columns: Sequence[str], date_col: str = "order_date") -> DataFrame:
    """``year, month, day, column_name, bucket, bitmap, value``: a row per
    bucket of numbers with its bitmap, or per distinct text.  Lines without a
    date are in the state of the null day.  The numbers and the texts are a
    pass each, reduced before their shuffle."""
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, IntegralType)]
    texts = [c for c in columns if c not in numbers]
    days = df.select(*columns, *[k.alias(n) for n, k in partition_keys(date_col).items()])
    keys, parts = [*PARTITION_COLUMNS, "column_name"], []
    if numbers:
        parts.append(_named_values(days, numbers, "bigint").groupBy(*keys, F.bitmap_bucket_number("value").alias("bucket"))
                     .agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bitmap"))
                     .withColumn("value", F.lit(None).cast("string")))
    if texts:
        parts.append(_named_values(days, texts, "string").distinct()
                     .select(*keys, F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bitmap"), "value"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def write_distinct_state(df: DataFrame, path: str, columns: Sequence[str], date_col: str = "order_date", dynamic: bool = True) -> None:
    """Write the state of the days in ``df``; with ``dynamic`` those of other days stay."""
    write_partitioned(distinct_state(df, columns, date_col), path, dynamic=dynamic)


def distinct_between(state: DataFrame, columns: Sequence[str], start: Column | str | None = None,
                     end: Column | str | None = None) -> DataFrame:
    """``(column_name, distinct_values)`` of each column over the days from
    ``start`` to ``end`` (without bounds: all, undated lines too), equal to
    :func:`tiersmith.operators.reports.distinct_counts` of their lines.  The
    bounds prune the state's folders."""
    day = date_from_keys()
    for bound, inside in ((start, day.__ge__), (end, day.__le__)):
        if bound is not None:
            state = state.where(inside(F.lit(bound).cast("date") if isinstance(bound, str) else bound))
    numbers = (state.where(F.col("bitmap").isNotNull()).groupBy("column_name", "bucket").agg(F.bitmap_or_agg("bitmap").alias("merged"))
               .groupBy("column_name").agg(F.sum(F.bitmap_count("merged")).alias("n")))
    texts = state.where(F.col("value").isNotNull()).groupBy("column_name").agg(F.count_distinct("value").alias("n"))
    one = numbers.union(texts).agg(*[
        F.coalesce(F.max(F.when(F.col("column_name") == c, F.col("n"))), F.lit(0)).cast("bigint").alias(c) for c in columns])
    return one.unpivot([], list(columns), "column_name", "distinct_values")
