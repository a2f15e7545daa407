"""Lines that silver refuses, kept with the reason instead of being dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tiersmith.functions.text import snake_case
from tiersmith.operators.cleanse import SILVER_CASTS, deduplicated_lines, fix_ship_date, validate_required_columns

# The verdict column, which becomes the first partition folder, and its values.
VERDICT, KEPT, REJECTED = "verdict", "kept", "rejected"


def judged_lines(df: DataFrame, row_key: str = "Row ID", order_date: str = "Order Date", ship_date: str = "Ship Date",
                 strict: bool = False, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What :func:`tiersmith.operators.cleanse.cleanse` makes of ``df``, with
    the lines that it drops: ``verdict`` is ``kept`` or ``rejected``.

    ``copies`` is the number of source lines that a line stands for, so its sum
    over all verdicts is the number of source lines.  ``reason`` (null if kept)
    names each missing value: ``no <column>`` for a blank, ``unreadable
    <column>`` for a text that gives no value.  The texts that dates and
    numbers were read from stay as ``<column>_text`` (trimmed; null if kept).
    A rejected line had no better copy: copies that another one outranks are
    duplicates, whatever they hold.  Same single shuffle as ``cleanse``; with
    ``stage`` it is to the day of a partitioned write, as there.
    """
    validate_required_columns(df)
    texts = [c for c in df.columns if c in (order_date, ship_date)
             or snake_case(c) in SILVER_CASTS and isinstance(df.schema[c].dataType, StringType)]
    lines = deduplicated_lines(df.withColumns({f"{c} Text": F.col(f"`{c}`") for c in texts}), row_key, order_date, ship_date, "copies", stage=stage)
    needed = [snake_case(order_date)] + [c for c in (snake_case(ship_date), "sales", "quantity") if strict and c in lines.columns]

    def refusal(c: str):
        read = F.coalesce(F.col(f"{c}_text"), F.lit("")) != "" if f"{c}_text" in lines.columns else F.lit(False)
        return F.when(F.col(c).isNull(), F.when(read, F.lit(f"unreadable {c}")).otherwise(F.lit(f"no {c}")))

    refused = F.col("reason").isNotNull()
    judged = lines.withColumn("reason", F.nullif(F.concat_ws(", ", *[refusal(c) for c in needed]), F.lit("")))
    judged = judged.withColumns({f"{snake_case(c)}_text": F.when(refused, F.col(f"{snake_case(c)}_text")) for c in texts})
    judged = judged.withColumn(VERDICT, F.when(refused, F.lit(REJECTED)).otherwise(F.lit(KEPT)))
    return fix_ship_date(judged, snake_case(ship_date), snake_case(order_date))


def verdict_counts(judged: DataFrame) -> DataFrame:
    """Lines, the source lines they stand for, and duplicates, per verdict and reason."""
    return judged.groupBy(VERDICT, "reason").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("copies").alias("source_lines"), F.sum(F.col("copies") - 1).alias("duplicates"))
