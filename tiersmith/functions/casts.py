"""Casts that turn bad input into null instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(c: Column | str, to: str) -> Column:
    """``try_cast``: ``'abc'`` -> null for numeric/date targets, no exception."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(to)
