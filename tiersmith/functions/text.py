"""String column functions and column-name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the whitespace characters stripped from text edges (space,
# tab, newline, vertical tab, form feed, carriage return).
WHITESPACE = " \t\n\u000b\f\r"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c: ColumnOrName) -> Column:
    """Remove all leading/trailing whitespace (plain ``trim`` only removes
    spaces).  ``btrim`` with an explicit character set: no regex per row."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def snake_case(name: str) -> str:
    """Column-name rule: every run of non-alphanumerics becomes ``_``, lower case,
    no leading/trailing ``_``: ``'Sub-Category'`` -> ``'sub_category'``."""
    return re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()


def first_name(c: ColumnOrName) -> Column:
    """Text before the first space (the whole text when there is none)."""
    return F.split(_col(c), " ", 2).getItem(0)


def rest_name(c: ColumnOrName) -> Column:
    """Text after the first space; ``''`` for a single word, null for null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.coalesce(F.get(F.split(c, " ", 2), 1), F.lit("")))


def last_token(c: ColumnOrName) -> Column:
    """Last space-separated token; a single name is its own last token."""
    return F.element_at(F.split(_col(c), " "), -1)
