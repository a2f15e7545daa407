"""Silver cleansing: trim, deduplicate rows, parse dates, repair ship dates,
cast, rename.  Each step is a lazy ``DataFrame -> DataFrame`` function."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tiersmith.functions.casts import safe_cast
from tiersmith.functions.dates import parse_date
from tiersmith.functions.text import snake_case, strip_whitespace
from tiersmith.operators.dedup import first_rows

# Source columns a raw file must have before cleansing.
REQUIRED_SOURCE_COLUMNS = (
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode",
    "Customer ID", "Customer Name", "Segment", "Country", "City",
)


def validate_required_columns(df: DataFrame, required: Iterable[str] = REQUIRED_SOURCE_COLUMNS) -> DataFrame:
    """Raise ``ValueError`` naming every missing column; otherwise return ``df``.
    Only the schema is inspected -- no job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Strip leading/trailing whitespace (tabs and newlines too) from the
    given columns, default every string column, in one projection."""
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[strip_whitespace(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def snake_case_columns(df: DataFrame) -> DataFrame:
    """``'Row ID'`` -> ``row_id``, ``'Sub-Category'`` -> ``sub_category``."""
    return df.select(*[F.col(c).alias(snake_case(c)) for c in df.columns])


def filter_valid_dates(df: DataFrame, column: str = "order_date") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def filter_strict(df: DataFrame, columns: Sequence[str] = ("order_date", "ship_date", "sales", "quantity")) -> DataFrame:
    """Keep rows where every listed column that exists is non-null."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def ship_before_order(ship: str = "ship_date", order: str = "order_date"):
    """Predicate: the ship date precedes the order date."""
    return F.col(ship) < F.col(order)


def fix_ship_date(df: DataFrame, ship: str = "ship_date", order: str = "order_date") -> DataFrame:
    """Null a ship date that precedes its order date; the row is kept."""
    return df.withColumn(ship, F.when(ship_before_order(ship, order), F.lit(None)).otherwise(F.col(ship)))


def computed_once(df: DataFrame) -> DataFrame:
    """The rows of ``df``, whose columns a later filter reads as values.  A
    filter right above a projection is moved below it with the expressions that
    it needs, which are then computed for the filter and for the rows again."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.array(row)))


def parse_date_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse_date(c) for c in columns})


# Silver types of the typed source columns (snake_case names).
SILVER_CASTS = {"row_id": "bigint", "sales": "double", "quantity": "bigint",
                "discount": "double", "profit": "double"}


# Columns that order copies of one row after their dates, before all others.
TIE_BREAK = ("Order ID", "Product ID", "Sales")


def dated_lines(df: DataFrame, row_key: str = "Row ID", order_date: str = "Order Date", ship_date: str = "Ship Date") -> DataFrame:
    """Trimmed lines with parsed dates, the key ``_row`` (the numeric row id;
    null where it is none) and ``_ship`` (the ship date unless it precedes the
    order date)."""
    validate_required_columns(df, [row_key, order_date, ship_date])
    parsed = parse_date_columns(trim_strings(df), [order_date, ship_date])
    return (parsed.withColumn("_row", safe_cast(row_key, "bigint"))
            .withColumn("_ship", F.when(F.col(ship_date) >= F.col(order_date), F.col(ship_date))))


def deduplicated_lines(
    df: DataFrame,
    row_key: str = "Row ID",
    order_date: str = "Order Date",
    ship_date: str = "Ship Date",
    copies: str | None = None,
    dated: bool = False,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Steps 1-3 and 6 of :func:`cleanse`: trimmed, dates parsed, one line per
    row id, typed, snake_case -- before any line is dropped.  Of the copies of
    a row id the one with the earliest valid dates survives; lines without a
    usable row id are all kept, with a null id.  ``copies`` names a column for
    the number of lines that each one stands for.  With ``dated`` lines without an
    order date are left out: they come last, so one survives only where no copy
    has a date.  With ``stage`` (:func:`tiersmith.session.staging`) the same lines
    come out clustered by day, see :func:`_first_lines_by_day`; ``only`` (distinct
    ``_row``) then leaves out the lines of all other row ids."""
    lines = dated_lines(df, row_key, order_date, ship_date)
    dates = [order_date, "_ship", ship_date]
    usable = F.col("_row").isNotNull()
    order = [*dates, *[c for c in TIE_BREAK if c in df.columns]]
    if stage is not None:
        kept = _first_lines_by_day(lines, order, dates, copies, dated, stage, only)
    else:
        deduped = first_rows(lines.where(usable), ["_row"], order, copies, nulls_last=dates,
                             candidates=F.col(order_date).isNotNull() if dated else None)
        single = computed_once(lines.where(~usable)).withColumns({copies: F.lit(1).cast("bigint")} if copies else {})
        kept = deduped.union(single)
    renamed = snake_case_columns(kept.drop("_row", "_ship"))
    return renamed.withColumns({c: safe_cast(c, t) for c, t in SILVER_CASTS.items() if c in renamed.columns})


# Fixed value: lines of a day from which on the day is dealt to several tasks.
DAY_ROWS = 500_000


def _first_lines_by_day(lines: DataFrame, order: Sequence[str], dates: Sequence[str], copies: str | None, dated: bool,
                        stage: Callable[[DataFrame], DataFrame], only: DataFrame | None = None) -> DataFrame:
    """The first line of each row id, and each line without one, clustered by
    day (the order date, else the ship date) for a partitioned write.

    The dates decide first, so the survivor of a row id lies on its earliest
    order date, or, without any, on its earliest ship date.  A pass over row ids
    and dates alone finds these days; then each whole line is shuffled once, to
    its day, instead of once to its row id and once to its day.  The day keeps
    the first of its lines per row id where it is that id's day.  A day of more
    than :data:`DAY_ROWS` lines is dealt to several tasks by row id.  ``lines``
    are read twice and must come out the same."""
    order_date, _, ship_date = dates
    single = F.col("_row").isNull()

    def on(*found):
        return F.coalesce(F.unix_date(F.coalesce(*found)), F.lit(-2**31)).alias("_on")

    decide = [F.col(order_date)] if dated else [F.col(order_date), F.col(ship_date)]
    whole, ids = lines.select("*", on(*decide)), lines.select("_row", *decide)
    if dated:
        whole, ids = (computed_once(rows).where(decide[0].isNotNull()) for rows in (whole, ids))
    ids = ids.groupBy("_row", F.when(single, on(*decide)).alias("_at")).agg(
        *[F.min(c).alias(f"_{n}") for n, c in enumerate(decide)], F.count(F.lit(1)).alias("_copies"))
    ids = stage(ids.select("_row", on(*[f"_{n}" for n in range(len(decide))]), "_copies"))
    busy = stage(ids.groupBy("_on").agg(F.sum("_copies").alias("_lines")).where(F.col("_lines") > DAY_ROWS))

    def dealt(rows: DataFrame, key) -> DataFrame:
        parts = F.coalesce(F.ceil(F.col("_lines") / DAY_ROWS), F.lit(1))  # busy days are bounded by the calendar
        part = F.pmod(F.xxhash64(key), parts).cast("int").alias("_part")
        return rows.join(F.broadcast(busy), "_on", "left").select(*rows.columns, part).repartition("_on", "_part")

    own = whole.withColumn("_own", F.when(single, F.monotonically_increasing_id()).otherwise(F.lit(0)))
    by_day = ["_on", "_part", "_row"]
    firsts = first_rows(dealt(own, F.coalesce("_row", "_own")), [*by_day, "_own"], order, nulls_last=dates)
    usable = ids.where(~single)
    days = dealt(usable if only is None else usable.join(only, "_row", "left_semi"), F.col("_row"))
    kept = firsts.join(days, by_day, "left").where(F.col("_copies").isNotNull() | single)
    columns = [F.col(f"`{c}`") for c in lines.columns]
    return kept.select(*columns, *([F.coalesce("_copies", F.lit(1).cast("bigint")).alias(copies)] if copies else []))


def cleanse(
    df: DataFrame,
    row_key: str = "Row ID",
    order_date: str = "Order Date",
    ship_date: str = "Ship Date",
    strict: bool = False,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Bronze (source-named) rows -> silver rows, lazily:

    1. every string column stripped of edge whitespace;
    2. dates parsed day first with month-first and ISO fallbacks, bad -> null;
    3. one row per numeric ``row_key``: earliest order date, then earliest ship
       date not before it, missing dates last, then ``TIE_BREAK`` and all other
       columns; lines without a usable key stay, each for itself;
    4. rows without an order date dropped (``strict``: also rows missing ship
       date, sales or quantity);
    5. ship dates before the order date set to null;
    6. ``try_cast`` to silver types; names to snake_case.

    ``stage`` gives the same rows clustered by day, ``only`` those of some row ids
    and of none, see :func:`deduplicated_lines`.
    """
    validate_required_columns(df)
    typed = deduplicated_lines(df, row_key, order_date, ship_date, dated=True, stage=stage, only=only)
    kept = filter_valid_dates(typed, snake_case(order_date))
    if strict:
        kept = filter_strict(kept, (snake_case(order_date), snake_case(ship_date), "sales", "quantity"))
    return fix_ship_date(kept, snake_case(ship_date), snake_case(order_date))
