"""Registered queries: one Spark plan per operator of the library, each
reading the driver's tables (or layers Spark wrote from them), and the
matching DuckDB oracle SQL.

Queries that exercise sinks write to a fresh folder under the session's
shared checkpoint directory and return what they read back.  Layers that
several queries scan are written once per session and source directory.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.functions.casts import safe_cast
from tiersmith.functions.dates import months_before, parse_date, parse_date_or_fail
from tiersmith.functions.text import strip_whitespace
from tiersmith.operators import cleanse as cl
from tiersmith.operators import customers as cu
from tiersmith.operators import quality as qa
from tiersmith.operators import reports as rp
from tiersmith.operators.dedup import duplicate_counts, first_rows
from tiersmith.operators.distinct import distinct_between, write_distinct_state
from tiersmith.operators.quarantine import KEPT, REJECTED, verdict_counts
from tiersmith.operators.sales import GOLD_SALES_COLUMNS, sales_orders, sales_project
from tiersmith.plans import medallion as md
from tiersmith.session import fresh_path, staging
from tiersmith.sources import catalog as cat
from tiersmith.sources import files as fs
from tiersmith.sources import partitions as pt
from tiersmith.sources.testdata import order_dates, retail_lines, retail_source, table
from tiersmith.streaming import incremental_gold_sales, incremental_silver

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared by a query and its oracle.
PRUNE_YEAR, PRUNE_MONTH = 2001, 7
RANGE_START, RANGE_END = "2001-06-30", "2001-07-03"
REPLACED_START, REPLACED_END = "2001-01-01", "2001-12-31"
CATALOG_DB = "tiersmith_lake"
TOP_N = 10
SOURCE_COLUMNS = fs.SOURCE_SCHEMA.fieldNames()

# ---------------------------------------------------------------- layers ---

_layers: dict[tuple, str] = {}
_lock = threading.Lock()


def _gone(path: str) -> bool:
    # only local folders can be checked cheaply here; others are trusted
    local = path[len("file:"):] if path.startswith("file:") else path
    return "://" not in path and not os.path.exists(local)


def _source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Files of the tables that the layers come from, with size and time: a
    changed source gives new layers.  The file system is asked; no row is read."""
    context, out = spark.sparkContext, []
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        path = context._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
        for status in found or ():
            fs_ = status.getPath().getFileSystem(context._jsc.hadoopConfiguration())
            inner = fs_.listStatus(status.getPath())
            out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in inner]
    return tuple(sorted(out))


def _layer(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """Write a layer once per (session, source dir and its files, name);
    return its path.  A layer whose folder has disappeared is written again."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _source_state(spark, sf_dir), name)
    with _lock:
        path = _layers.get(key)
        if path is None or _gone(path):
            path = fresh_path(spark, name)
            build(path)
            _layers[key] = path
    return path


def _csv_path(spark, sf_dir):
    return _layer(spark, sf_dir, "source_csv", lambda p: fs.write_csv(retail_source(spark, sf_dir), p))


def _bronze_path(spark, sf_dir):
    csv = _csv_path(spark, sf_dir)
    return _layer(spark, sf_dir, "bronze", lambda p: md.ingest_bronze(spark, csv, p, on_bad_date="null"))


def _silver_path(spark, sf_dir):
    bronze = _bronze_path(spark, sf_dir)
    return _layer(spark, sf_dir, "silver", lambda p: md.build_silver(spark, bronze, p))


def _silver(spark, sf_dir) -> DataFrame:
    return fs.read_layer(spark, _silver_path(spark, sf_dir))


# ------------------------------------------------------- sources & sinks ---

def q_csv_scan(spark, sf_dir):
    return fs.read_csv(spark, _csv_path(spark, sf_dir))


def _mixed_csv_path(spark, sf_dir):
    """The feed in two layouts: columns turned round, one of them absent, one more."""
    source = retail_source(spark, sf_dir)
    late = F.col("Sub-Category").isin("C3", "C5")
    other = source.where(late).select(*reversed([c for c in SOURCE_COLUMNS if c != "Region"]), F.col("Category").alias("Line"))

    def build(path):
        fs.write_csv(source.where(~late), f"{path}/layout=1")
        fs.write_csv(other, f"{path}/layout=2")
    return _layer(spark, sf_dir, "mixed_csv", build)


def q_csv_layouts(spark, sf_dir):
    path = _mixed_csv_path(spark, sf_dir)
    return fs.read_csv_layouts(spark, [f"{path}/layout={n}" for n in (1, 2)], layout_column=None)


def q_bronze_ingest(spark, sf_dir):
    path = fresh_path(spark, "bronze_ingest")
    md.ingest_bronze(spark, _csv_path(spark, sf_dir), path, on_bad_date="null")
    return fs.read_layer(spark, path)


def q_bronze_scan(spark, sf_dir):
    return fs.read_layer(spark, _bronze_path(spark, sf_dir), SOURCE_COLUMNS + ["year", "month", "day"])


def _two_deliveries(spark, sf_dir):
    """The feed as two deliveries that share a day; both hold undated lines."""
    src = cl.computed_once(retail_source(spark, sf_dir))
    day, edge = parse_date(strip_whitespace("Order Date")), F.lit(RANGE_START).cast("date")
    odd = F.pmod(F.xxhash64("Product ID"), F.lit(2)) == 1
    return src.where(F.coalesce(day <= edge, ~odd)), src.where(F.coalesce(day >= edge, odd))


def q_daily_rerun(spark, sf_dir):
    # the second delivery comes twice: the same days and the same undated lines again
    path = fresh_path(spark, "daily")
    first, second = _two_deliveries(spark, sf_dir)
    for name, delivery in (("first", first), ("second", second), ("second", second)):
        md.ingest_bronze(spark, "", path, on_bad_date="null", source=delivery, mode="days", delivery=name)
    return fs.read_layer(spark, path, SOURCE_COLUMNS + ["year", "month", "day"])


def q_bronze_append(spark, sf_dir):
    # the shared day is delivered twice and kept twice
    path = fresh_path(spark, "appended")
    for delivery in _two_deliveries(spark, sf_dir):
        md.ingest_bronze(spark, "", path, on_bad_date="null", source=delivery, mode="append")
    return fs.read_layer(spark, path, SOURCE_COLUMNS + ["year", "month", "day"])


def q_silver_scan(spark, sf_dir):
    # first existing of several candidate folders (a missing one is skipped)
    return fs.read_first_existing(spark, [fresh_path(spark, "absent"), _silver_path(spark, sf_dir)])


def q_silver_write(spark, sf_dir):
    bronze = fs.read_layer(spark, _bronze_path(spark, sf_dir))
    path = fresh_path(spark, "silver_write")
    with staging(spark) as stage:
        silver = md.silver_frame(bronze, stage=stage)
        fs.write_partitioned(silver, path, clustered=True)
    return fs.read_layer(spark, path, silver.columns)


def q_gold_sales_write(spark, sf_dir):
    path = fresh_path(spark, "gold_sales")
    md.build_gold_sales(spark, _silver_path(spark, sf_dir), path)
    return fs.read_layer(spark, path, [c for c, _ in GOLD_SALES_COLUMNS] + ["year", "month", "day"])


def q_gold_customer_write(spark, sf_dir):
    path = fresh_path(spark, "gold_customer")
    md.build_gold_customer(spark, _silver_path(spark, sf_dir), path)
    return fs.read_layer(spark, path, list(cu.GOLD_CUSTOMER_COLUMNS) + ["year", "month", "day"])


def q_sales_by_date_write(spark, sf_dir):
    sales = sales_orders(_silver(spark, sf_dir))
    path = fresh_path(spark, "sales_by_date")
    fs.write_partitioned(sales, path, ["order_date"])
    return fs.read_layer(spark, path, sales.columns)


def q_plain_write(spark, sf_dir):
    customers = cu.customer_metrics(_silver(spark, sf_dir))
    path = fresh_path(spark, "customers_plain")
    fs.write_plain(customers, path)
    return fs.read_layer(spark, path, customers.columns)


def q_write_verify(spark, sf_dir):
    sales = md.gold_sales_frame(_silver(spark, sf_dir))
    _, verification = fs.write_verified(sales, fresh_path(spark, "sales_verified"), name="sales_verify")
    return verification


def q_catalog_scan(spark, sf_dir):
    cat.register_layers(spark, CATALOG_DB, {"silver": _silver_path(spark, sf_dir)})
    return spark.table(f"{CATALOG_DB}.silver_retail_sales")


def q_catalog_partitions(spark, sf_dir):
    # over bronze, which has a partition of undated rows
    cat.register_layers(spark, CATALOG_DB, {"bronze": _bronze_path(spark, sf_dir)})
    return cat.table_partitions(spark, CATALOG_DB, "bronze_retail_sales")


# ------------------------------------------------------------ partitions ---

def q_partition_columns(spark, sf_dir):
    return pt.add_partition_columns(retail_lines(spark, sf_dir).select("row_id", "order_id", "order_date"))


def q_partition_columns_padded(spark, sf_dir):
    return pt.add_partition_columns(retail_lines(spark, sf_dir).select("row_id", "order_id", "order_date"),
                                    padded=True)


def q_partition_list(spark, sf_dir):
    return pt.partition_list(pt.add_partition_columns(retail_lines(spark, sf_dir)))


def q_partition_counts(spark, sf_dir):
    return pt.partition_counts(pt.add_partition_columns(retail_lines(spark, sf_dir)))


def q_pruned_scan(spark, sf_dir):
    return pt.pruned_scan(spark, _silver_path(spark, sf_dir), year=PRUNE_YEAR, month=PRUNE_MONTH)


def q_range_scan(spark, sf_dir):
    return pt.range_scan(spark, _silver_path(spark, sf_dir), RANGE_START, RANGE_END)


def q_range_calendar(spark, sf_dir):
    bounds = rp.date_range(retail_lines(spark, sf_dir)).select(F.col("min_date").alias("start"),
                                                                F.col("max_date").alias("end"))
    return pt.calendar(bounds)


# ----------------------------------------------------------- projections ---

def q_sales_project(spark, sf_dir):
    return sales_project(retail_lines(spark, sf_dir))


RENAMES = {"ship_mode": "shipment_mode", "ship_date": "shipment_date", "segment": "customer_segment",
           "not_a_column": "ignored"}


def q_rename_map(spark, sf_dir):
    return cl.rename_columns(retail_lines(spark, sf_dir), RENAMES)


def q_snake_case_columns(spark, sf_dir):
    return cl.snake_case_columns(retail_source(spark, sf_dir))


def q_silver_cleanse(spark, sf_dir):
    return cl.cleanse(retail_source(spark, sf_dir))


def q_safe_cast(spark, sf_dir):
    src = retail_source(spark, sf_dir)
    return src.select(safe_cast("Row ID", "bigint").alias("row_id"),
                      safe_cast("Quantity", "bigint").alias("quantity"),
                      safe_cast("Order ID", "bigint").alias("order_key"),
                      safe_cast("Customer Name", "int").alias("name_as_int"))


def q_date_thresholds(spark, sf_dir):
    anchor = rp.date_range(retail_lines(spark, sf_dir)).select(F.col("max_date").alias("anchor_date"))
    return anchor.select("anchor_date",
                         months_before(F.col("anchor_date"), 1).alias("one_month_ago"),
                         months_before(F.col("anchor_date"), 6).alias("six_months_ago"))


# --------------------------------------------------------------- filters ---

def _parsed_source(spark, sf_dir):
    src = cl.trim_strings(retail_source(spark, sf_dir))
    return cl.computed_once(src.select(F.col("Row ID").alias("row_id"), F.col("Order ID").alias("order_id"),
                      parse_date("Order Date").alias("order_date"), parse_date("Ship Date").alias("ship_date"),
                      F.col("Sales").alias("sales"), safe_cast("Quantity", "bigint").alias("quantity")))


def q_filter_valid_dates(spark, sf_dir):
    return cl.filter_valid_dates(_parsed_source(spark, sf_dir)).select("row_id", "order_id", "order_date")


def q_filter_strict(spark, sf_dir):
    return cl.filter_strict(_parsed_source(spark, sf_dir))


def _customers(spark, sf_dir, **kw):
    # trailing windows end at the latest date of the orders table, not of a second pass over the lines
    return cu.customer_metrics(retail_lines(spark, sf_dir), anchor=cu.anchor_date(order_dates(spark, sf_dir)), **kw)


def q_orders_total(spark, sf_dir):
    return _customers(spark, sf_dir).select("customer_id", "orders_total")


def q_orders_last_month(spark, sf_dir):
    return _customers(spark, sf_dir).select("customer_id", "orders_last_month")


def q_orders_last_6_months(spark, sf_dir):
    return _customers(spark, sf_dir).select("customer_id", "orders_last_6_months")


def q_orders_last_month_exclusive(spark, sf_dir):
    return _customers(spark, sf_dir, inclusive=False).select("customer_id", "orders_last_month")


def q_ship_before_order(spark, sf_dir):
    lines = retail_lines(spark, sf_dir)
    return lines.agg(F.count(F.lit(1)).cast("bigint").alias("lines"),
                     F.count_if(cl.ship_before_order()).cast("bigint").alias("ship_before_order"))


def q_fix_ship_date(spark, sf_dir):
    return cl.fix_ship_date(retail_lines(spark, sf_dir).select("row_id", "order_id", "order_date", "ship_date"))


def q_metric_inconsistencies(spark, sf_dir):
    # Perturbed input: BUILDING customers get an impossible last-month count.
    c = _customers(spark, sf_dir)
    bad = c.withColumn("orders_last_month", F.when(F.col("customer_segment") == "BUILDING",
                                                   F.col("orders_last_6_months") + 1)
                       .otherwise(F.col("orders_last_month")))
    return qa.metric_inconsistencies(bad)


def q_null_counts(spark, sf_dir):
    return qa.null_counts(cl.cleanse(retail_source(spark, sf_dir)))


def q_sales_null_counts(spark, sf_dir):
    return qa.null_counts(sales_orders(retail_lines(spark, sf_dir)))


def q_customer_null_counts(spark, sf_dir):
    return qa.null_counts(_customers(spark, sf_dir))


def q_active_customers(spark, sf_dir):
    return rp.active_customers(_customers(spark, sf_dir))


# ------------------------------------------------- aggregation and dedup ---

def q_gold_sales(spark, sf_dir):
    return sales_orders(retail_lines(spark, sf_dir))


def q_customer_left_join(spark, sf_dir):
    return cu.customer_left_join(retail_lines(spark, sf_dir), anchor=cu.anchor_date(order_dates(spark, sf_dir)))


def q_customer_latest_order(spark, sf_dir):
    return _customers(spark, sf_dir, keep_order_dates=True).select("customer_id", "latest_order_date")


def q_customer_first_order(spark, sf_dir):
    return _customers(spark, sf_dir, keep_order_dates=True).select("customer_id", "first_order_date")


def q_customer_attributes(spark, sf_dir):
    return _customers(spark, sf_dir).select("customer_id", "customer_first_name", "customer_last_name",
                                            "customer_segment", "country")


def q_date_range(spark, sf_dir):
    return rp.date_range(sales_orders(retail_lines(spark, sf_dir)))


def q_customer_summary(spark, sf_dir):
    return rp.customer_summary(_customers(spark, sf_dir))


def q_customer_stats(spark, sf_dir):
    return rp.customer_stats(_customers(spark, sf_dir))


def q_segment_distribution(spark, sf_dir):
    return rp.segment_distribution(_customers(spark, sf_dir))


def q_ship_mode_distribution(spark, sf_dir):
    return rp.ship_mode_distribution(sales_orders(retail_lines(spark, sf_dir)))


def q_cleanse_metrics(spark, sf_dir):
    return qa.cleanse_metrics(retail_source(spark, sf_dir))


def q_distinct_counts(spark, sf_dir):
    return rp.distinct_counts(sales_orders(retail_lines(spark, sf_dir)),
                              ["order_id", "order_date", "shipment_mode", "city"])


def q_customer_base_distinct(spark, sf_dir):
    return retail_lines(spark, sf_dir).select("customer_id", "customer_name", "segment", "country").distinct()


def q_row_dedup(spark, sf_dir):
    return first_rows(retail_lines(spark, sf_dir), ["row_id"], ["product_id", "ship_date", "sales"])


def q_customer_orders(spark, sf_dir):
    return cu.customer_orders(retail_lines(spark, sf_dir))


def q_duplicate_counts(spark, sf_dir):
    return duplicate_counts(retail_lines(spark, sf_dir), ["row_id"])


def q_orders_deduplicated(spark, sf_dir):
    return duplicate_counts(cl.cleanse(retail_source(spark, sf_dir)), ["order_id"])


def q_top_customers(spark, sf_dir):
    return rp.top_customers(_customers(spark, sf_dir), TOP_N)


# ------------------------------------------------------- scalar functions ---

def q_parse_dates(spark, sf_dir):
    src = retail_source(spark, sf_dir)
    return src.select(F.col("Row ID").alias("row_id"), F.col("Order Date").alias("order_date_text"),
                      parse_date(strip_whitespace("Order Date")).alias("order_date"),
                      parse_date(strip_whitespace("Ship Date")).alias("ship_date"))


def q_parse_dates_fallback(spark, sf_dir):
    src = retail_source(spark, sf_dir)
    text = strip_whitespace("Order Date")
    return src.select(F.col("Row ID").alias("row_id"),
                      parse_date(text, ("dd/MM/yyyy", "MM/dd/yyyy"), iso_fallback=False).alias("order_date"))


def q_parse_dates_strict(spark, sf_dir):
    # the failing form, over the texts that some layout fits
    src = retail_source(spark, sf_dir)
    text = strip_whitespace("Order Date")
    return src.where(parse_date(text).isNotNull()).select(
        F.col("Row ID").alias("row_id"), parse_date_or_fail(text).alias("order_date"))


def q_trim_strings(spark, sf_dir):
    return cl.trim_strings(retail_source(spark, sf_dir))


def _part_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.when(F.col("p_size") < 5, F.col("p_brand")).otherwise(
        F.concat_ws(" ", F.col("p_name"), F.col("p_brand")))
    return part.select(F.col("p_partkey").alias("partkey"), name.alias("customer_name"))


def q_parse_names(spark, sf_dir):
    return cu.parse_names(_part_names(spark, sf_dir))


def q_parse_names_last_token(spark, sf_dir):
    return cu.parse_names(_part_names(spark, sf_dir), rule="last_token")


# ------------------------------------------------------------ composites ---

def q_customer_metrics(spark, sf_dir):
    return _customers(spark, sf_dir)


def q_stage_metrics(spark, sf_dir):
    return md.run_medallion(spark, _csv_path(spark, sf_dir), fresh_path(spark, "lake"), on_bad_date="null")


def q_stage_metrics_parallel(spark, sf_dir):
    return md.run_medallion(spark, _csv_path(spark, sf_dir), fresh_path(spark, "lake"), on_bad_date="null",
                            parallel_gold=True, database=CATALOG_DB + "_all")


def q_incremental_silver(spark, sf_dir):
    # the bronze layer arrives as a file stream, in three micro-batches of files
    bronze, silver = _bronze_path(spark, sf_dir), fresh_path(spark, "silver_incremental")
    files = len(fs.read_layer(spark, bronze).inputFiles())
    incremental_silver(spark, bronze, silver, max_files_per_batch=max(1, -(-files // 3)))
    return fs.read_layer(spark, silver, md.silver_frame(fs.read_layer(spark, bronze)).columns)


def q_incremental_silver_deliveries(spark, sf_dir):
    # two deliveries with row ids in both, each followed by a run
    bronze, silver = fresh_path(spark, "bronze_deliveries"), fresh_path(spark, "silver_deliveries")
    src = retail_source(spark, sf_dir)
    later = F.pmod(F.xxhash64("Product ID"), F.lit(3)) == 0
    checkpoint = None
    for delivery in (src.where(~later), src.where(later)):
        md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=delivery, mode="append")
        checkpoint = incremental_silver(spark, bronze, silver, checkpoint)
    return fs.read_layer(spark, silver, md.silver_frame(fs.read_layer(spark, bronze)).columns)


def _replaced_days(spark, sf_dir):
    """The feed without some lines of one year, and the days of that year again:
    with these lines, but without those of a sub-category, which leave."""
    src = cl.computed_once(retail_source(spark, sf_dir))
    day = parse_date(strip_whitespace("Order Date"))
    year = F.coalesce(day.between(F.lit(REPLACED_START).cast("date"), F.lit(REPLACED_END).cast("date")), F.lit(False))
    stays = F.col("Sub-Category") != "C3"
    late = F.pmod(F.xxhash64("Product ID"), F.lit(3)) == 0
    return src.where(~(year & stays & late)), src.where(year & stays)


def q_incremental_silver_replaced(spark, sf_dir):
    bronze, silver = fresh_path(spark, "bronze_replaced"), fresh_path(spark, "silver_replaced")
    first, again = _replaced_days(spark, sf_dir)
    md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=first)
    checkpoint = incremental_silver(spark, bronze, silver)
    md.ingest_bronze(spark, "", bronze, on_bad_date="null", mode="days", delivery="again", source=again)
    incremental_silver(spark, bronze, silver, checkpoint)
    return fs.read_layer(spark, silver, md.silver_frame(fs.read_layer(spark, bronze)).columns)


def q_incremental_gold_sales(spark, sf_dir):
    # gold follows each run of silver by the changes that it leaves
    bronze, silver, gold, changes = (fresh_path(spark, f"gold_{n}") for n in ("bronze", "silver", "sales", "changes"))
    silver_run = gold_run = None
    for delivery, mode in zip(_replaced_days(spark, sf_dir), ("replace", "days")):
        md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=delivery, mode=mode, delivery="again")
        silver_run = incremental_silver(spark, bronze, silver, silver_run, changes_path=changes)
        gold_run = incremental_gold_sales(spark, changes, silver, gold, gold_run)
    return fs.read_layer(spark, gold, [c for c, _ in GOLD_SALES_COLUMNS] + ["year", "month", "day"])


DISTINCT_COLUMNS = ("row_id", "quantity", "order_id", "customer_id", "city", "ship_date")


def q_distinct_counts_range(spark, sf_dir):
    # from the state of the span's days, not from its lines
    silver = _silver(spark, sf_dir)
    state = _layer(spark, sf_dir, "distinct_state", lambda p: write_distinct_state(silver, p, DISTINCT_COLUMNS))
    return distinct_between(fs.read_layer(spark, state), DISTINCT_COLUMNS, REPLACED_START, REPLACED_END)


def _judged_path(spark, sf_dir):
    return _layer(spark, sf_dir, "judged", lambda p: md.build_silver_quarantined(
        spark, "", p, strict=True, source=retail_source(spark, sf_dir)))


def q_rejected_lines(spark, sf_dir):
    return md.read_judged(spark, _judged_path(spark, sf_dir), REJECTED)


def q_silver_kept(spark, sf_dir):
    return md.read_judged(spark, _judged_path(spark, sf_dir), KEPT)


def q_verdict_counts(spark, sf_dir):
    return verdict_counts(fs.read_layer(spark, _judged_path(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
