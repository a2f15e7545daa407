"""Physical-plan checks for the scale design: shuffle counts, map-side partial
aggregation, no joins in the gold jobs, pruned scans, rebalanced writes."""

import datetime as dt

from pyspark.sql import functions as F

from tiersmith.operators import customers as cu
from tiersmith.operators.dedup import first_rows
from tiersmith.operators.quarantine import judged_lines
from tiersmith.operators.sales import sales_orders
from tiersmith.session import fresh_path
from tiersmith.sources import files as fs
from tiersmith.sources.partitions import add_partition_columns
from tiersmith.sources.testdata import retail_source


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def silver(spark, n=3000, hot_share=3):
    """Order lines where customer C0 holds a third of all rows."""
    rows = spark.range(n).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 500).cast("string").alias("order_id"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") % 365).cast("int")).alias("order_date"),
        F.lit(None).cast("date").alias("ship_date"),
        F.lit("Std").alias("ship_mode"),
        F.when(F.col("id") % hot_share == 0, F.lit("C0")).otherwise((F.col("id") % 50).cast("string"))
        .alias("customer_id"),
        F.lit("Ann Lee").alias("customer_name"), F.lit("Consumer").alias("segment"),
        F.lit("US").alias("country"), F.lit("Boston").alias("city"))
    path = fresh_path(spark, "plan_silver")
    fs.write_partitioned(add_partition_columns(rows), path)
    return fs.read_layer(spark, path)


def test_customer_metrics_plan_two_shuffles_no_join(spark):
    df = silver(spark)
    p = plan(cu.customer_metrics(df, anchor="2018-12-31"))
    main = p.split("Subquery")[0]
    assert main.count("Exchange hashpartitioning") == 2
    assert "Join" not in main and "Expand" not in main
    assert main.count("partial_") >= 2            # map-side partial aggregation at both levels
    assert "ReadSchema: struct<row_id:bigint,order_id:string,order_date:date,customer_id:string," in p
    assert "PushedFilters: [IsNotNull(customer_id)]" in p


def test_customer_metrics_skewed_customer(spark):
    df = silver(spark)
    got = {r.customer_id: r for r in cu.customer_metrics(df, anchor="2018-12-31").collect()}
    lines = df.select("customer_id", "order_id").distinct().groupBy("customer_id").count().collect()
    assert {r.customer_id: r["count"] for r in lines} == {k: v.orders_total for k, v in got.items()}
    assert got["C0"].orders_total == 500   # every third id; gcd(3, 500) = 1 reaches all 500 orders


def test_first_rows_partial_before_shuffle(spark):
    p = plan(first_rows(silver(spark), ["order_id"], ["order_date"]))
    assert p.count("Exchange hashpartitioning") == 1
    exchange_at = p.index("Exchange hashpartitioning")
    assert "partial_min" in p[exchange_at:]          # below the exchange, i.e. before the shuffle
    assert "Window" not in p


def test_gold_sales_one_shuffle(spark):
    p = plan(sales_orders(silver(spark)))
    assert p.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<order_id:string,order_date:date,ship_date:date,ship_mode:string,city:string>" in p


def test_rebalanced_write_plan(spark):
    df = add_partition_columns(silver(spark).drop("year", "month", "day"))
    p = plan(df.hint("rebalance", "year", "month", "day"))
    assert "REBALANCE_PARTITIONS_BY_COL" in p


def test_dates_are_parsed_few_times(spark):
    """An expression that repeats its text multiplies until the generated code is too large to compile."""
    from tiersmith.plans.registry import QUERIES

    parses, size = {"parse_dates": 2, "cleanse_metrics": 4, "filter_strict": 4, "null_counts": 5, "silver_cleanse": 5}, 30_000
    for key, most in parses.items():
        text = QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < text.count("cast(regexp_extract") <= most and len(text) < size, key
    judged = judged_lines(retail_source(spark, "/root/testdata/sf0.001"), strict=True)._jdf.queryExecution()
    assert 0 < judged.optimizedPlan().toString().count("cast(regexp_extract") <= 4
    assert judged.executedPlan().toString().count("Exchange hashpartitioning(_row") == 1   # silver's shuffle, no second one
