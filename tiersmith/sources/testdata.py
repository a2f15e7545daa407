"""The driver's TPC-H-like tables seen as retail order lines.

There is no retail table in the test data, so every registered query starts
from one of these two views:

* :func:`retail_lines` -- typed, silver-like lines (``order_date`` etc.);
* :func:`retail_source` -- the same lines as a raw feed: source (Title Case)
  column names, dates as text in mixed layouts, padded text, non-numeric
  quantities -- the shape bronze ingests and silver cleanses.

Join order is written by hand for scale: the small dimension tables are
joined to ``customer`` first, then ``orders`` is joined to that, and
``lineitem`` -- by far the largest input -- is shuffled exactly once, on
``orderkey``.  No broadcast is forced: adaptive execution broadcasts a side
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    ords = orders.join(cust, orders.o_custkey == cust.c_custkey)
    return lineitem.join(ords, lineitem.l_orderkey == ords.o_orderkey)


def _row_id() -> Column:
    # (l_orderkey, l_linenumber) plays the source row id; it repeats in the data.
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint")


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order lines (silver names and types)."""
    return _joined(spark, sf_dir).select(
        _row_id().alias("row_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("city"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of all orders: the narrow source of the anchor of trailing windows."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))


def _with_day_texts(joined: DataFrame) -> DataFrame:
    """Order and ship day as dd/MM/yyyy, formatted once: the other layouts are
    pieces of these.  Lines of every seventh supplier are dated three days
    later, so that a row id lies on several days."""
    ordered = F.date_add(F.col("o_orderdate").cast("date"), F.when(F.col("l_suppkey") % 7 == 0, 3).otherwise(0))
    return joined.withColumns({"_ordered": F.date_format(ordered, "dd/MM/yyyy"),
                               "_shipped": F.date_format(F.col("l_shipdate").cast("date"), "dd/MM/yyyy")})


def _day_month_year(text: str) -> tuple[Column, Column, Column]:
    t = F.col(text)
    return t.substr(1, 2), t.substr(4, 2), F.substr(t, F.lit(7))


def _order_date_text() -> Column:
    # Layout of the order-date text by k = (order key + part key)
    # % 20, so that copies of a row id differ -- 0-8 dd/MM/yyyy, 9 dd.MM.yyyy,
    # 10-11 MM/dd/yyyy, 12 ISO, 13 d-M-yyyy, 14-15 unpadded d/M/yyyy, 16
    # dd/MM/yyyy with a time, 17 dd/MM/yyyy wrapped in a tab and spaces, 18
    # 31 February, 19 'n/a'.
    t = F.col("_ordered")
    d, m, y = _day_month_year("_ordered")
    unpadded = [F.ltrim(x, F.lit("0")) for x in (d, m)]
    k = (F.col("o_orderkey") + F.col("l_partkey")) % 20
    return (F.when(k < 9, t)
             .when(k == 9, F.replace(t, F.lit("/"), F.lit(".")))
             .when(k < 12, F.concat(m, F.lit("/"), d, F.lit("/"), y))
             .when(k == 12, F.concat(y, F.lit("-"), m, F.lit("-"), d))
             .when(k == 13, F.concat(unpadded[0], F.lit("-"), unpadded[1], F.lit("-"), y))
             .when(k < 16, F.concat(unpadded[0], F.lit("/"), unpadded[1], F.lit("/"), y))
             .when(k == 16, F.concat(t, F.lit(" 10:30")))
             .when(k == 17, F.concat(F.lit("\t "), t, F.lit("  ")))
             .when(k == 18, F.concat(F.lit("31/02/"), y))
             .otherwise(F.lit("n/a")))


def _ship_date_text() -> Column:
    # Layout of the ship-date text by l_linenumber --
    # 1-5 dd/MM/yyyy, 6 ISO, 7 'TBD'.
    d, m, y = _day_month_year("_shipped")
    n = F.col("l_linenumber")
    return (F.when(n <= 5, F.col("_shipped"))
             .when(n == 6, F.concat(y, F.lit("-"), m, F.lit("-"), d))
             .otherwise(F.lit("TBD")))


def _product_name() -> Column:
    # By l_partkey % 8 -- 0 a quoted word and a comma, 1 a line
    # break, 2 a comma, else plain.
    n, k = F.col("l_partkey").cast("string"), F.col("l_partkey") % 8
    return (F.when(k == 0, F.concat(F.lit('Binder 7" wide, "'), n, F.lit('", black')))
             .when(k == 1, F.concat(F.lit("Desk "), n, F.lit("\nassembled")))
             .when(k == 2, F.concat(F.lit("Paper, "), n)).otherwise(F.concat(F.lit("Part "), n)))


def retail_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed: source column names, everything but the sales amount as text:
    dates in mixed layouts, padded cities (customer key divisible by 9),
    non-numeric quantities (part key divisible by 50) and row ids (part key
    divisible by 97), product names with quotes, commas and line breaks."""
    city = F.when(F.col("c_custkey") % 9 == 0, F.concat(F.lit("\t"), F.col("n_name"), F.lit("  "))) \
            .otherwise(F.col("n_name"))
    quantity = F.when(F.col("l_partkey") % 50 == 0, F.lit("n/a")) \
                .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    row_id = F.when(F.col("l_partkey") % 97 == 0, F.concat(F.lit("A-"), _row_id().cast("string"))).otherwise(_row_id().cast("string"))
    return _with_day_texts(_joined(spark, sf_dir)).select(
        row_id.alias("Row ID"),
        F.col("l_orderkey").cast("string").alias("Order ID"),
        _order_date_text().alias("Order Date"),
        _ship_date_text().alias("Ship Date"),
        F.col("o_orderpriority").alias("Ship Mode"),
        F.col("o_custkey").cast("string").alias("Customer ID"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("r_name").alias("Country"),
        city.alias("City"),
        F.concat(F.lit("S"), (F.col("c_custkey") % 50).cast("string")).alias("State"),
        F.lpad((F.col("c_custkey") % 1000).cast("string"), 5, "0").alias("Postal Code"),
        F.col("r_name").alias("Region"),
        F.col("l_partkey").cast("string").alias("Product ID"),
        F.concat(F.lit("C"), (F.col("l_partkey") % 3).cast("string")).alias("Category"),
        F.concat(F.lit("C"), (F.col("l_partkey") % 17).cast("string")).alias("Sub-Category"),
        _product_name().alias("Product Name"),
        F.col("l_extendedprice").alias("Sales"),
        quantity.alias("Quantity"),
    )
