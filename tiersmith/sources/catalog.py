"""Catalog registration of the written layers (external parquet tables).

Works with Spark's built-in session catalog; on a cluster with a shared
metastore the same statements register shared tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tiersmith.session import shared_dir


def _f(name: str, dtype, comment: str) -> StructField:
    return StructField(name, dtype, True, {"comment": comment})


# Columns and types of the four tables; the comments are this library's.
PARTITION_FIELDS = [
    _f("year", IntegerType(), "partition year"),
    _f("month", IntegerType(), "partition month"),
    _f("day", IntegerType(), "partition day"),
]

BRONZE_TABLE = StructType([
    _f("Row ID", LongType(), "source row identifier"),
    _f("Order ID", StringType(), "order identifier"),
    _f("Order Date", StringType(), "order date as delivered (text)"),
    _f("Ship Date", StringType(), "ship date as delivered (text)"),
    _f("Ship Mode", StringType(), "shipping mode"),
    _f("Customer ID", StringType(), "customer identifier"),
    _f("Customer Name", StringType(), "customer full name"),
    _f("Segment", StringType(), "customer segment"),
    _f("Country", StringType(), "country"),
    _f("City", StringType(), "city"),
    _f("State", StringType(), "state"),
    _f("Postal Code", StringType(), "postal code (text)"),
    _f("Region", StringType(), "region"),
    _f("Product ID", StringType(), "product identifier"),
    _f("Category", StringType(), "product category"),
    _f("Sub-Category", StringType(), "product sub-category"),
    _f("Product Name", StringType(), "product name"),
    _f("Sales", DoubleType(), "sales amount"),
    _f("Quantity", StringType(), "quantity as delivered (text)"),
] + PARTITION_FIELDS)

SILVER_TABLE = StructType([
    _f("row_id", LongType(), "source row identifier"),
    _f("order_id", StringType(), "order identifier"),
    _f("order_date", DateType(), "order date"),
    _f("ship_date", DateType(), "ship date, null when before the order date"),
    _f("ship_mode", StringType(), "shipping mode"),
    _f("customer_id", StringType(), "customer identifier"),
    _f("customer_name", StringType(), "customer full name"),
    _f("segment", StringType(), "customer segment"),
    _f("country", StringType(), "country"),
    _f("city", StringType(), "city"),
    _f("state", StringType(), "state"),
    _f("postal_code", StringType(), "postal code (text)"),
    _f("region", StringType(), "region"),
    _f("product_id", StringType(), "product identifier"),
    _f("category", StringType(), "product category"),
    _f("sub_category", StringType(), "product sub-category"),
    _f("product_name", StringType(), "product name"),
    _f("sales", DoubleType(), "sales amount"),
    _f("quantity", LongType(), "quantity"),
] + PARTITION_FIELDS)

GOLD_SALES_TABLE = StructType([
    _f("order_id", StringType(), "order identifier, unique"),
    _f("order_date", DateType(), "order date"),
    _f("shipment_date", DateType(), "shipment date"),
    _f("shipment_mode", StringType(), "shipment mode"),
    _f("city", StringType(), "city"),
] + PARTITION_FIELDS)

GOLD_CUSTOMER_TABLE = StructType([
    _f("customer_id", StringType(), "customer identifier, unique"),
    _f("customer_first_name", StringType(), "first name"),
    _f("customer_last_name", StringType(), "last name"),
    _f("customer_segment", StringType(), "customer segment"),
    _f("country", StringType(), "country"),
    _f("orders_last_month", LongType(), "distinct orders in the last month"),
    _f("orders_last_6_months", LongType(), "distinct orders in the last 6 months"),
    _f("orders_total", LongType(), "distinct orders overall"),
] + [StructField(f.name, f.dataType, True, {"comment": f.metadata["comment"] + " of the first order"})
     for f in PARTITION_FIELDS])

TABLE_DEFINITIONS = {
    "bronze_retail_sales": BRONZE_TABLE,
    "silver_retail_sales": SILVER_TABLE,
    "gold_sales": GOLD_SALES_TABLE,
    "gold_customer": GOLD_CUSTOMER_TABLE,
}


def create_database(spark: SparkSession, database: str) -> None:
    """The database, with a folder of its own under the shared one."""
    where = _quoted(f"{shared_dir(spark)}/databases/{database}.db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{where}'")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _drop_external(spark: SparkSession, database: str, table: str) -> None:
    """Drop a catalog entry; refuse a table whose files would go with it."""
    name = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return
    kind = spark.catalog.getTable(f"{database}.{table}").tableType
    if kind not in ("EXTERNAL", "VIEW"):
        raise ValueError(f"{name} is a {kind} table: dropping it would delete its files")
    spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {name}")


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    schema: StructType | None = None,
    partition_by: Sequence[str] = ("year", "month", "day"),
    comment: str = "",
) -> DataFrame:
    """Register (or re-register) an external parquet table at ``location``
    and load its partitions; returns ``spark.table(...)``.

    With ``schema`` the columns and comments are declared; without it they are
    taken from the files' metadata.  A prior external definition of the same
    name is replaced (only the catalog entry; readers find no table between the
    drop and the new entry); a managed table of that name is refused.
    """
    create_database(spark, database)
    name = f"`{database}`.`{table}`"
    _drop_external(spark, database, table)
    if schema is None:
        # columns as the files declare them (footers + partition folders only)
        schema = spark.read.parquet(location).schema
    cols = ""
    if schema is not None:
        defs = []
        for f in schema.fields:
            c = _quoted(f.metadata.get("comment", ""))
            defs.append(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{c}'" if c else ""))
        cols = "(" + ", ".join(defs) + ")"
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} {cols} USING PARQUET {parts} LOCATION '{_quoted(location)}' COMMENT '{_quoted(comment)}'")
    if partition_by:
        spark.catalog.recoverPartitions(f"{database}.{table}")
    return spark.table(f"{database}.{table}")


def register_layers(spark: SparkSession, database: str, paths: dict[str, str]) -> DataFrame:
    """Register every written layer (keys ``bronze``, ``silver``,
    ``gold_sales``, ``gold_customer`` of ``paths``; absent keys are skipped).
    Returns ``(table_name, location)`` of what was registered."""
    names = {"bronze": "bronze_retail_sales", "silver": "silver_retail_sales",
             "gold_sales": "gold_sales", "gold_customer": "gold_customer"}
    done = []
    for layer, table in names.items():
        if layer in paths:
            register_table(spark, database, table, paths[layer], schema=TABLE_DEFINITIONS[table], comment=f"{layer} layer")
            done.append((f"{database}.{table}", paths[layer]))
    return spark.createDataFrame(done, "table_name string, location string")


def add_partitions(spark: SparkSession, database: str, table: str, days: DataFrame | None = None, location: str | None = None) -> None:
    """Register partitions written since the table was.  With ``days`` (rows of
    ``year, month, day``, bounded by the calendar) exactly these, without
    listing the table's folders; else all folders are listed."""
    if days is None:
        spark.catalog.recoverPartitions(f"{database}.{table}")
        return
    for r in days.select("year", "month", "day").dropna().distinct().collect():
        folder = f" LOCATION '{_quoted(f'{location}/year={r.year}/month={r.month}/day={r.day}')}'" if location else ""
        spark.sql(f"ALTER TABLE `{database}`.`{table}` ADD IF NOT EXISTS PARTITION "
                  f"(year={int(r.year)}, month={int(r.month)}, day={int(r.day)}){folder}")


def table_partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """``SHOW PARTITIONS`` as a frame with int ``year, month, day`` columns;
    the partition of rows without a date has nulls."""
    shown = spark.sql(f"SHOW PARTITIONS `{database}`.`{table}`")
    kv = F.split(F.col("partition"), "/")
    return shown.select(*[
        F.split(F.get(kv, i), "=").getItem(1).try_cast("int").alias(name)
        for i, name in enumerate(("year", "month", "day"))
    ])


def table_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Registered columns: ``(column_name, data_type, is_partition, comment)``."""
    cols = spark.catalog.listColumns(table, database)
    rows = [(c.name, c.dataType, bool(c.isPartition), c.description or "") for c in cols]
    return spark.createDataFrame(rows, "column_name string, data_type string, is_partition boolean, comment string")
