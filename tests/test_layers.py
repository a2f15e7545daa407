import datetime as dt
import os

from pyspark.sql import functions as F

from tiersmith.plans import medallion as md
from tiersmith.session import fresh_path
from tiersmith.sources import catalog as cat
from tiersmith.sources import files as fs
from tiersmith.sources import partitions as pt

D = dt.date

CSV = """Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City
1,CA-2018-001,12/01/2018,12/05/2018,First Class,JD-001,John Doe,Consumer,United States,New York
2,CA-2018-002,12/15/2018,12/20/2018,Standard Class,JS-002,Jane Smith,Corporate,United States,Boston
3,CA-2018-003,12/30/2018,12/31/2018,Same Day,MW-003,Mike Wilson,Home Office,United States,Chicago
"""


def write_csv_fixture(spark):
    folder = fresh_path(spark, "csv_fixture")
    os.makedirs(folder)
    with open(os.path.join(folder, "part.csv"), "w") as fh:
        fh.write(CSV)
    return folder


def explain(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_ingest_and_layers(spark):
    src = write_csv_fixture(spark)
    raw = fs.read_csv(spark, src)
    assert raw.count() == 3 and "Order Date" in raw.columns
    lake = fresh_path(spark, "lake")
    run = md.run_medallion(spark, src, lake, anchor="2018-12-30", parallel_gold=True, database="tiersmith_run")
    stages = {r.stage: (r.records_in, r.records_out) for r in run.collect()}
    assert {r.success_rate for r in run.collect()} == {100.0}
    assert stages == {"bronze": (3, 3), "silver": (3, 3), "gold_sales": (3, 3), "gold_customer": (3, 3)}
    assert spark.table("tiersmith_run.gold_customer").count() == 3
    assert spark.table("tiersmith_run.bronze_retail_sales").count() == 3
    bronze = os.path.join(lake, md.LAYER_DIRS["bronze"])
    assert any(d.startswith("year=") for d in os.listdir(bronze))
    silver = fs.read_layer(spark, os.path.join(lake, md.LAYER_DIRS["silver"]))
    dates = sorted((r.order_date, r.ship_date) for r in silver.collect())
    # day-first reading: 12/01 is 12 January; 12/05 ship date is 12 May
    assert dates == [(D(2018, 1, 12), D(2018, 5, 12)), (D(2018, 12, 15), D(2018, 12, 20)),
                     (D(2018, 12, 30), D(2018, 12, 31))]


def test_bronze_fail_on_bad_date(spark):
    df = spark.createDataFrame([(1, "nonsense")], "`Row ID` long, `Order Date` string")
    import pytest
    with pytest.raises(Exception, match="unparseable date"):
        md.bronze_frame(df, on_bad_date="fail").collect()
    assert md.bronze_frame(df, on_bad_date="null").first().year is None


def _days(spark):
    days = spark.range(0, 60).select(F.date_add(F.lit(D(2001, 6, 1)), F.col("id").cast("int")).alias("order_date"),
                                     F.col("id").alias("v"))
    path = fresh_path(spark, "days")
    fs.write_partitioned(pt.add_partition_columns(days), path)
    return path


def test_partition_predicate_sql():
    assert pt.partition_predicate_sql(2018, 12) == "year = 2018 AND month = 12"
    assert pt.partition_predicate_sql() == "TRUE"


def test_pruned_and_range_scans(spark):
    path = _days(spark)
    assert fs.read_layer(spark, path).filter(pt.partition_predicate_sql(2001, 7, 4)).count() == 1
    pruned = pt.pruned_scan(spark, path, year=2001, month=7)
    assert pruned.count() == 30
    plan = explain(pruned)
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan
    rng = pt.range_scan(spark, path, "2001-06-30", "2001-07-03")
    assert sorted(r.order_date for r in rng.collect()) == [D(2001, 6, 30), D(2001, 7, 1), D(2001, 7, 2),
                                                            D(2001, 7, 3)]
    assert "make_date" in explain(rng).split("PartitionFilters:")[1].split("]")[0]
    cal = pt.range_calendar(spark, "2001-06-30", "2001-07-03").collect()
    assert [r.partition_path for r in cal][0] == "year=2001/month=06/day=30" and len(cal) == 4
    counts = pt.partition_counts(pt.add_partition_columns(fs.read_layer(spark, path).drop("year", "month", "day")))
    assert counts.count() == 60 and counts.agg(F.sum("records")).first()[0] == 60


def test_catalog_registration(spark):
    path = _days(spark)
    t = cat.register_table(spark, "tiersmith_test", "days", path, comment="test table")
    assert t.count() == 60
    parts = cat.table_partitions(spark, "tiersmith_test", "days")
    assert parts.count() == 60
    cols = {r.column_name: r.is_partition for r in cat.table_columns(spark, "tiersmith_test", "days").collect()}
    assert cols["year"] and not cols["v"]
    # re-registration replaces the entry, files stay
    assert cat.register_table(spark, "tiersmith_test", "days", path).count() == 60


def test_write_verified(spark):
    df = spark.range(0, 100).select(F.col("id"), F.lit(D(2001, 1, 1)).alias("order_date"))
    df = pt.add_partition_columns(df)
    back, ver = fs.write_verified(df, fresh_path(spark, "verified"))
    r = ver.first()
    assert (r.rows_written, r.rows_read, r.columns_match) == (100, 100, True)
    assert back.columns == df.columns


def test_fallback_read(spark):
    path = _days(spark)
    df = fs.read_first_existing(spark, [fresh_path(spark, "missing"), path])
    assert df.count() == 60
