"""Daily runs and hard feeds: copies that differ, lines without ids, several
deliveries, quoted CSV, empty layers, catalog guards, shared folders."""

import datetime as dt
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tiersmith import session
from tiersmith.operators import cleanse as cl
from tiersmith.operators import customers as cu
from tiersmith.operators import reports as rp
from tiersmith.operators.distinct import distinct_between, write_distinct_state
from tiersmith.operators.quality import cleanse_metrics
from tiersmith.operators.sales import sales_orders
from tiersmith.plans import medallion as md
from tiersmith.session import fresh_path
from tiersmith.sources import catalog as cat
from tiersmith.sources import files as fs
from tiersmith.streaming import incremental_gold_sales, incremental_silver
from tiersmith.streaming.incremental import lines_of_days

D = dt.date
NAMES = fs.SOURCE_SCHEMA.fieldNames()


def source(spark, rows):
    """(row id, order id, order date, ship date) as text; the other columns are alike."""
    schema = ", ".join(f"`{n}` {'double' if n == 'Sales' else 'string'}" for n in NAMES)
    base = {"Ship Mode": "Std", "Customer ID": "C1", "Customer Name": "Ann Lee", "Segment": "Consumer", "Country": "US", "City": "Boston", "Sales": 1.0}
    return spark.createDataFrame([tuple(dict(base, **dict(zip(("Row ID", "Order ID", "Order Date", "Ship Date"), r))).get(n) for n in NAMES) for r in rows], schema)


def silver_rows(df):
    return sorted((str(r["row_id"]), r["order_id"], r["order_date"], r["ship_date"]) for r in df.collect())


def test_a_dated_copy_survives_an_undated_one(spark):
    for bad in (None, "00/00/0000"):
        src = source(spark, [("1", "O1", bad, None), ("1", "O1", "05/01/2018", None)])
        assert silver_rows(cl.cleanse(src)) == [("1", "O1", D(2018, 1, 5), None)]
    src = source(spark, [("1", "O1", "05/01/2018", "01/01/2018"), ("1", "O1", "05/01/2018", "09/01/2018")])
    assert silver_rows(cl.cleanse(src)) == [("1", "O1", D(2018, 1, 5), D(2018, 1, 9))]


def test_lines_without_ids_are_kept_and_counted(spark):
    src = source(spark, [(f"A-{i}", f"O{i}", "05/01/2018", None) for i in range(5)] + [("7", "O7", "05/01/2018", None), ("07", "O7", "06/01/2018", None)])
    assert cl.cleanse(src).count() == 6
    m = {r.metric: r.value for r in cleanse_metrics(src).collect()}
    assert (m["invalid_row_ids"], m["duplicates_removed"], m["final_records"]) == (5, 1, 6)


def test_gold_prefers_a_ship_date(spark):
    src = cl.cleanse(source(spark, [("1", "O1", "05/01/2018", "01/01/2018"), ("2", "O1", "05/01/2018", "09/01/2018")]))
    assert [r.shipment_date for r in sales_orders(src).collect()] == [D(2018, 1, 9)]


def test_days_mode_keeps_the_other_days(spark):
    bronze, silver, sales = (fresh_path(spark, n) for n in ("b", "s", "g"))
    for rows in ([("1", "O1", "05/01/2018", None), ("2", "O2", "06/01/2018", None)], [("2", "O3", "06/01/2018", None), ("3", "O4", "07/01/2018", None)]):
        md.ingest_bronze(spark, "", bronze, source=source(spark, rows), mode="days")
    assert sorted(r["Order ID"] for r in fs.read_layer(spark, bronze).collect()) == ["O1", "O3", "O4"]
    md.build_silver(spark, bronze, silver)
    md.build_gold_sales(spark, silver, sales, mode="days")
    assert fs.read_layer(spark, sales).count() == 3
    md.ingest_bronze(spark, "", bronze, source=source(spark, [("9", "O9", "05/01/2018", None)]), mode="append")
    assert fs.read_layer(spark, bronze).count() == 4
    with pytest.raises(ValueError, match="mode"):
        md.ingest_bronze(spark, "", bronze, source=source(spark, [("9", "O9", "05/01/2018", None)]), mode="other")


def test_days_mode_keeps_undated_rows_of_other_deliveries(spark):
    bronze = fresh_path(spark, "undated")
    first = [("1", "O1", "05/01/2018", None), ("3", "O3", "n/a", None), ("3", "O3", "n/a", None)]
    second = [("2", "O2", "06/01/2018", None), ("4", "O4", "n/a", None)]

    def deliver(rows, **name):
        md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, rows), mode="days", **name)
        return sorted(r["Order ID"] for r in fs.read_layer(spark, bronze).collect())

    assert deliver(first, delivery="a") == ["O1", "O3", "O3"]
    assert deliver(second, delivery="b") == ["O1", "O2", "O3", "O3", "O4"]
    assert deliver(second, delivery="b") == ["O1", "O2", "O3", "O3", "O4"]           # a re-run
    assert deliver(first[:2], delivery="a") == ["O1", "O2", "O3", "O4"]              # a corrected one
    assert deliver([("5", "O5", "n/a", None)]) == ["O1", "O2", "O3", "O4", "O5"]     # without any day or name
    md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, [("6", "O6", "n/a", None)]), mode="append")
    assert deliver([("2", "O7", "06/01/2018", None)], delivery="b") == ["O1", "O3", "O5", "O6", "O7"]


def test_days_mode_counts_its_own_rows(spark):
    bronze = fresh_path(spark, "undated_counts")
    for name, rows in (("a", [("1", "O1", "n/a", None)]), ("b", [("2", "O2", "n/a", None), ("3", "O3", "05/01/2018", None)])):
        got = md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, rows), mode="days", delivery=name)
        assert (got.records_in, got.records_out) == (len(rows), len(rows))


def full_silver(spark, bronze):
    return silver_rows(md.silver_frame(fs.read_layer(spark, bronze)))


@pytest.mark.parametrize("per_batch", [None, 1])
def test_incremental_silver_equals_the_full_job(spark, per_batch):
    bronze, silver = fresh_path(spark, "bi"), fresh_path(spark, "si")
    checkpoint = None
    deliveries = [
        [("1", "O1", "08/01/2018", None), ("2", "O2", "08/01/2018", "10/01/2018"), ("A", "O3", "09/01/2018", None)],
        [("1", "O4", "05/01/2018", None), ("A", "O5", "09/01/2018", None), ("5", "O6", "bad", None)],   # row 1 moves; its old day keeps row 2
        [("2", "O7", "04/01/2018", "06/01/2018"), ("5", "O8", "07/01/2018", None)],                       # the 8th is left empty
        [("1", "O9", "20/01/2018", None)],                                                                # a later copy changes nothing
    ]
    for rows in deliveries:
        md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, rows), mode="append")
        checkpoint = incremental_silver(spark, bronze, silver, checkpoint, per_batch)
        assert silver_rows(fs.read_layer(spark, silver)) == full_silver(spark, bronze)
    assert not os.path.isdir(os.path.join(silver.removeprefix("file:"), "year=2018", "month=1", "day=8"))


def test_incremental_silver_after_days_came_again_or_went(spark):
    bronze, silver = fresh_path(spark, "br"), fresh_path(spark, "sr")
    deliveries = [
        [("1", "O1", "05/01/2018", None), ("2", "O2", "05/01/2018", None), ("A", "O3", "05/01/2018", None), ("2", "O4", "07/01/2018", None)],
        [("1", "O1", "05/01/2018", None)],                                      # row 2 moves to its other copy, the loose line goes
        [("2", "O5", "05/01/2018", None), ("B", "O6", "06/01/2018", None)],     # row 1 goes, row 2 comes back
        [("9", "O9", "bad", None)],
    ]
    checkpoint = None
    for i, rows in enumerate(deliveries):
        md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, rows), mode="days", delivery=str(i))
        checkpoint = incremental_silver(spark, bronze, silver, checkpoint)
        assert silver_rows(fs.read_layer(spark, silver)) == full_silver(spark, bronze)
    assert [r[1] for r in full_silver(spark, bronze)] == ["O5", "O6"]
    day = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{bronze}/year=2018/month=1/day=6")
    day.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(day, True)
    incremental_silver(spark, bronze, silver, checkpoint)
    assert silver_rows(fs.read_layer(spark, silver)) == full_silver(spark, bronze)


def test_incremental_gold_sales_equals_the_full_job(spark):
    bronze, silver, gold, changes = (fresh_path(spark, n) for n in ("bg", "sg", "gg", "cg"))
    deliveries = [
        [("1", "O1", "08/01/2018", None), ("2", "O1", "05/01/2018", None), ("3", "O2", "05/01/2018", "09/01/2018"), ("A", "O3", "06/01/2018", None)],
        [("4", "O1", "09/01/2018", None), ("5", "O2", "04/01/2018", None), ("6", "O4", "09/01/2018", None)],  # O2's minimum falls, O1's stays
        [("3", "O2", "05/01/2018", "09/01/2018")],    # the 5th again: O1 loses its minimum
        [("A", "O5", "06/01/2018", None)],            # the 6th again: O3 is gone
        [("5", "O2", "04/01/2018", "06/01/2018")],    # the 4th again: a ship date comes first
        [("9", "O9", "bad", None)],
    ]
    run = gold_run = None
    for i, rows in enumerate(deliveries):
        md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, rows), mode="append" if i == 1 else "days", delivery=str(i))
        run = incremental_silver(spark, bronze, silver, run, changes_path=changes)
        gold_run = incremental_gold_sales(spark, changes, silver, gold, gold_run)
        full = md.gold_sales_frame(fs.read_layer(spark, silver))
        assert sorted(map(str, fs.read_layer(spark, gold, full.columns).collect())) == sorted(map(str, full.collect())), i
    assert sorted(r.order_id for r in fs.read_layer(spark, gold).collect()) == ["O1", "O2", "O4", "O5"]


def test_affected_days_prune_the_bronze_scan(spark):
    bronze = fresh_path(spark, "bp")
    md.ingest_bronze(spark, "", bronze, source=source(spark, [(str(i), "O", f"{i:02d}/01/2018", None) for i in range(1, 29)]))
    days = spark.createDataFrame([(2018, 1, 5)], "year int, month int, day int").checkpoint()
    picked = lines_of_days(fs.read_layer(spark, bronze), days)
    assert "dynamicpruning" in picked._jdf.queryExecution().executedPlan().toString() and picked.count() == 1


def feed(spark, files):
    folder = fresh_path(spark, "feed").removeprefix("file:")
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    return folder


def test_csv_with_quotes_commas_and_line_breaks(spark):
    path = feed(spark, {"a.csv": 'Row ID,Order ID,Product Name,Sales\n1,O1,"Binder 7"" wide, black",2.5\n2,O2,"two\nlines",x\n3,O3\n'})
    from pyspark.sql import Observation

    seen = Observation("csv")
    got = {r["Order ID"]: (r["Row ID"], r["Product Name"], r["Sales"]) for r in fs.read_csv(spark, path, observation=seen).collect()}
    assert got == {"O1": (1, 'Binder 7" wide, black', 2.5), "O2": (2, "two\nlines", None), "O3": (3, None, None)}
    assert seen.get == {"rows": 3, "malformed": 1}


def test_csv_files_with_other_headers_are_refused_by_name(spark):
    path = feed(spark, {"a.csv": "Row ID,Order ID,City\n1,O1,Boston\n", "b.csv": "Row ID,City,Order ID\n2,Delft,O2\n"})
    with pytest.raises(Exception, match=r"[ab]\.csv"):
        fs.read_csv(spark, path).collect()


def test_refused_lines_keep_their_reason_text_and_file(spark):
    header = "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City,Sales,Quantity\n"
    who = "Std,C1,Ann Lee,Consumer,US,Boston"
    path = feed(spark, {"a.csv": f"{header}1,O1,05/01/2018,06/01/2018,{who},1.5,2\n1,O1,n/a,06/01/2018,{who},1.5,2\n2,O2,31/02/2018,07/01/2018,{who},1.5,2\n",
                        "b.csv": f"{header}2,O2,,,{who},1.5,2\n3,O3,08/01/2018,,{who},1.5,two\n4,O4,09/01/2018,01/01/2018,{who},x,1\n"})
    bronze = fresh_path(spark, "b")
    md.ingest_bronze(spark, path, bronze, on_bad_date="null", file_column="Source File")
    for strict, kept, rejected in ((False, {1, 3, 4}, {2: "unreadable order_date"}),
                                   (True, {1}, {2: "unreadable order_date", 3: "no ship_date, unreadable quantity", 4: "no sales"})):
        out = fresh_path(spark, "judged")
        r = md.build_silver_quarantined(spark, bronze, out, strict)
        assert (r.records_in, r.records_out, r.duplicates, r.rejected) == (6, len(kept), 2, len(rejected))
        silver, bad = md.read_judged(spark, out, "kept"), {x.row_id: x for x in md.read_judged(spark, out, "rejected").collect()}
        full = md.silver_frame(fs.read_layer(spark, bronze), strict)
        assert sorted(silver.columns) == sorted(full.columns)
        assert silver.select(full.columns).exceptAll(full).count() == 0 and full.exceptAll(silver.select(full.columns)).count() == 0
        assert {k: x.reason for k, x in bad.items()} == rejected and {x.row_id for x in silver.collect()} == kept
        assert (bad[2].order_date_text, bad[2].copies, bad[2].year, bad[2].day) == ("31/02/2018", 2, 2018, 7) and bad[2].source_file.endswith("a.csv")
        if strict:
            assert bad[3].quantity_text == "two" and bad[3].source_file.endswith("b.csv")


def test_distinct_counts_of_any_span_come_from_the_state_of_its_days(spark):
    def lines(first, last, step):
        return (spark.range(first, last, step).select(F.col("id").alias("n"), (F.col("id") % 7 - 3).cast("int").alias("signed"),
                F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id") % 11)).alias("t"),
                F.when(F.col("id") % 13 > 0, F.date_add(F.lit("2020-02-27").cast("date"), (F.col("id") % 6).cast("int"))).alias("order_date"))
                .withColumn("nothing", F.lit(None).cast("bigint")))

    columns, path = ["n", "signed", "t", "order_date", "nothing"], fresh_path(spark, "state")
    old, new = lines(-40_000, 70_000, 37), lines(-90, 70_000, 31)
    again = new.where("order_date = date'2020-02-29'")
    write_distinct_state(old, path, columns)
    write_distinct_state(again, path, columns)
    now = old.where("not order_date <=> date'2020-02-29'").union(again)
    state = fs.read_layer(spark, path)

    def counts(df):
        return {r.column_name: r.distinct_values for r in df.collect()}

    assert counts(distinct_between(state, columns)) == counts(rp.distinct_counts(now, columns))
    for start, end in (("2020-02-28", "2020-03-01"), ("2020-02-29", "2020-02-29"), ("2021-01-01", "2021-01-02")):
        span = distinct_between(state, columns, start, end)
        assert counts(span) == counts(rp.distinct_counts(now.where(f"order_date between '{start}' and '{end}'"), columns))
    assert "PartitionFilters: [isnotnull" in span._jdf.queryExecution().toString()


def test_nothing_to_refuse_and_nothing_at_all(spark):
    for rows, counts in (([], (0, 0, 0, 0)), ([("1", "O1", "05/01/2018", None)], (1, 1, 0, 0)), ([("1", "O1", "bad", None)], (1, 0, 0, 1))):
        out = fresh_path(spark, "judged")
        r = md.build_silver_quarantined(spark, "", out, source=source(spark, rows))
        assert (r.records_in, r.records_out, r.duplicates, r.rejected) == counts
        assert (md.read_judged(spark, out, "kept").count(), md.read_judged(spark, out, "rejected").count()) == counts[1::2]


def test_files_of_several_layouts_are_united_by_name(spark):
    path = feed(spark, {"a.csv": "Row ID,Order ID,City\n1,O1,Boston\n", "b.csv": 'City,Order ID,Row ID,Note\n"Delft, old",O2,2,x\n',
                        "c d.csv": "Row ID,Order ID,City\r\n3,O3,\r\n", "empty.csv": ""})
    got = fs.read_csv_layouts(spark, path, file_column="File")
    assert got.columns == ["Row ID", "Order ID", "City", "Note", "File", "_layout"]
    rows = {r["Row ID"]: r for r in got.collect()}
    assert {k: (r["Order ID"], r["City"], r["Note"]) for k, r in rows.items()} == {1: ("O1", "Boston", None), 2: ("O2", "Delft, old", "x"), 3: ("O3", None, None)}
    assert rows[1]["_layout"] == rows[3]["_layout"] != rows[2]["_layout"] and rows[2]["File"].endswith("b.csv")
    assert len(fs.csv_layouts(spark, path)) == 2
    assert fs.read_csv_layouts(spark, feed(spark, {"a.csv": ""})).count() == 0


def test_source_rows_and_malformed_rows_reach_the_stage_metrics(spark):
    header = "Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City\n"
    path = feed(spark, {"a.csv": header + "1,O1,05/01/2018,,Std,C1,Ann Lee,Consumer,US,Boston\n2,O2\n"})
    run = {r.stage: r for r in md.run_medallion(spark, path, fresh_path(spark, "lake"), on_bad_date="null").collect()}
    assert (run["bronze"].records_in, run["bronze"].malformed_rows, run["silver"].records_out) == (2, 1, 1)


def test_a_run_without_usable_rows(spark):
    for rows in ([], [("1", "O1", "bad", None)]):
        run = {r.stage: r for r in md.run_medallion(spark, None, fresh_path(spark, "empty"), source=source(spark, rows), on_bad_date="null").collect()}
        assert run["gold_customer"].records_out == 0 and run["gold_sales"].success_rate is None
    none = spark.createDataFrame([], "customer_id string, orders_last_month long, orders_last_6_months long, orders_total long")
    assert rp.active_customers(none).first().pct_active_last_month is None


def test_catalog_guards(spark):
    bronze = fresh_path(spark, "bc")
    md.ingest_bronze(spark, "", bronze, on_bad_date="null", source=source(spark, [("1", "O1", "05/01/2018", None), ("2", "O2", "bad", None)]))
    cat.register_layers(spark, "guards", {"bronze": bronze})
    assert sorted(map(tuple, cat.table_partitions(spark, "guards", "bronze_retail_sales").collect()), key=str) == [(2018, 1, 5), (None, None, None)]
    comments = {r.column_name: r.comment for r in cat.table_columns(spark, "guards", "bronze_retail_sales").collect()}
    assert comments["Sub-Category"] and len(comments) == 22
    md.ingest_bronze(spark, "", bronze, source=source(spark, [("3", "O3", "06/01/2018", None)]), mode="append")
    cat.add_partitions(spark, "guards", "bronze_retail_sales", spark.createDataFrame([(2018, 1, 6)], "year int, month int, day int"))
    assert spark.table("guards.bronze_retail_sales").count() == 3
    spark.sql("CREATE TABLE guards.own (a INT) USING PARQUET")
    with pytest.raises(ValueError, match="MANAGED"):
        cat.register_table(spark, "guards", "own", bronze)
    assert spark.catalog.tableExists("guards.own")
    spark.sql("DROP TABLE guards.own")


def test_first_existing_raises_other_errors(spark):
    path = fresh_path(spark, "first")
    spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        fs.read_first_existing(spark, [path, path], ["nothing"]).collect()
    with pytest.raises(FileNotFoundError):
        fs.read_first_existing(spark, [fresh_path(spark, "gone")])


def test_a_cluster_session_needs_a_shared_folder():
    def fake(master):
        context = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("local-cluster[2,1,1024]"))


def test_customer_queries_read_the_lines_once(spark):
    path = fresh_path(spark, "lines")
    cl.cleanse(source(spark, [("1", "O1", "05/01/2018", None)])).write.parquet(path)
    lines = spark.read.parquet(path)
    plan = cu.customer_metrics(lines, anchor="2018-12-31")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    joined = cu.customer_left_join(lines, anchor="2018-12-31")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in joined  # all sides come from one written table
