import datetime as dt
import os


from tiersmith.operators import customers as cu
from tiersmith.operators import reports as rp
from tiersmith.operators.quality import metric_inconsistencies
from tiersmith.operators.sales import sales_orders
from tiersmith.plans import medallion as md
from tiersmith.session import fresh_path
from tiersmith.sources import files as fs

D = dt.date

SALES_FIXTURE = [  # row_id, order_id, order_date, ship_date, ship_mode, customer_id, city
    (1, "ORD-001", D(2018, 12, 30), D(2019, 1, 5), "Standard", "CUST-A", "New York"),
    (2, "ORD-001", D(2018, 12, 30), D(2019, 1, 5), "Standard", "CUST-A", "New York"),
    (3, "ORD-002", D(2018, 12, 29), D(2019, 1, 3), "Express", "CUST-B", "Chicago"),
    (4, "ORD-003", D(2018, 12, 28), D(2019, 1, 1), "Standard", "CUST-C", "Boston"),
    (5, "ORD-003", D(2018, 12, 28), D(2019, 1, 1), "Standard", "CUST-C", "Boston"),
]
SALES_SCHEMA = ("row_id long, order_id string, order_date date, ship_date date, ship_mode string, "
                "customer_id string, city string")


def test_gold_sales(spark):
    silver = spark.createDataFrame(SALES_FIXTURE, SALES_SCHEMA)
    out = sales_orders(silver)
    assert out.columns == ["order_id", "order_date", "shipment_date", "shipment_mode", "city"]
    assert dict(out.dtypes)["order_date"] == "date" and dict(out.dtypes)["shipment_date"] == "date"
    rows = out.collect()
    assert len(rows) == 3 and len({r.order_id for r in rows}) == 3
    assert all(r.order_id is not None and r.order_date is not None for r in rows)
    path = fresh_path(spark, "test_gold_sales")
    fs.write_partitioned(md.gold_sales_frame(silver), path)
    assert os.path.isdir(os.path.join(path, "year=2018", "month=12"))
    back = fs.read_layer(spark, path, out.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows))


def test_gold_sales_first_line_wins(spark):
    data = [(1, "O", D(2018, 1, 2), None, "B", "C", "X"), (2, "O", D(2018, 1, 1), D(2018, 1, 9), "Z", "C", "Y"),
            (3, "O", D(2018, 1, 1), D(2018, 1, 3), "Z", "C", "Y")]
    r = sales_orders(spark.createDataFrame(data, SALES_SCHEMA)).collect()
    assert [tuple(x) for x in r] == [("O", D(2018, 1, 1), D(2018, 1, 3), "Z", "Y")]


CUSTOMER_ORDERS = [  # order_id, order_date, customer_id, name, lines
    ("ORD-001", D(2018, 12, 15), "CUST-A", "John Doe", 2),
    ("ORD-002", D(2018, 12, 10), "CUST-B", "Jane Smith", 2),
    ("ORD-003", D(2018, 11, 20), "CUST-C", "Bob Jones", 1),
    ("ORD-005", D(2018, 8, 1), "CUST-A", "John Doe", 2),
    ("ORD-007", D(2018, 1, 15), "CUST-C", "Bob Jones", 2),
    ("ORD-010", D(2018, 2, 10), "CUST-A", "John Doe", 2),
    ("ORD-011", D(2017, 12, 1), "CUST-B", "Jane Smith", 2),
    ("ORD-014", D(2018, 7, 1), "CUST-A", "John Doe", 2),
]
CUSTOMER_SCHEMA = ("row_id long, order_id string, order_date date, customer_id string, customer_name string, "
                   "segment string, country string, city string")


def customer_lines(spark, extra=()):
    rows, rid = [], 0
    for oid, d, cid, name, n in CUSTOMER_ORDERS:
        for _ in range(n):
            rid += 1
            rows.append((rid, oid, d, cid, name, "Consumer", "USA", "New York"))
    return spark.createDataFrame(rows + list(extra), CUSTOMER_SCHEMA)


def test_gold_customer_golden_values(spark):
    out = cu.customer_metrics(customer_lines(spark), anchor="2018-12-30")
    assert tuple(out.columns) == cu.GOLD_CUSTOMER_COLUMNS
    assert all(t == "bigint" for c, t in out.dtypes if c.startswith("orders_"))
    got = {r.customer_id: (r.customer_first_name, r.customer_last_name, r.orders_last_month,
                           r.orders_last_6_months, r.orders_total) for r in out.collect()}
    assert got == {"CUST-A": ("John", "Doe", 1, 3, 4), "CUST-B": ("Jane", "Smith", 1, 1, 2),
                   "CUST-C": ("Bob", "Jones", 0, 1, 2)}
    assert metric_inconsistencies(out).count() == 0
    # the join-chain form gives the same rows
    joined = cu.customer_left_join(customer_lines(spark), anchor="2018-12-30")
    assert sorted(map(tuple, joined.select(*out.columns).collect())) == sorted(map(tuple, out.collect()))


def test_gold_customer_default_anchor_is_latest_order(spark):
    # latest order 2018-12-15 -> thresholds 2018-11-15 and 2018-06-15
    got = {r.customer_id: (r.orders_last_month, r.orders_last_6_months)
           for r in cu.customer_metrics(customer_lines(spark)).collect()}
    assert got == {"CUST-A": (1, 3), "CUST-B": (1, 1), "CUST-C": (1, 1)}


def test_gold_customer_edge_cases(spark):
    extra = [
        (100, "ORD-020", D(2018, 11, 30), "CUST-D", None, None, "USA", "X"),       # threshold day
        (101, "ORD-020", D(2018, 11, 30), "CUST-D", "Madonna", "Corporate", "USA", "X"),
        (102, "ORD-021", D(2018, 10, 1), "CUST-E", "A B C", "Consumer", "USA", "X"),  # spans threshold
        (103, "ORD-021", D(2018, 12, 1), "CUST-E", "A B C", "Consumer", "USA", "X"),
        (104, "ORD-022", D(2018, 12, 1), None, "Ghost", "Consumer", "USA", "X"),       # null customer
    ]
    lines = customer_lines(spark, extra)
    got = {r.customer_id: r for r in cu.customer_metrics(lines, anchor="2018-12-30").collect()}
    assert None not in got
    d, e = got["CUST-D"], got["CUST-E"]
    assert (d.customer_first_name, d.customer_last_name, d.customer_segment) == ("Madonna", "", "Corporate")
    assert (d.orders_last_month, d.orders_total) == (1, 1)
    assert (e.customer_first_name, e.customer_last_name, e.orders_last_month, e.orders_total) == ("A", "B C", 1, 1)
    excl = {r.customer_id: r for r in cu.customer_metrics(lines, anchor="2018-12-30", inclusive=False).collect()}
    assert excl["CUST-D"].orders_last_month == 0
    last = {r.customer_id: r for r in
            cu.customer_metrics(lines, anchor="2018-12-30", name_rule="last_token").collect()}
    assert (last["CUST-D"].customer_last_name, last["CUST-E"].customer_last_name) == ("Madonna", "C")


def test_reports(spark):
    out = cu.customer_metrics(customer_lines(spark), anchor="2018-12-30")
    top = rp.top_customers(out, 2).collect()
    assert [r.customer_id for r in top] == ["CUST-A", "CUST-B"]
    seg = rp.segment_distribution(out).collect()
    assert [(r.customer_segment, r.customers) for r in seg] == [("Consumer", 3)]
    act = rp.active_customers(out).first()
    assert (act.customers, act.active_last_month, act.active_last_6_months) == (3, 2, 3)
    assert abs(act.pct_active_last_month - 66.6667) < 1e-9
    summ = rp.customer_summary(out).first()
    assert (summ.unique_customers, summ.total_orders) == (3, 8)
    st = rp.customer_stats(out).first()
    assert st.max_total == 4 and abs(st.avg_total - 8 / 3) < 1e-6


def test_default_anchor_counts_lines_without_customer(spark):
    # a line without customer still moves the anchor: 2019-01-31 -> last month starts 2018-12-31
    extra = [(200, "ORD-099", D(2019, 1, 31), None, "Nobody", "Consumer", "USA", "X")]
    got = {r.customer_id: r.orders_last_month for r in cu.customer_metrics(customer_lines(spark, extra)).collect()}
    assert got == {"CUST-A": 0, "CUST-B": 0, "CUST-C": 0}
    joined = {r.customer_id: r.orders_last_month for r in cu.customer_left_join(customer_lines(spark, extra)).collect()}
    assert joined == got


def test_gold_customer_partition_by_latest(spark):
    lines = customer_lines(spark)
    first = {r.customer_id: (r.year, r.month) for r in md.gold_customer_frame(lines, "2018-12-30").collect()}
    latest = {r.customer_id: (r.year, r.month) for r in md.gold_customer_frame(lines, "2018-12-30", "latest").collect()}
    assert first == {"CUST-A": (2018, 2), "CUST-B": (2017, 12), "CUST-C": (2018, 1)}
    assert latest == {"CUST-A": (2018, 12), "CUST-B": (2018, 12), "CUST-C": (2018, 11)}
