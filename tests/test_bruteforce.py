"""Gold operators against plain-Python brute force on random small inputs."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tiersmith.operators import customers as cu
from tiersmith.operators.sales import sales_orders

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

line = st.tuples(
    st.integers(1, 40),                                                 # row_id
    st.sampled_from(["O1", "O2", "O3", "O4", "O5", None]),             # order_id
    st.dates(dt.date(2018, 1, 1), dt.date(2019, 3, 31)),               # order_date
    st.one_of(st.none(), st.dates(dt.date(2018, 1, 1), dt.date(2019, 4, 30))),  # ship_date
    st.sampled_from(["Std", "Exp", None]),                             # ship_mode
    st.sampled_from(["C1", "C2", "C3", None]),                         # customer_id
    st.sampled_from(["Ann Lee", "Bo", "A B C", None]),                 # customer_name
    st.sampled_from(["Consumer", "Corporate", None]),                  # segment
    st.sampled_from(["US", "NL"]),                                     # country
    st.sampled_from(["Boston", "Delft", None]),                        # city
)
SCHEMA = ("row_id long, order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
          "customer_name string, segment string, country string, city string")


def months_before(d, n):
    y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def brute_customers(rows, anchor, inclusive):
    anchor = anchor or max(r[2] for r in rows)
    out = {}
    for cid in {r[5] for r in rows if r[5] is not None}:
        mine = [r for r in rows if r[5] == cid]
        last = {}
        for r in mine:
            if r[1] is not None:
                last[r[1]] = max(last.get(r[1], r[2]), r[2])

        def count(n):
            t = months_before(anchor, n)
            return sum(1 for d in last.values() if (d >= t if inclusive else d > t))

        def first(i):
            c = [(r[2], r[0], r[i]) for r in mine if r[i] is not None]
            return min(c)[2] if c else None

        name = first(6)
        fn = None if name is None else name.split(" ", 1)[0]
        ln = None if name is None else (name.split(" ", 1)[1] if " " in name else "")
        out[cid] = (cid, fn, ln, first(7), first(8), count(1), count(6), len(last))
    return out


@SETTINGS
@given(st.lists(line, min_size=1, max_size=40), st.booleans(),
       st.one_of(st.none(), st.dates(dt.date(2018, 6, 1), dt.date(2019, 3, 31))))
def test_customer_metrics_brute_force(spark, rows, inclusive, anchor):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.customer_id: tuple(r) for r in cu.customer_metrics(df, anchor=anchor, inclusive=inclusive).collect()}
    assert got == brute_customers(rows, anchor, inclusive)


def brute_sales(rows):
    out = {}
    for oid in {r[1] for r in rows}:
        cand = [(r[2], r[3], r[4], r[9]) for r in rows if r[1] == oid]
        key = lambda c: tuple((v is not None, v if v is not None else "") if i >= 2 else
                              (v is None, v or dt.date.min) for i, v in enumerate(c))  # missing dates last
        out[oid] = (oid,) + min(cand, key=key)
    return out


@SETTINGS
@given(st.lists(line, min_size=1, max_size=40))
def test_sales_orders_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.order_id: tuple(r) for r in sales_orders(df).collect()}
    assert got == brute_sales(rows)
