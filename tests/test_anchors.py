"""Regression anchors of the test-data mapping at sf0.001."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_sf0001_anchors(spark):
    q = entry.queries()
    cm = q["customer_metrics"](spark, SF)
    sums = cm.agg(F.count(F.lit(1)), F.sum("orders_last_month"), F.sum("orders_last_6_months"),
                  F.sum("orders_total")).first()
    assert tuple(sums) == (150, 32, 105, 1473)
    assert q["gold_sales"](spark, SF).count() == 1473
    dup = {r.metric: r.value for r in q["duplicate_counts"](spark, SF).collect()}
    assert (dup["records"], dup["distinct_keys"]) == (6000, 4599)
    assert q["active_customers"](spark, SF).first().active_last_month == 30
    assert q["partition_list"](spark, SF).count() == 1084
    t = q["date_thresholds"](spark, SF).first()
    assert (str(t.anchor_date), str(t.one_month_ago), str(t.six_months_ago)) == (
        "2001-08-01", "2001-07-01", "2001-02-01")
