import datetime as dt

import pytest
from pyspark.sql import functions as F

from tiersmith.operators import cleanse as cl
from tiersmith.operators.dedup import duplicate_counts, first_rows
from tiersmith.operators.quality import cleanse_metrics, null_counts
from tiersmith.sources.files import SOURCE_SCHEMA

D = dt.date


def source(spark, rows):
    """Rows given as dicts of source columns; missing columns are null."""
    names = SOURCE_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SOURCE_SCHEMA)


BASE = {"Order ID": "O-1", "Order Date": "05/01/2018", "Ship Date": "07/01/2018", "Ship Mode": "Standard",
        "Customer ID": "C-1", "Customer Name": "John Doe", "Segment": "Consumer", "Country": "US",
        "City": "Boston", "Product ID": "P-1", "Sales": 10.0, "Quantity": "2"}


def row(rid, **kw):
    r = dict(BASE)
    r["Row ID"] = rid
    r.update({k.replace("_", " "): v for k, v in kw.items()})
    return r


def test_validate_required_columns(spark):
    df = source(spark, [row(1)]).drop("City", "Segment")
    with pytest.raises(ValueError, match="City"):
        cl.validate_required_columns(df)
    assert cl.validate_required_columns(source(spark, [row(1)])) is not None


def test_cleanse_edge_cases(spark):
    rows = [
        row(1, Sales=5.0), row(1, Sales=3.0),                        # duplicate row id
        row(2, **{"Order_Date": "bad"}),                              # unparseable -> dropped
        row(3, **{"Order_Date": ""}), row(4, **{"Order_Date": None}),
        row(5, **{"Order_Date": "31/02/2018"}),
        row(6, **{"Order_Date": "1/2/2018", "Ship_Date": "2018-12-05"}),
        row(7, **{"Order_Date": "12/30/2018", "Ship_Date": "31/12/2018"}),
        row(8, **{"Order_Date": "05/01/2018", "Ship_Date": "01/01/2018"}),  # ship before order
        row(9, City="\t New York  "),
        row(10, Quantity="abc"),
    ]
    out = {r.row_id: r for r in cl.cleanse(source(spark, rows)).collect()}
    assert sorted(out) == [1, 6, 7, 8, 9, 10]
    assert out[1].sales == 3.0                      # first by the remaining columns
    assert out[6].order_date == D(2018, 2, 1) and out[6].ship_date == D(2018, 12, 5)
    assert out[7].order_date == D(2018, 12, 30) and out[7].ship_date == D(2018, 12, 31)
    assert out[8].ship_date is None and out[8].order_date == D(2018, 1, 5)
    assert out[9].city == "New York"
    assert out[10].quantity is None
    assert set(out[1].asDict()) == {"row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
                                    "customer_name", "segment", "country", "city", "state", "postal_code", "region",
                                    "product_id", "category", "sub_category", "product_name", "sales", "quantity"}
    m = {r.metric: r.value for r in cleanse_metrics(source(spark, rows)).collect()}
    assert m["source_records"] == 11 and m["duplicates_removed"] == 1
    assert m["null_order_dates_removed"] == 4 and m["final_records"] == 6
    assert m["invalid_ship_dates_before_order"] == 1 and m["records_removed"] == 5


def test_strict_filter(spark):
    rows = [row(1), row(2, Ship_Date="never"), row(3, Quantity="x")]
    out = cl.cleanse(source(spark, rows), strict=True)
    assert sorted(r.row_id for r in out.collect()) == [1]


def test_dedup_is_order_independent(spark):
    data = [(1, "b", 2.0), (1, "a", 9.0), (1, "a", 1.0), (None, "z", 0.0), (None, "y", 0.0), (2, None, 1.0)]
    df = spark.createDataFrame(data, "k long, s string, v double")
    a = first_rows(df, ["k"]).collect()
    b = first_rows(df.orderBy(F.desc("v")).repartition(3), ["k"]).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert sorted(map(tuple, a), key=str) == sorted([(1, "a", 1.0), (None, "y", 0.0), (2, None, 1.0)], key=str)
    counts = {r.metric: r.value for r in duplicate_counts(df, ["k"]).collect()}
    assert counts == {"records": 6, "distinct_keys": 3, "duplicates": 3}


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a long, b string")
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {"a": 2, "b": 2}
