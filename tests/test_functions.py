import datetime as dt

import pytest
from pyspark.sql import functions as F

from tiersmith.functions import (first_name, last_token, months_before, parse_date, parse_date_or_fail,
                                 partition_keys, rest_name, safe_cast, snake_case, strip_whitespace)

D = dt.date


@pytest.mark.parametrize("text,expected", [
    ("12/01/2018", D(2018, 1, 12)),      # day first
    ("12/15/2018", D(2018, 12, 15)),     # month-first fallback
    ("12/30/2018", D(2018, 12, 30)),
    ("30/12/2018", D(2018, 12, 30)),
    ("1/2/2018", D(2018, 2, 1)),         # unpadded
    ("2018-12-05", D(2018, 12, 5)),      # ISO
    ("29/02/2000", D(2000, 2, 29)),
    ("05/01/2018 10:30", D(2018, 1, 5)),
    ("12/30/2018 10:30:15", D(2018, 12, 30)),
    ("2018-12-05 10:30", D(2018, 12, 5)),
    ("2018-12-05T10:30:00", D(2018, 12, 5)),
    ("05/01/18", D(2018, 1, 5)),
    ("5-1-2018", D(2018, 1, 5)),
    ("05.01.2018", D(2018, 1, 5)),
    ("Jan 5, 2018", D(2018, 1, 5)),
    ("2018-12-05 junk", None),
    ("2018", None),
    ("2018-13-05", None),
    ("31.02.2018", None),
    ("31/02/2018", None),                # impossible date
    ("13/13/2018", None),
    ("bad", None),
    ("", None),
    (None, None),
])
def test_parse_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_date("s").alias("d")).first().d == expected


def test_parse_date_or_fail_raises(spark):
    df = spark.createDataFrame([("12/01/2018",), ("not a date",)], "s string")
    with pytest.raises(Exception, match="unparseable date"):
        df.select(parse_date_or_fail("s")).collect()
    ok = spark.createDataFrame([("12/01/2018",), (None,)], "s string")
    assert [r[0] for r in ok.select(parse_date_or_fail("s")).collect()] == [D(2018, 1, 12), None]


def test_strip_whitespace(spark):
    df = spark.createDataFrame([("\t New York  ",), (" \n",), ("a b",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_whitespace("s")).collect()] == ["New York", "", "a b", None]


def test_snake_case():
    assert snake_case("Row ID") == "row_id"
    assert snake_case("Sub-Category") == "sub_category"
    assert snake_case(" Postal Code ") == "postal_code"
    assert snake_case("order_date") == "order_date"


def test_names(spark):
    df = spark.createDataFrame([("John Doe",), ("A B C",), ("Madonna",), (None,)], "n string")
    rows = df.select(first_name("n"), rest_name("n"), last_token("n")).collect()
    assert [tuple(r) for r in rows] == [("John", "Doe", "Doe"), ("A", "B C", "C"),
                                        ("Madonna", "", "Madonna"), (None, None, None)]


def test_months_before_clamps_month_end(spark):
    row = spark.range(1).select(
        months_before("2018-03-31", 1).alias("a"), months_before(D(2018, 12, 30), 1).alias("b"),
        months_before("2018-12-30", 6).alias("c"), months_before("2018-08-31", 6).alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == (D(2018, 2, 28), D(2018, 11, 30), D(2018, 6, 30), D(2018, 2, 28))


def test_partition_keys_padded_and_plain(spark):
    df = spark.createDataFrame([(D(2018, 12, 1), 1), (D(2018, 12, 15), 2), (D(2018, 12, 30), 3)],
                               "order_date date, value long")
    padded = df.withColumns(partition_keys("order_date", padded=True)).orderBy("value").first()
    assert (padded.year, padded.month, padded.day) == (2018, "12", "01")
    plain = df.withColumns(partition_keys("order_date")).orderBy("value").first()
    assert (plain.year, plain.month, plain.day) == (2018, 12, 1)


def test_safe_cast(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,)], "s string")
    assert [r[0] for r in df.select(safe_cast("s", "double")).collect()] == [12.5, None, None]
    assert [r[0] for r in df.select(safe_cast(F.col("s"), "int")).collect()] == [None, None, None]


def test_scale_conf():
    from tiersmith.session import scale_conf

    big = scale_conf(100 * 1024**4, executors=1000, cores_per_executor=8)
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    small = scale_conf(10 * 1024**3, executors=10, cores_per_executor=4)
    assert small["spark.sql.shuffle.partitions"] == "80"  # two waves of 40 slots beat 40 partitions
