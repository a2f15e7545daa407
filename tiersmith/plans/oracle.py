"""DuckDB SQL for the correctness oracle: the same views and queries as the
Spark plans in :mod:`tiersmith.plans.registry`, written independently in SQL.

Every view here mirrors a Spark function; a comment names it.
"""

from __future__ import annotations

_JOIN = """FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""

# tiersmith.sources.testdata.retail_lines
RETAIL = f"""retail AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS row_id,
         CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CAST(l.l_shipdate AS DATE) AS ship_date,
         o.o_orderpriority AS ship_mode,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         replace(c.c_name, '#', ' ') AS customer_name,
         c.c_mktsegment AS segment,
         r.r_name AS country,
         n.n_name AS city,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         l.l_extendedprice AS sales,
         CAST(l.l_quantity AS BIGINT) AS quantity
  {_JOIN})"""

_OD = "CAST(o.o_orderdate AS DATE)"
_SD = "CAST(l.l_shipdate AS DATE)"

# tiersmith.sources.testdata.retail_source
_FD = f"({_OD} + CASE WHEN l.l_suppkey % 7 = 0 THEN 3 ELSE 0 END)"
_K = "(o.o_orderkey + l.l_partkey) % 20"
SOURCE = f"""source AS (
  SELECT CASE WHEN l.l_partkey % 97 = 0 THEN 'A-' ELSE '' END || CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) AS "Row ID",
         CAST(l.l_orderkey AS VARCHAR) AS "Order ID",
         CASE WHEN {_K} < 9 THEN strftime({_FD}, '%d/%m/%Y')
              WHEN {_K} = 9 THEN strftime({_FD}, '%d.%m.%Y')
              WHEN {_K} < 12 THEN strftime({_FD}, '%m/%d/%Y')
              WHEN {_K} = 12 THEN strftime({_FD}, '%Y-%m-%d')
              WHEN {_K} = 13 THEN strftime({_FD}, '%-d-%-m-%Y')
              WHEN {_K} < 16 THEN strftime({_FD}, '%-d/%-m/%Y')
              WHEN {_K} = 16 THEN strftime({_FD}, '%d/%m/%Y') || ' 10:30'
              WHEN {_K} = 17 THEN chr(9) || ' ' || strftime({_FD}, '%d/%m/%Y') || '  '
              WHEN {_K} = 18 THEN '31/02/' || strftime({_FD}, '%Y')
              ELSE 'n/a' END AS "Order Date",
         CASE WHEN l.l_linenumber <= 5 THEN strftime({_SD}, '%d/%m/%Y')
              WHEN l.l_linenumber = 6 THEN strftime({_SD}, '%Y-%m-%d')
              ELSE 'TBD' END AS "Ship Date",
         o.o_orderpriority AS "Ship Mode",
         CAST(o.o_custkey AS VARCHAR) AS "Customer ID",
         replace(c.c_name, '#', ' ') AS "Customer Name",
         c.c_mktsegment AS "Segment",
         r.r_name AS "Country",
         CASE WHEN c.c_custkey % 9 = 0 THEN chr(9) || n.n_name || '  ' ELSE n.n_name END AS "City",
         'S' || CAST(c.c_custkey % 50 AS VARCHAR) AS "State",
         lpad(CAST(c.c_custkey % 1000 AS VARCHAR), 5, '0') AS "Postal Code",
         r.r_name AS "Region",
         CAST(l.l_partkey AS VARCHAR) AS "Product ID",
         'C' || CAST(l.l_partkey % 3 AS VARCHAR) AS "Category",
         'C' || CAST(l.l_partkey % 17 AS VARCHAR) AS "Sub-Category",
         CASE l.l_partkey % 8 WHEN 0 THEN 'Binder 7" wide, "' || CAST(l.l_partkey AS VARCHAR) || '", black'
              WHEN 1 THEN 'Desk ' || CAST(l.l_partkey AS VARCHAR) || chr(10) || 'assembled'
              WHEN 2 THEN 'Paper, ' || CAST(l.l_partkey AS VARCHAR) ELSE 'Part ' || CAST(l.l_partkey AS VARCHAR) END AS "Product Name",
         l.l_extendedprice AS "Sales",
         CASE WHEN l.l_partkey % 50 = 0 THEN 'n/a'
              ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS "Quantity"
  {_JOIN})"""

SOURCE_COLUMNS = ["Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID",
                  "Customer Name", "Segment", "Country", "City", "State", "Postal Code", "Region", "Product ID",
                  "Category", "Sub-Category", "Product Name", "Sales", "Quantity"]
SOURCE_TEXT = [c for c in SOURCE_COLUMNS if c != "Sales"]


def q(name: str) -> str:
    return '"' + name + '"'


def strip(expr: str) -> str:
    """tiersmith.functions.text.strip_whitespace"""
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def parse(expr: str) -> str:
    """tiersmith.functions.dates.parse_date"""
    plain = f"regexp_replace({expr}, ' 10:30$', '')"
    return (f"CAST(coalesce(try_strptime({plain}, '%d/%m/%Y'), try_strptime({plain}, '%m/%d/%Y'), "
            f"try_strptime({plain}, '%Y-%m-%d'), try_strptime({plain}, '%d-%m-%Y'), try_strptime({plain}, '%d.%m.%Y')) AS DATE)")


def snake(name: str) -> str:
    import re
    return re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()


# tiersmith.operators.cleanse.trim_strings over the source
TRIMMED = "trimmed AS (SELECT " + ", ".join(
    (f"{strip(q(c))} AS {q(c)}" if c in SOURCE_TEXT else q(c)) for c in SOURCE_COLUMNS) + " FROM source)"


def first_per_key_sql(src: str, keys: list[str], order: list[str], columns: list[str], name: str,
                      nulls_last: tuple[str, ...] = ()) -> str:
    """tiersmith.operators.dedup.first_rows: first row per key by ``order``
    then every other column, ascending, nulls first but in ``nulls_last``."""
    rest = [c for c in columns if c not in keys and c not in order]
    by = ", ".join(f"{q(c)} ASC NULLS {'LAST' if c in nulls_last else 'FIRST'}" for c in order + rest)
    part = ", ".join(q(c) for c in keys)
    cols = ", ".join(q(c) for c in columns)
    return (f"{name} AS (SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {by}) "
            f"AS _rn FROM {src}) WHERE _rn = 1)")


# tiersmith.operators.cleanse.dated_lines: keys and dates of each line
DATED = f"""dated AS (
  SELECT *, CASE WHEN _sd >= _od THEN _sd END AS _ship, CASE WHEN _row IS NULL THEN row_number() OVER () END AS _own
  FROM (SELECT *, TRY_CAST("Row ID" AS BIGINT) AS _row, {parse(q('Order Date'))} AS _od, {parse(q('Ship Date'))} AS _sd FROM trimmed))"""
_DATES = ("_od", "_ship", "_sd")
DEDUP = first_per_key_sql("dated", ["_row", "_own"], [*_DATES, "Order ID", "Product ID", "Sales"],
                          [*SOURCE_COLUMNS, "_row", "_own", *_DATES], "dedup", _DATES)

# tiersmith.operators.cleanse.cleanse
SILVER = f"""{SOURCE}, {TRIMMED}, {DATED}, {DEDUP},
silver AS (
  SELECT _row AS row_id, "Order ID" AS order_id, _od AS order_date,
         CASE WHEN _sd < _od THEN NULL ELSE _sd END AS ship_date,
         "Ship Mode" AS ship_mode, "Customer ID" AS customer_id, "Customer Name" AS customer_name,
         "Segment" AS segment, "Country" AS country, "City" AS city, "State" AS state, "Postal Code" AS postal_code,
         "Region" AS region, "Product ID" AS product_id, "Category" AS category, "Sub-Category" AS sub_category,
         "Product Name" AS product_name, "Sales" AS sales, TRY_CAST("Quantity" AS BIGINT) AS quantity
  FROM dedup WHERE _od IS NOT NULL)"""

SILVER_COLUMNS = ["row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
                  "segment", "country", "city", "state", "postal_code", "region", "product_id", "category",
                  "sub_category", "product_name", "sales", "quantity"]

YMD = ("CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
       "CAST(day({d}) AS INTEGER) AS day")


def ymd(d: str) -> str:
    return YMD.format(d=d)


# tiersmith.operators.sales.sales_orders over a view with silver names
def sales_sql(src: str) -> str:
    proj = (f"sales_lines AS (SELECT order_id, order_date, ship_date AS shipment_date, "
            f"ship_mode AS shipment_mode, city FROM {src})")
    return proj + ", " + first_per_key_sql(
        "sales_lines", ["order_id"], ["order_date", "shipment_date", "shipment_mode", "city"],
        ["order_id", "order_date", "shipment_date", "shipment_mode", "city"], "sales", ("order_date", "shipment_date"))


def _first_value(col: str) -> str:
    return f"first({col} ORDER BY order_date, row_id, {col}) FILTER (WHERE {col} IS NOT NULL)"


# tiersmith.operators.customers.customer_metrics over a view with silver names
def customers_sql(src: str, inclusive: bool = True, name_rule: str = "first_space") -> str:
    op = ">=" if inclusive else ">"
    if name_rule == "first_space":
        last = ("CASE WHEN strpos(customer_name, ' ') > 0 THEN substr(customer_name, strpos(customer_name, ' ') + 1) "
                "ELSE '' END")
    else:
        last = "split_part(customer_name, ' ', -1)"
    anchor = f"max(order_date) AS a FROM {src}" if src == "silver" else "max(CAST(o_orderdate AS DATE)) AS a FROM orders"
    return f"""anchor AS (SELECT {anchor}),
cust_lines AS (SELECT * FROM {src} WHERE customer_id IS NOT NULL),
per_order AS (SELECT customer_id, order_id, max(order_date) AS last_date FROM cust_lines GROUP BY customer_id, order_id),
counts AS (
  SELECT customer_id,
         CAST(count(CASE WHEN last_date {op} (SELECT CAST(a - INTERVAL 1 MONTH AS DATE) FROM anchor) THEN order_id END) AS BIGINT) AS orders_last_month,
         CAST(count(CASE WHEN last_date {op} (SELECT CAST(a - INTERVAL 6 MONTH AS DATE) FROM anchor) THEN order_id END) AS BIGINT) AS orders_last_6_months,
         CAST(count(order_id) AS BIGINT) AS orders_total
  FROM per_order GROUP BY customer_id),
attrs AS (
  SELECT customer_id, {_first_value('customer_name')} AS customer_name,
         {_first_value('segment')} AS customer_segment, {_first_value('country')} AS country,
         min(order_date) AS first_order_date, max(order_date) AS latest_order_date
  FROM cust_lines GROUP BY customer_id),
customers AS (
  SELECT a.customer_id, split_part(a.customer_name, ' ', 1) AS customer_first_name,
         {last.replace('customer_name', 'a.customer_name')} AS customer_last_name,
         a.customer_segment, a.country, c.orders_last_month, c.orders_last_6_months, c.orders_total,
         a.first_order_date, a.latest_order_date
  FROM attrs a JOIN counts c ON a.customer_id = c.customer_id)"""


CUSTOMER_COLUMNS = ("customer_id, customer_first_name, customer_last_name, customer_segment, country, "
                    "orders_last_month, orders_last_6_months, orders_total")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Parameters shared with tiersmith.plans.registry.
_PRUNE = "year = 2001 AND month = 7"
_RANGE = "order_date BETWEEN DATE '2001-06-30' AND DATE '2001-07-03'"
_SOURCE_SEL = ", ".join(q(c) for c in SOURCE_COLUMNS)
# the row id as a reader with the declared schema sees it
_READ_SEL = 'TRY_CAST("Row ID" AS BIGINT) AS "Row ID", ' + ", ".join(q(c) for c in SOURCE_COLUMNS[1:])
_SILVER_SEL = ", ".join(SILVER_COLUMNS)
_BRONZE = (f"{_READ_SEL}, CAST(year(_d) AS INTEGER) AS year, CAST(month(_d) AS INTEGER) AS month, "
           f"CAST(day(_d) AS INTEGER) AS day FROM (SELECT *, {parse(strip(q('Order Date')))} AS _d FROM source)")
_BRONZE_TEXT = _BRONZE.replace(_READ_SEL, _SOURCE_SEL)
_SILVER_YMD = f"{_SILVER_SEL}, {ymd('order_date')} FROM silver"
_SALES_COLS = "order_id, order_date, shipment_date, shipment_mode, city"


def _cust(inclusive: bool = True, src: str = "retail") -> str:
    return customers_sql(src, inclusive)


def _metrics_long(pairs: list[tuple[str, str]], src: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(({e}) AS BIGINT) AS value FROM {src}" for m, e in pairs)


def _names(rule: str) -> str:
    name = "CASE WHEN p_size < 5 THEN p_brand ELSE p_name || ' ' || p_brand END"
    last = ("CASE WHEN strpos(customer_name, ' ') > 0 THEN substr(customer_name, strpos(customer_name, ' ') + 1) "
            "ELSE '' END") if rule == "first_space" else "split_part(customer_name, ' ', -1)"
    return (f"SELECT partkey, customer_name, split_part(customer_name, ' ', 1) AS customer_first_name, "
            f"{last} AS customer_last_name FROM (SELECT p_partkey AS partkey, {name} AS customer_name FROM part)")


# Days of one year come again without the lines of a sub-category; a day that holds no others stays.
_DELIVERED = f"""delivered AS (
  SELECT * EXCLUDE (_d, _others) FROM (
    SELECT *, count(*) FILTER (WHERE "Sub-Category" <> 'C3') OVER (PARTITION BY _d) AS _others
    FROM (SELECT *, {parse(strip(q('Order Date')))} AS _d FROM source))
  WHERE "Sub-Category" <> 'C3' OR _others = 0 OR _d IS NULL OR _d NOT BETWEEN DATE '2001-01-01' AND DATE '2001-12-31')"""

# tiersmith.operators.quarantine.judged_lines, strict
def _refusal(column: str, text: str | None) -> str:
    blank = f"coalesce({text}, '') = ''" if text else "true"
    return f"CASE WHEN {column} IS NULL THEN CASE WHEN {blank} THEN 'no {column}' ELSE 'unreadable {column}' END END"


_JUDGED = with_(SOURCE, TRIMMED, DATED, "grp AS (SELECT _row, _own, count(*) AS copies FROM dated GROUP BY _row, _own)", DEDUP, f"""typed AS (
  SELECT d._row AS row_id, d."Order ID" AS order_id, d._od AS order_date, d._sd AS ship_date,
         "Ship Mode" AS ship_mode, "Customer ID" AS customer_id, "Customer Name" AS customer_name,
         "Segment" AS segment, "Country" AS country, "City" AS city, "State" AS state, "Postal Code" AS postal_code,
         "Region" AS region, "Product ID" AS product_id, "Category" AS category, "Sub-Category" AS sub_category,
         "Product Name" AS product_name, "Sales" AS sales, TRY_CAST("Quantity" AS BIGINT) AS quantity, CAST(g.copies AS BIGINT) AS copies,
         "Row ID" AS row_id_text, "Order Date" AS order_date_text, "Ship Date" AS ship_date_text, "Quantity" AS quantity_text
  FROM dedup d JOIN grp g ON d._row IS NOT DISTINCT FROM g._row AND d._own IS NOT DISTINCT FROM g._own),
judged AS (
  SELECT * REPLACE (CASE WHEN ship_date < order_date THEN NULL ELSE ship_date END AS ship_date),
         concat_ws(', ', {_refusal('order_date', 'order_date_text')}, {_refusal('ship_date', 'ship_date_text')},
                   {_refusal('sales', None)}, {_refusal('quantity', 'quantity_text')}) AS reason
  FROM typed)""")

_LATE = '"Sub-Category" IN (\'C3\', \'C5\')'
ORACLES: dict[str, str] = {
    "csv_layouts": with_(SOURCE) + f"""SELECT {_READ_SEL.replace('"Region"', f'CASE WHEN NOT {_LATE} THEN "Region" END AS "Region"')},
         CASE WHEN {_LATE} THEN "Category" END AS "Line" FROM source""",
    "distinct_counts_range": with_(SILVER) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM silver "
        "WHERE order_date BETWEEN DATE '2001-01-01' AND DATE '2001-12-31'"
        for c in ("row_id", "quantity", "order_id", "customer_id", "city", "ship_date")),
    "rejected_lines": _JUDGED + f"SELECT *, {ymd('coalesce(order_date, ship_date)')} FROM judged WHERE reason <> ''",
    "silver_kept": _JUDGED + f"SELECT {_SILVER_SEL}, {ymd('order_date')} FROM judged WHERE reason = ''",
    "verdict_counts": _JUDGED + """SELECT CASE WHEN reason = '' THEN 'kept' ELSE 'rejected' END AS verdict, nullif(reason, '') AS reason,
         count(*) AS lines, CAST(sum(copies) AS BIGINT) AS source_lines, CAST(sum(copies - 1) AS BIGINT) AS duplicates
  FROM judged GROUP BY ALL""",
    # sources & sinks
    "csv_scan": with_(SOURCE) + f"SELECT {_READ_SEL} FROM source",
    "daily_rerun": with_(SOURCE) + f"SELECT {_BRONZE_TEXT}",
    "bronze_append": with_(SOURCE) + f"SELECT {_BRONZE_TEXT} UNION ALL SELECT {_BRONZE_TEXT} WHERE _d = DATE '2001-06-30'",
    "incremental_silver_deliveries": with_(SILVER) + f"SELECT {_SILVER_YMD}",
    "incremental_silver_replaced": with_(SILVER.replace("FROM source", "FROM delivered").replace(SOURCE, f"{SOURCE}, {_DELIVERED}", 1))
    + f"SELECT {_SILVER_YMD}",
    "incremental_gold_sales": with_(SILVER.replace("FROM source", "FROM delivered").replace(SOURCE, f"{SOURCE}, {_DELIVERED}", 1), sales_sql("silver"))
    + f"SELECT {_SALES_COLS}, {ymd('order_date')} FROM sales",
    "bronze_ingest": with_(SOURCE) + f"SELECT {_BRONZE}",
    "bronze_scan": with_(SOURCE) + f"SELECT {_BRONZE}",
    "silver_scan": with_(SILVER) + f"SELECT {_SILVER_YMD}",
    "silver_write": with_(SILVER) + f"SELECT {_SILVER_YMD}",
    "incremental_silver": with_(SILVER) + f"SELECT {_SILVER_YMD}",
    "gold_sales_write": with_(SILVER, sales_sql("silver")) + f"SELECT {_SALES_COLS}, {ymd('order_date')} FROM sales",
    "gold_customer_write": with_(SILVER, _cust(src="silver"))
    + f"SELECT {CUSTOMER_COLUMNS}, {ymd('first_order_date')} FROM customers",
    "sales_by_date_write": with_(SILVER, sales_sql("silver")) + f"SELECT {_SALES_COLS} FROM sales",
    "plain_write": with_(SILVER, _cust(src="silver")) + f"SELECT {CUSTOMER_COLUMNS} FROM customers",
    "write_verify": with_(SILVER, sales_sql("silver"))
    + "SELECT CAST(count(*) AS BIGINT) AS rows_written, CAST(count(*) AS BIGINT) AS rows_read, "
      "true AS columns_match FROM sales",
    "catalog_scan": with_(SILVER) + f"SELECT {_SILVER_YMD}",
    "catalog_partitions": with_(SILVER) + f"SELECT DISTINCT year, month, day FROM (SELECT {_BRONZE})",
    # partitions
    "partition_columns": with_(RETAIL) + f"SELECT row_id, order_id, order_date, {ymd('order_date')} FROM retail",
    "partition_columns_padded": with_(RETAIL)
    + "SELECT row_id, order_id, order_date, CAST(year(order_date) AS INTEGER) AS year, "
      "strftime(order_date, '%m') AS month, strftime(order_date, '%d') AS day FROM retail",
    "partition_list": with_(RETAIL) + f"SELECT DISTINCT {ymd('order_date')} FROM retail",
    "partition_counts": with_(RETAIL)
    + f"SELECT year, month, day, CAST(count(*) AS BIGINT) AS records FROM (SELECT {ymd('order_date')} FROM retail) "
      "GROUP BY year, month, day",
    "pruned_scan": with_(SILVER) + f"SELECT * FROM (SELECT {_SILVER_YMD}) WHERE {_PRUNE}",
    "range_scan": with_(SILVER) + f"SELECT {_SILVER_YMD} WHERE {_RANGE}",
    "range_calendar": with_(RETAIL)
    + "SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
      "CAST(day(date) AS INTEGER) AS day, "
      "'year=' || strftime(date, '%Y') || '/month=' || strftime(date, '%m') || '/day=' || strftime(date, '%d') "
      "AS partition_path FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), "
      "INTERVAL 1 DAY)) AS DATE) AS date FROM retail)",
    # projections
    "sales_project": with_(RETAIL)
    + "SELECT order_id, order_date, ship_date AS shipment_date, ship_mode AS shipment_mode, city FROM retail",
    "rename_map": with_(RETAIL)
    + "SELECT row_id, order_id, order_date, ship_date AS shipment_date, ship_mode AS shipment_mode, customer_id, "
      "customer_name, segment AS customer_segment, country, city, product_id, sales, quantity FROM retail",
    "snake_case_columns": with_(SOURCE) + "SELECT " + ", ".join(f"{q(c)} AS {snake(c)}" for c in SOURCE_COLUMNS)
    + " FROM source",
    "silver_cleanse": with_(SILVER) + f"SELECT {_SILVER_SEL} FROM silver",
    "safe_cast": with_(SOURCE)
    + "SELECT TRY_CAST(\"Row ID\" AS BIGINT) AS row_id, TRY_CAST(\"Quantity\" AS BIGINT) AS quantity, "
      "TRY_CAST(\"Order ID\" AS BIGINT) AS order_key, TRY_CAST(\"Customer Name\" AS INTEGER) AS name_as_int "
      "FROM source",
    "date_thresholds": with_(RETAIL)
    + "SELECT a AS anchor_date, CAST(a - INTERVAL 1 MONTH AS DATE) AS one_month_ago, "
      "CAST(a - INTERVAL 6 MONTH AS DATE) AS six_months_ago FROM (SELECT max(order_date) AS a FROM retail)",
    # filters
    "filter_valid_dates": with_(SOURCE)
    + f"SELECT * FROM (SELECT \"Row ID\" AS row_id, {strip(q('Order ID'))} AS order_id, "
      f"{parse(strip(q('Order Date')))} AS order_date FROM source) WHERE order_date IS NOT NULL",
    "filter_strict": with_(SOURCE)
    + f"SELECT * FROM (SELECT \"Row ID\" AS row_id, {strip(q('Order ID'))} AS order_id, "
      f"{parse(strip(q('Order Date')))} AS order_date, {parse(strip(q('Ship Date')))} AS ship_date, "
      f"\"Sales\" AS sales, TRY_CAST({strip(q('Quantity'))} AS BIGINT) AS quantity FROM source) "
      "WHERE order_date IS NOT NULL AND ship_date IS NOT NULL AND sales IS NOT NULL AND quantity IS NOT NULL",
    "orders_total": with_(RETAIL, _cust()) + "SELECT customer_id, orders_total FROM customers",
    "orders_last_month": with_(RETAIL, _cust()) + "SELECT customer_id, orders_last_month FROM customers",
    "orders_last_6_months": with_(RETAIL, _cust()) + "SELECT customer_id, orders_last_6_months FROM customers",
    "orders_last_month_exclusive": with_(RETAIL, _cust(False)) + "SELECT customer_id, orders_last_month FROM customers",
    "ship_before_order": with_(RETAIL)
    + "SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count_if(ship_date < order_date) AS BIGINT) AS ship_before_order "
      "FROM retail",
    "fix_ship_date": with_(RETAIL)
    + "SELECT row_id, order_id, order_date, CASE WHEN ship_date < order_date THEN NULL ELSE ship_date END AS ship_date "
      "FROM retail",
    "metric_inconsistencies": with_(RETAIL, _cust())
    + "SELECT * FROM (SELECT customer_id, customer_first_name, customer_last_name, customer_segment, country, "
      "CASE WHEN customer_segment = 'BUILDING' THEN orders_last_6_months + 1 ELSE orders_last_month END "
      "AS orders_last_month, orders_last_6_months, orders_total FROM customers) "
      "WHERE orders_last_month > orders_last_6_months OR orders_last_6_months > orders_total",
    "null_counts": with_(SILVER) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM silver"
        for c in SILVER_COLUMNS),
    "sales_null_counts": with_(RETAIL, sales_sql("retail")) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM sales"
        for c in ("order_id", "order_date", "shipment_date", "shipment_mode", "city")),
    "customer_null_counts": with_(RETAIL, _cust()) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM customers"
        for c in CUSTOMER_COLUMNS.split(", ")),
    "active_customers": with_(RETAIL, _cust())
    + "SELECT CAST(count(*) AS BIGINT) AS customers, CAST(count_if(orders_last_month > 0) AS BIGINT) AS active_last_month, "
      "CAST(count_if(orders_last_6_months > 0) AS BIGINT) AS active_last_6_months, "
      "round(CAST(count_if(orders_last_month > 0) AS DOUBLE) * 100 / count(*), 4) AS pct_active_last_month, "
      "round(CAST(count_if(orders_last_6_months > 0) AS DOUBLE) * 100 / count(*), 4) AS pct_active_last_6_months "
      "FROM customers",
    # aggregation and dedup
    "gold_sales": with_(RETAIL, sales_sql("retail")) + f"SELECT {_SALES_COLS} FROM sales",
    "customer_left_join": with_(RETAIL, _cust()) + f"SELECT {CUSTOMER_COLUMNS} FROM customers",
    "customer_latest_order": with_(RETAIL, _cust()) + "SELECT customer_id, latest_order_date FROM customers",
    "customer_first_order": with_(RETAIL, _cust()) + "SELECT customer_id, first_order_date FROM customers",
    "customer_attributes": with_(RETAIL, _cust())
    + "SELECT customer_id, customer_first_name, customer_last_name, customer_segment, country FROM customers",
    "date_range": with_(RETAIL, sales_sql("retail"))
    + "SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM sales",
    "customer_summary": with_(RETAIL, _cust())
    + "SELECT CAST(count(*) AS BIGINT) AS unique_customers, CAST(sum(orders_total) AS BIGINT) AS total_orders "
      "FROM customers",
    "customer_stats": with_(RETAIL, _cust())
    + "SELECT round(avg(orders_total), 6) AS avg_total, CAST(max(orders_total) AS BIGINT) AS max_total, "
      "round(avg(orders_last_6_months), 6) AS avg_6m, round(avg(orders_last_month), 6) AS avg_1m FROM customers",
    "segment_distribution": with_(RETAIL, _cust())
    + "SELECT customer_segment, CAST(count(*) AS BIGINT) AS customers, round(avg(orders_total), 6) AS avg_orders "
      "FROM customers GROUP BY customer_segment",
    "ship_mode_distribution": with_(RETAIL, sales_sql("retail"))
    + "SELECT shipment_mode, CAST(count(*) AS BIGINT) AS orders FROM sales GROUP BY shipment_mode",
    "cleanse_metrics": with_(SOURCE, TRIMMED, DATED, "grp AS (SELECT _row, _own, count(*) AS n FROM dated GROUP BY _row, _own)", DEDUP)
    + _metrics_long([("source_records", "SELECT sum(n) FROM grp"),
                     ("duplicates_removed", "SELECT sum(n - 1) FROM grp"),
                     ("invalid_row_ids", "SELECT count_if(_row IS NULL) FROM grp"),
                     ("invalid_order_dates", "SELECT count_if(_od IS NULL) FROM dedup"),
                     ("invalid_ship_dates", "SELECT count_if(_sd IS NULL) FROM dedup"),
                     ("null_order_dates_removed", "SELECT count_if(_od IS NULL) FROM dedup"),
                     ("invalid_ship_dates_before_order", "SELECT count_if(_od IS NOT NULL AND _sd < _od) FROM dedup"),
                     ("final_records", "SELECT count_if(_od IS NOT NULL) FROM dedup"),
                     ("records_removed", "SELECT (SELECT sum(n) FROM grp) - count_if(_od IS NOT NULL) FROM dedup")],
                    "(SELECT 1)"),
    "distinct_counts": with_(RETAIL, sales_sql("retail")) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM sales"
        for c in ("order_id", "order_date", "shipment_mode", "city")),
    "customer_base_distinct": with_(RETAIL) + "SELECT DISTINCT customer_id, customer_name, segment, country FROM retail",
    "row_dedup": with_(RETAIL, first_per_key_sql(
        "retail", ["row_id"], ["product_id", "ship_date", "sales"],
        ["row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name", "segment",
         "country", "city", "product_id", "sales", "quantity"], "deduped")) + "SELECT * FROM deduped",
    "customer_orders": with_(RETAIL)
    + "SELECT customer_id, order_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date "
      "FROM retail GROUP BY customer_id, order_id",
    "duplicate_counts": with_(RETAIL, "grp AS (SELECT row_id, count(*) AS n FROM retail GROUP BY row_id)")
    + _metrics_long([("records", "SELECT sum(n) FROM grp"), ("distinct_keys", "SELECT count(*) FROM grp"),
                     ("duplicates", "SELECT sum(n) - count(*) FROM grp")], "(SELECT 1)"),
    "orders_deduplicated": with_(SILVER, "grp AS (SELECT order_id, count(*) AS n FROM silver GROUP BY order_id)")
    + _metrics_long([("records", "SELECT sum(n) FROM grp"), ("distinct_keys", "SELECT count(*) FROM grp"),
                     ("duplicates", "SELECT sum(n) - count(*) FROM grp")], "(SELECT 1)"),
    "parse_dates_strict": with_(SOURCE) + f"SELECT * FROM (SELECT \"Row ID\" AS row_id, {parse(strip(q('Order Date')))} AS order_date "
    "FROM source) WHERE order_date IS NOT NULL",
    "top_customers": with_(RETAIL, _cust())
    + "SELECT customer_id, customer_first_name, customer_last_name, orders_last_month, orders_last_6_months, "
      "orders_total FROM customers ORDER BY orders_total DESC, customer_id ASC LIMIT 10",
    # scalar functions
    "parse_dates": with_(SOURCE)
    + f"SELECT \"Row ID\" AS row_id, \"Order Date\" AS order_date_text, {parse(strip(q('Order Date')))} AS order_date, "
      f"{parse(strip(q('Ship Date')))} AS ship_date FROM source",
    "parse_dates_fallback": with_(SOURCE)
    + "SELECT \"Row ID\" AS row_id, CASE WHEN regexp_full_match(t, '[0-9]{2}/[0-9]{2}/[0-9]{4}') THEN "
      "CAST(coalesce(try_strptime(t, '%d/%m/%Y'), try_strptime(t, '%m/%d/%Y')) AS DATE) END AS order_date "
      f"FROM (SELECT *, {strip(q('Order Date'))} AS t FROM source)",
    "trim_strings": with_(SOURCE, TRIMMED) + f"SELECT {_SOURCE_SEL} FROM trimmed",
    "parse_names": _names("first_space"),
    "parse_names_last_token": _names("last_token"),
    # composites
    "customer_metrics": with_(RETAIL, _cust()) + f"SELECT {CUSTOMER_COLUMNS} FROM customers",
    "stage_metrics": with_(SILVER, "src_n AS (SELECT count(*) AS n FROM source)",
                           "sil AS (SELECT count(*) AS n, count(DISTINCT order_id) AS o, "
                           "count(DISTINCT customer_id) AS c FROM silver)")
    + "SELECT stage, records_in, records_out, CAST(0 AS BIGINT) AS malformed_rows, "
      "round(CAST(records_out AS DOUBLE) * 100 / records_in, 4) AS success_rate FROM ("
      "SELECT 'bronze' AS stage, CAST(n AS BIGINT) AS records_in, CAST(n AS BIGINT) AS records_out FROM src_n "
      "UNION ALL SELECT 'silver', CAST((SELECT n FROM src_n) AS BIGINT), CAST(n AS BIGINT) FROM sil "
      "UNION ALL SELECT 'gold_sales', CAST(n AS BIGINT), CAST(o AS BIGINT) FROM sil "
      "UNION ALL SELECT 'gold_customer', CAST(n AS BIGINT), CAST(c AS BIGINT) FROM sil)",
}
ORACLES["stage_metrics_parallel"] = ORACLES["stage_metrics"]
