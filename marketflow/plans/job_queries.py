"""Report jobs and table loads end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import names, periods
from marketflow.operators import filters, load, nested, projections
from marketflow.plans import reports
from marketflow.plans.load_queries import (
    _DATED, _INSERT_BATCH, _INSERT_TARGET, _KEYED, _filled, _same, _unknown_priority, ORDER_COLUMNS, restated_orders,
)
from marketflow.plans.lookup_queries import search_records, search_schema, search_sql
from marketflow.plans.registry import query, table
from marketflow.plans.rendered import csv_line, framed_files, headed_files
from marketflow.plans.source_queries import PREAMBLE
from marketflow.session import scratch_path
from marketflow.sinks import tables as sinks
from marketflow.sources import delimited, documents


def _price(column: str):
    return F.concat(F.lit("$"), F.format_number(column, 2))


def _transactions(orders: DataFrame, raise_by: int) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("date_time"),
        (F.col("o_totalprice") + raise_by).alias("total"), F.col("o_custkey").cast("string").alias("order_postal"),
    )


@query("""
WITH t AS (SELECT o_orderkey AS order_id, o_orderdate AS date_time, o_totalprice AS total, CAST(o_custkey AS VARCHAR) AS order_postal FROM orders)
SELECT order_id, date_time, order_postal,
       CASE WHEN date_time >= DATE '1998-01-01' AND date_time < DATE '1999-01-01' THEN total + 1 ELSE total END AS total
FROM t
""")
def report_transaction(spark, sf):
    """A year of transactions, delivered again as files, replaces its months."""
    orders = table(spark, sf, "orders")
    year = _transactions(orders, 1).where(F.year("date_time") == 1998)
    spelled = F.concat(F.date_format("date_time", "MMM d, yyyy h:mm:ss a"), F.lit(" PST"))
    line = csv_line(
        F.col("order_id"), spelled.alias("d"), _price("total").alias("t"),
        F.concat("order_postal", F.lit(".0")).alias("p"), F.lit("x").alias("x"),
    )
    path = headed_files(year, line, [*PREAMBLE, "Order ID,Date / Time,Total,Order Postal,Extra"], "transaction")
    report = reports.family("transaction")
    return reports.load_report(spark, report, path, _transactions(orders, 0), "1999-01-02").state


@query("""
SELECT CAST(o_orderkey AS BIGINT) AS keyword_id, CAST(o_orderdate AS DATE) AS date, o_orderstatus = 'F' AS amazon_choice_badge,
       o_orderpriority AS search_term
FROM orders
""")
def report_rank_tracker(spark, sf):
    """First load of rank files; a second, identical delivery adds nothing."""
    orders = table(spark, sf, "orders")
    badge = F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No")
    line = csv_line(F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), badge.alias("b"), F.col("o_orderpriority"))
    path = headed_files(orders, line, ["Keyword ID,Date,Amazon Choice Badge,Search Term"], "rank")
    report = reports.family("rank_tracker")
    first = reports.load_report(spark, report, path, None, "1998-06-15", encoding="utf-8")
    return reports.load_report(spark, report, path, first.state, "1998-06-16", encoding="utf-8", contract=first.contract).state


@query("""
WITH t AS (SELECT o_custkey AS campaign_id, o_orderdate AS start_date, o_orderdate AS end_date, o_totalprice AS cost FROM orders),
b AS (SELECT DISTINCT campaign_id, start_date, end_date, cost + 2 AS cost FROM t WHERE start_date >= DATE '1998-06-08' AND start_date < DATE '1998-06-15')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.campaign_id = t.campaign_id AND b.start_date = t.start_date AND b.end_date = t.end_date)
UNION ALL SELECT * FROM b
""")
def report_campaign(spark, sf):
    """The last seven days of ad campaigns, fetched again as gzipped JSON."""
    orders = table(spark, sf, "orders")
    target = orders.select(
        F.col("o_custkey").alias("campaign_id"), F.col("o_orderdate").alias("start_date"),
        F.col("o_orderdate").alias("end_date"), F.col("o_totalprice").alias("cost"),
    )
    days = periods.refetch_days(periods.ref("1998-06-15"))
    restated = target.where(F.array_contains(days, F.to_date("start_date"))).select(
        F.col("campaign_id").alias("campaignId"), F.date_format("start_date", "yyyy-MM-dd").alias("startDate"),
        F.date_format("end_date", "yyyy-MM-dd").alias("endDate"), (F.col("cost") + 2).alias("cost"),
    )
    path = framed_files(restated, F.to_json(F.struct("*")), "[", "]", ",", "campaign", compression="gzip")
    schema = T.StructType.fromDDL("campaignId bigint, startDate string, endDate string, cost double")
    raw = documents.array_records(spark, path, schema)
    return reports.load_batch(reports.family("sponsored_products_campaign"), raw, target, "1998-06-15").state


@query(search_sql().replace("SELECT ", "SELECT DISTINCT ", 1))
def report_search_performance(spark, sf):
    """Search-performance documents to their table; loading them twice changes nothing."""
    record = F.to_json(F.struct("*"))
    path = framed_files(search_records(table(spark, sf, "lineitem")), record, '{"dataByAsin": [', "]}", ",", "search", compression="gzip")
    records = documents.named_records(documents.read_documents(spark, path), documents.SEARCH_RECORDS, search_schema())
    batch = nested.search_performance(records, F.col("asin"), periods.last_saturday(periods.ref("1998-06-15")))
    report = reports.family("search_performance")
    contract = projections.contract_of(batch)
    contract = tuple(projections.Field(f.name, "date") if f.name == "reporting_date" else f for f in contract)
    first = reports.load_batch(report, batch, batch.limit(0), "1998-06-15", contract)
    return reports.load_batch(report, batch, first.state, "1998-06-15", contract).state


@query("""
SELECT TIMESTAMP '1998-06-15 00:00:00' AS date, c_name AS sku, c_custkey AS units, c_acctbal + 1 AS value FROM customer
UNION ALL
SELECT TIMESTAMP '1998-06-14 00:00:00', c_name, c_custkey, c_acctbal FROM customer
""")
def report_inventory(spark, sf):
    """Daily inventory: yesterday's rows stay, today's earlier load is replaced."""
    customers = table(spark, sf, "customer")
    report = reports.family("manage_fba_inventory")

    def files(raise_by: int) -> DataFrame:
        value = F.concat(F.col("c_acctbal").cast("decimal(18,2)") + raise_by).cast("string")
        path = headed_files(customers, csv_line("c_name", "c_custkey", value.alias("v")), ["SKU,Units,Value"], "inventory")
        return delimited.read_delimited(spark, path, encoding="utf-8")

    first = reports.load_batch(report, files(0), None, "1998-06-14")
    second = reports.load_batch(report, files(0), first.state, "1998-06-15", first.contract)
    return reports.load_batch(report, files(1), second.state, "1998-06-15", second.contract).state


@query("""
WITH raw AS (SELECT l_returnflag AS brand, l_linestatus AS share_percent, l_shipdate AS reporting_date FROM lineitem)
SELECT DISTINCT * FROM raw
""")
def report_brand_share(spark, sf):
    """Share files appended and deduplicated, as the cloud warehouse loads them."""
    line = csv_line("l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"))
    path = headed_files(table(spark, sf, "lineitem"), line, ['Brand=["X"],Week=[3]', "Brand,Share %,Reporting Date"], "share")
    report = reports.family("brand_share")
    first = reports.load_report(spark, report, path, None, "1998-06-15", encoding="utf-8")
    return reports.load_report(spark, report, path, first.state, "1998-06-15", encoding="utf-8", contract=first.contract).state


@query("""
SELECT DISTINCT page_id, url, has_current FROM (
  SELECT o_orderkey // 25 AS page_id, strftime(o_orderdate, '%b') AS url, contains(strftime(o_orderdate, '%b'), 'Jun') AS has_current FROM orders)
""")
def report_support(spark, sf):
    """Pages of a paged report, loaded as one batch without repeats."""
    lines = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 25).cast("long").alias("page_id"), F.date_format("o_orderdate", "MMM").alias("url")
    )
    flagged = lines.withColumn("has_current", F.contains("url", F.lit("Jun")))
    return reports.load_batch(reports.family("support"), flagged, flagged.limit(0), "1998-06-15").state


def _table(spark, df: DataFrame, label: str, partition_by=()) -> str:
    name = f"mf_{label}_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, projections.contract_of(df), partition_by, scratch_path(spark, label))
    sinks.append_rows(df, name)
    return name


@query(f"""
WITH t AS ({_INSERT_TARGET}), b AS (SELECT DISTINCT * FROM ({_INSERT_BATCH}))
SELECT * FROM t UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_same(ORDER_COLUMNS, ["o_orderdate"])})
""")
def table_insert_new(spark, sf):
    """Insert-if-new into a catalog table, twice."""
    target = _unknown_priority(table(spark, sf, "orders"))
    name = _table(spark, target, "insert")
    for _ in range(2):
        sinks.insert_new(_filled(target), name)
    return spark.read.table(name)


@query(_KEYED)
def table_replace_keys(spark, sf):
    """Keyed replace of a catalog table by writing a new state and swapping it in."""
    name = _table(spark, table(spark, sf, "orders"), "replace")
    sinks.replace_keys(restated_orders(spark, sf), name, ["o_orderdate", "o_custkey"])
    return spark.read.table(name)


@query(f"""
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
b AS (SELECT * FROM o WHERE o_orderstatus = 'P' AND o_orderdate >= DATE '2000-01-01')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, month FROM o
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.month = o.month AND b.o_custkey = o.o_custkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority, month FROM b
""")
def table_replace_partitions(spark, sf):
    """Keyed replace on a table partitioned by month: only touched months are written."""
    orders = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    name = _table(spark, orders, "months", ["month"])
    batch = orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
    batch = batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    sinks.replace_keys_in_partitions(batch, name, ["month", "o_custkey"], "month")
    return spark.read.table(name)


@query("""
SELECT MIN(strftime(o_orderdate, '%Y-%m-%d')) AS date, o_custkey, o_orderstatus FROM orders GROUP BY o_custkey, o_orderstatus
""")
def table_dedup(spark, sf):
    """Append, then rewrite a catalog table without repeated content; copied at the end."""
    loads = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_custkey", "o_orderstatus")
    name = _table(spark, loads, "dedup")
    sinks.dedup_table(spark, name)
    return spark.read.table(name)


@query("""
WITH lines AS (SELECT o_orderkey, o_orderkey // 25 AS page, strftime(o_orderdate, '%b') || ' ' || day(o_orderdate) AS line FROM orders),
pages AS (SELECT page, bool_or(contains(line, 'Jun')) AS cur, bool_or(NOT contains(line, 'Jun') AND contains(line, 'May')) AS prev FROM lines GROUP BY page)
SELECT o_orderkey AS case_id, line AS opened FROM lines JOIN pages USING (page)
WHERE prev AND page < COALESCE((SELECT MIN(page) FROM pages WHERE NOT cur AND NOT prev), 1e18)
""")
def report_support_pages(spark, sf):
    """Paged cases: pages with rows of the previous month are kept and loaded as one batch."""
    lines = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Case ID"), F.floor(F.col("o_orderkey") / 25).cast("long").alias("page"),
        F.concat_ws(" ", F.date_format("o_orderdate", "MMM"), F.dayofmonth("o_orderdate")).alias("Opened"),
    )
    pages = filters.month_pages(lines, "page", "Opened", "Jun", "May").where("kept").select("page")
    kept = lines.join(pages, "page", "left_semi").drop("page")
    contract = projections.contract(case_id="long", opened="string")
    target = kept.limit(0).select(F.col("Case ID").alias("case_id"), F.col("Opened").alias("opened"))
    return reports.load_batch(reports.family("support"), kept, target, "1998-06-15", contract).state


@query("""
SELECT '06/08/1998-06/15/1998' AS period, c_name AS sku, CAST(c_acctbal AS VARCHAR) AS price, CAST(c_custkey AS VARCHAR) AS rank
FROM customer
""")
def report_competitors(spark, sf):
    """An exported sheet with a repeated column, stamped with the trailing week."""
    customers = table(spark, sf, "customer")
    line = csv_line(F.col("c_name"), F.col("c_acctbal"), F.lit("again").alias("x"), F.col("c_custkey"))
    path = headed_files(customers, line, ["SKU,Price,SKU,Rank"], "competitors")
    week = periods.period_text(periods.trailing_week(periods.ref("1998-06-15")))
    period = spark.range(1).select(week.alias("period")).first()["period"]
    report = reports.family("competitors")
    contract = projections.contract(period="string", sku="string", price="string", rank="string")
    raw = reports.scan_report(spark, report, path)
    target = spark.createDataFrame([], "period string, sku string, price string, rank string")
    return reports.load_batch(report, raw, target, "1998-06-15", contract, period=period).state


@query("""
SELECT DATE '1998-06-15' AS loaded, s_name AS sku, s_suppkey AS units, s_acctbal AS value FROM supplier
""")
def report_awd_inventory(spark, sf):
    """Inventory files with three lines before the header, stamped with the load date."""
    line = csv_line(F.col("s_name"), F.col("s_suppkey"), _price("s_acctbal").alias("v"))
    path = headed_files(table(spark, sf, "supplier"), line, ["Inventory", "As of today", "", "SKU,Units,Value ($)"], "awd")
    first = reports.load_report(spark, reports.family("inventory"), path, None, "1998-06-15").state
    typed = projections.conform(first, projections.contract(date="timestamp", sku="string", units="long", value="double"))
    return typed.select(F.to_date("date").alias("loaded"), "sku", "units", "value")


@query("""
WITH day1 AS (SELECT TIMESTAMP '1998-06-14 00:00:00' AS date, 'B' || CAST(p_partkey AS VARCHAR) AS asin, CAST(p_size AS BIGINT) AS sessions_total,
  CAST(p_size AS DOUBLE) AS unit_session_pct, p_retailprice AS ordered_product_sales FROM part)
SELECT * FROM day1 UNION ALL SELECT TIMESTAMP '1998-06-12 00:00:00', asin, sessions_total, unit_session_pct, ordered_product_sales FROM day1
""")
def report_sales_traffic(spark, sf):
    """Daily sales and traffic for yesterday and three days ago, each stamped with its day."""
    asin = F.concat(F.lit("B"), F.col("p_partkey").cast("string"))
    share = F.concat(F.col("p_size").cast("string"), F.lit("%"))
    line = csv_line(asin.alias("a"), F.col("p_size"), share.alias("s"), _price("p_retailprice").alias("p"))
    head = ["(Child) ASIN,Sessions - Total,Unit Session Percentage,Ordered Product Sales"]
    path = headed_files(table(spark, sf, "part"), line, head, "traffic")
    report = reports.family("sales_traffic_daily")
    contract = projections.contract(date="timestamp", child_asin="string", sessions_total="long", unit_session_pct="double", ordered_product_sales="double")
    state = spark.createDataFrame([], "date timestamp_ntz, child_asin string, sessions_total bigint, unit_session_pct double, ordered_product_sales double")
    for day in ("1998-06-14", "1998-06-12"):
        state = reports.load_report(spark, report, path, state, "1998-06-15", contract=contract, custom_date=day).state
    return state.withColumnRenamed("child_asin", "asin")


@query("""
WITH t AS (SELECT o_orderdate AS snapshot_date, 'S' || CAST(o_custkey AS VARCHAR) AS sku, o_totalprice AS value FROM orders),
b AS (SELECT DISTINCT snapshot_date, sku, value + 1 AS value FROM t WHERE snapshot_date >= DATE '2001-01-01')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.snapshot_date = t.snapshot_date AND b.sku = t.sku)
UNION ALL SELECT * FROM b
""")
def report_fba_inventory(spark, sf):
    """Inventory snapshots of the year 2001, delivered again: keyed by day and sku."""
    target = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("snapshot_date"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sku"),
        F.col("o_totalprice").alias("value"),
    )
    again = target.where(F.col("snapshot_date") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    line = csv_line(F.date_format("snapshot_date", "yyyy-MM-dd'T'HH:mm:ss").alias("d"), F.col("sku"), (F.col("value") + 1).alias("v"))
    path = headed_files(again, line, ["snapshot-date,sku,value"], "snapshots")
    return reports.load_report(spark, reports.family("fba_inventory"), path, target, "2001-09-01").state


@query("""
SELECT CAST('S-7' AS VARCHAR) AS sku, p_name AS search_query, CAST(p_size AS BIGINT) AS clicks, p_retailprice AS price_usd FROM part
GROUP BY ALL
""")
def report_asin(spark, sf):
    """Files with a metadata line, stamped with the sku they were asked for."""
    line = csv_line(F.col("p_name"), F.col("p_size"), F.col("p_retailprice"))
    path = headed_files(table(spark, sf, "part"), line, ['ASIN=["B1"],Week=[2]', "Search Query,Clicks,Price (USD)"], "asin")
    return reports.load_report(spark, reports.family("asin"), path, None, "1998-06-15", sku="S-7").state


TRAFFIC_SCHEMA = """
date string, salesByDate struct<orderedProductSales struct<amount double, currencyCode string>, unitsOrdered bigint>,
trafficByDate struct<sessions bigint, deep struct<buyBoxPercentage double>>
"""


@query("""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_totalprice AS ordered_product_sales, o_custkey AS units_ordered,
  o_orderkey AS sessions, CAST(50.5 AS DOUBLE) AS buy_box_pct FROM orders
""")
def report_seller_traffic(spark, sf):
    """Traffic documents with nested records: flattened, camel-case names cleaned, loaded."""
    orders = table(spark, sf, "orders")
    money = F.struct(F.col("o_totalprice").alias("amount"), F.lit("USD").alias("currencyCode"))
    deep = F.struct(F.lit(50.5).cast("double").alias("buyBoxPercentage"))
    record = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.struct(money.alias("orderedProductSales"), F.col("o_custkey").alias("unitsOrdered")).alias("salesByDate"),
        F.struct(F.col("o_orderkey").alias("sessions"), deep.alias("deep")).alias("trafficByDate"),
    )
    path = framed_files(orders, F.to_json(record), '{"salesAndTrafficByDate": [', "]}", ",", "traffic")
    schema = T.StructType.fromDDL(TRAFFIC_SCHEMA)
    rows = documents.named_records(documents.read_documents(spark, path), documents.TRAFFIC_RECORDS, schema)
    flat = nested.flatten_columns(rows, ["salesByDate", "trafficByDate"])
    contract = (
        projections.Field("date", "date"), projections.Field("ordered_product_sales", "double"),
        projections.Field("units_ordered", "long"), projections.Field("sessions", "long"), projections.Field("buy_box_pct", "double"),
    )
    target = spark.createDataFrame([], "date date, ordered_product_sales double, units_ordered bigint, sessions bigint, buy_box_pct double")
    return reports.load_batch(reports.family("seller_api"), flat, target, "1998-06-16", contract).state


@query("""
SELECT 'B' || CAST(p_partkey AS VARCHAR) AS asin, CAST(p_size AS BIGINT) AS orders, p_retailprice AS repeat_purchase_revenue, 'USD' AS currency_code FROM part
""")
def report_repeat_purchase(spark, sf):
    """Repeat-purchase records: a money cell yields its members, the amount is renamed."""
    money = F.struct(F.col("p_retailprice").alias("amount"), F.lit("USD").alias("currencyCode"))
    record = F.struct(
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("asin"), F.col("p_size").alias("orders"),
        money.alias("repeatPurchaseRevenue"),
    )
    path = framed_files(table(spark, sf, "part"), F.to_json(record), '{"dataByAsin": [', "]}", ",", "repeat")
    schema = T.StructType.fromDDL("asin string, orders bigint, repeatPurchaseRevenue struct<amount double, currencyCode string>")
    rows = documents.named_records(documents.read_documents(spark, path), documents.SEARCH_RECORDS, schema)
    renamed = names.rename_repeat_purchase(nested.flatten_columns(rows, ["repeatPurchaseRevenue"]))
    return names.clean_names(renamed, camel=True)


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, l_shipdate FROM lineitem")
def table_copy(spark, sf):
    """A created, truncate-loaded and copied table; the original is dropped."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    name = _table(spark, lines, "copied")
    sinks.replace_table(lines, name)
    copy = f"{name}_copy"
    sinks.copy_table(spark, name, copy, scratch_path(spark, "copy"))
    sinks.drop_table(spark, name)
    return spark.read.table(copy)


@query("""
WITH t AS (SELECT o_orderkey AS order_id, o_orderdate AS date_time, o_totalprice AS total, CAST(o_custkey AS VARCHAR) AS order_postal FROM orders)
SELECT order_id, date_time, order_postal, strftime(date_time, '%Y-%m') AS month,
       CASE WHEN date_time >= DATE '1998-01-01' AND date_time < DATE '1998-03-01' THEN total + 1 ELSE total END AS total
FROM t
""")
def table_transaction(spark, sf):
    """Two months of transactions, delivered again as files, replace their partitions of a catalog table."""
    orders = table(spark, sf, "orders")
    months = F.col("date_time").between(F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-02-28 23:59:59").cast("timestamp_ntz"))
    spelled = F.concat(F.date_format("date_time", "MMM d, yyyy h:mm:ss a"), F.lit(" PST"))
    line = csv_line(F.col("order_id"), spelled.alias("d"), _price("total").alias("t"), F.concat("order_postal", F.lit(".0")).alias("p"))
    head = [*PREAMBLE, "Order ID,Date / Time,Total,Order Postal"]
    report = reports.family("transaction")
    name = f"mf_{uuid.uuid4().hex}"
    contract = projections.contract_of(_transactions(orders, 0))
    contract = tuple(projections.Field(f.name, f.kind, coercion="postal") if f.name == "order_postal" else f for f in contract)
    first = headed_files(_transactions(orders, 0), line, head, "transaction")
    again = headed_files(_transactions(orders, 1).where(months), line, head, "transaction")
    for path in (first, again):
        reports.load_into(spark, report, path, name, "1999-01-02", "month", encoding="utf-8", contract=contract)
    return spark.read.table(name)


@query("""
SELECT DISTINCT l_returnflag AS brand, l_linestatus AS share_percent, l_shipdate AS reporting_date FROM lineitem
""")
def table_brand_share(spark, sf):
    """Share files loaded twice into a catalog table: the second load appends nothing."""
    line = csv_line("l_returnflag", "l_linestatus", F.date_format("l_shipdate", "M/d/yyyy").alias("d"))
    path = headed_files(table(spark, sf, "lineitem"), line, ['Brand=["X"],Week=[3]', "Brand,Share %,Reporting Date"], "share")
    name = f"mf_{uuid.uuid4().hex}"
    for _ in range(2):
        reports.load_into(spark, reports.family("brand_share"), path, name, "1998-06-15", encoding="utf-8")
    return spark.read.table(name)


@query("""
SELECT o_custkey AS campaign_id, o_orderdate AS start_date, o_orderdate AS end_date, o_totalprice AS cost FROM orders
""")
def table_campaign(spark, sf):
    """Gzipped JSON arrays of ad campaigns through the report's own scan, loaded twice into a catalog table."""
    orders = table(spark, sf, "orders")
    rows = orders.select(
        F.col("o_custkey").alias("campaignId"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("startDate"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("endDate"), F.col("o_totalprice").alias("cost"),
    )
    path = framed_files(rows, F.to_json(F.struct("*")), "[", "]", ",", "campaign", compression="gzip")
    name = f"mf_{uuid.uuid4().hex}"
    for _ in range(2):
        reports.load_into(spark, reports.family("sponsored_products_campaign"), path, name, "1998-06-15")
    return spark.read.table(name)


@query("""
SELECT MIN(strftime(o_orderdate, '%Y-%m-01')) AS date, o_custkey, o_orderstatus FROM orders GROUP BY o_custkey, o_orderstatus
""")
def table_dedup_partitioned(spark, sf):
    """The same on a table partitioned by load month, which is also loaded again in between."""
    day = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-01")).alias("date")
    loads = table(spark, sf, "orders").select(day, "o_custkey", "o_orderstatus")
    name = _table(spark, loads, "dedup", ["date"])
    sinks.replace_table(loads.where("date < '1996-01-01'"), name)
    sinks.append_rows(loads, name)
    sinks.dedup_table(spark, name)
    return spark.read.table(name)
