"""Report jobs that load a covered period into a catalog table, delivered more than once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions import periods
from marketflow.plans import reports
from marketflow.plans.registry import query, table
from marketflow.plans.rendered import csv_line, headed_files
from marketflow.session import scratch_path

# Day on which the reports are asked for.
TODAY = "1998-06-15"


def covered(report: reports.Report, day: str) -> Column:
    """Does a day lie in the spans that the report covers on ``TODAY``?"""
    spans = reports.COVERED[report.period](periods.ref(TODAY))
    return F.exists(spans, lambda s: F.to_date(day).between(s["start_date"], s["end_date"]))


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _shipped(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def _delivered(spark: SparkSession, name: str, deliveries: Sequence[DataFrame], head: Sequence[str], **stamps) -> DataFrame:
    """The table of a report after its deliveries were loaded one after another; lines are all columns, days as ISO text."""
    report = reports.family(name)
    target = f"mf_{uuid.uuid4().hex}"
    for rows in deliveries:
        cells = [_iso(c) if k == "timestamp_ntz" else F.col(c) for c, k in rows.dtypes]
        path = headed_files(rows, csv_line(*cells), head, name)
        reports.load_into(spark, report, path, target, TODAY, encoding="utf-8", **stamps)
    return spark.read.table(target)


_SHIPPED = ["Shipped,Order,Line,Quantity,Flag"]
_SHIPPED_SQL = """SELECT {distinct} {stamp}l_shipdate AS shipped, l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line,
CAST(l_quantity AS DOUBLE) AS quantity, l_returnflag AS flag FROM lineitem WHERE {where}"""


def _shipped_sql(where: str, stamp: str = "") -> str:
    return _SHIPPED_SQL.format(distinct="DISTINCT", stamp=stamp, where=where)


@query(_shipped_sql("l_returnflag <> 'N'"))
def report_returns(spark, sf):
    """Customer returns, of which a second delivery repeats all but adds those of another kind."""
    shipped = _shipped(spark, sf)
    first, second = shipped.where("l_returnflag = 'R'"), shipped.where("l_returnflag <> 'N'")
    return _delivered(spark, "fba_customer_returns", [first, second], _SHIPPED)


@query(_shipped_sql("l_shipdate >= DATE '1998-06-01' AND l_shipdate < DATE '1998-07-01'"))
def report_fulfilled_shipments(spark, sf):
    """Shipments of the months that are loaded again; the same months, delivered twice, are there once."""
    report = reports.family("fulfilled_shipments")
    rows = _shipped(spark, sf).where(covered(report, "l_shipdate"))
    return _delivered(spark, report.name, [rows, rows], _SHIPPED)


@query(_shipped_sql("l_shipdate >= DATE '1998-05-01' AND l_shipdate < DATE '1998-06-01'"))
def report_reimbursements(spark, sf):
    """The previous month, in two deliveries that overlap."""
    report = reports.family("reimbursements")
    rows = _shipped(spark, sf).where(covered(report, "l_shipdate"))
    return _delivered(spark, report.name, [rows.where("day(l_shipdate) <= 20"), rows.where("day(l_shipdate) >= 10")], _SHIPPED)


@query(_shipped_sql("l_shipdate >= DATE '1998-05-01' AND l_shipdate < DATE '1998-06-01'", "TIMESTAMP '1998-06-15 00:00:00' AS date, "))
def report_storage_fees(spark, sf):
    """The previous month, stamped with the day it was loaded."""
    report = reports.family("storage_fees")
    return _delivered(spark, report.name, [_shipped(spark, sf).where(covered(report, "l_shipdate"))] * 2, _SHIPPED)


@query("""
SELECT o_orderkey AS order_id, o_orderdate AS purchased, o_totalprice AS total, o_orderpriority AS priority FROM orders
WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-06-01'
""")
def report_order_detail(spark, sf):
    """All orders of the year up to the previous month, delivered in two halves."""
    report = reports.family("order_detail")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority").where(covered(report, "o_orderdate"))
    halves = [orders.where(F.pmod("o_orderkey", F.lit(2)) == k) for k in (0, 1)]
    return _delivered(spark, report.name, halves, ["Order ID,Purchased,Total,Priority"])


@query("""
SELECT '1998-06-07/1998-06-13' AS period, 'B' || CAST(p_partkey AS VARCHAR) AS asin, CAST(p_size AS BIGINT) AS sessions, p_retailprice AS sales FROM part
UNION ALL
SELECT '1998-05-31/1998-06-06', 'B' || CAST(p_partkey AS VARCHAR), CAST(p_size AS BIGINT), p_retailprice FROM part
""")
def report_sales_weekly(spark, sf):
    """Two weeks of sales, each stamped with its period; one is loaded again."""
    rows = table(spark, sf, "part").select(F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("asin"), "p_size", "p_retailprice")
    path = headed_files(rows, csv_line(*rows.columns), ["ASIN,Sessions,Sales"], "weekly")
    report, target = reports.family("sales_traffic_weekly"), f"mf_{uuid.uuid4().hex}"
    for period in ("1998-06-07/1998-06-13", "1998-05-31/1998-06-06", "1998-06-07/1998-06-13"):
        reports.load_into(spark, report, path, target, TODAY, encoding="utf-8", period=period)
    return spark.read.table(target)


@query(_shipped_sql("l_shipdate >= DATE '1998-06-01' AND l_shipdate < DATE '1998-06-15'", "TIMESTAMP '1998-06-15 00:00:00' AS date, "))
def report_awd_inbound(spark, sf):
    """Inbound shipments of the month up to the day before, stamped with the day."""
    report = reports.family("shipment_awd_inbound")
    return _delivered(spark, report.name, [_shipped(spark, sf).where(covered(report, "l_shipdate"))], _SHIPPED)


@query(_shipped_sql("l_shipdate >= DATE '1998-05-01' AND l_shipdate < DATE '1998-06-01'", "TIMESTAMP '1998-06-15 00:00:00' AS date, "))
def report_awd_storage(spark, sf):
    """Storage sheets of the previous month, stamped with the day, in two parts."""
    report = reports.family("storage")
    rows = _shipped(spark, sf).where(covered(report, "l_shipdate"))
    return _delivered(spark, report.name, [rows.where("l_linenumber > 3"), rows.where("l_linenumber < 6")], _SHIPPED)


@query(_shipped_sql("l_shipdate >= DATE '1998-05-01' AND l_shipdate < DATE '1998-06-01'", "TIMESTAMP '1998-06-15 00:00:00' AS date, "))
def report_shipments(spark, sf):
    """Pages of shipments of the previous month as one batch, one folder per flag."""
    report = reports.family("shipments")
    rows = _shipped(spark, sf).where(covered(report, "l_shipdate"))
    folder = scratch_path(spark, "shipment-pages")
    for flag in ("A", "N", "R"):
        cells = [_iso("l_shipdate"), *[F.col(c) for c in rows.columns[1:]]]
        page = rows.where(F.col("l_returnflag") == flag).select(F.struct(*cells).alias("row")).select("row.*")
        page.toDF("Shipped", "Order", "Line", "Quantity", "Flag").write.option("header", True).csv(f"{folder}/page={flag}")
    target = f"mf_{uuid.uuid4().hex}"
    reports.load_into(spark, report, f"{folder}/page=*", target, TODAY, encoding="utf-8")
    return spark.read.table(target)


@query("SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders")
def empty_batch(spark, sf):
    """A delivery with a header and no rows leaves the table as it was."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    head = ["Order ID,Total"]
    target = f"mf_{uuid.uuid4().hex}"
    report = reports.family("promotions")
    full = headed_files(orders, csv_line(*orders.columns), head, "full")
    reports.load_into(spark, report, full, target, TODAY, encoding="utf-8")
    # Files of which only the header is left.
    bare = headed_files(orders, F.lit("").alias("line"), head, "bare")
    outcome = reports.load_into(spark, report, bare, target, TODAY, encoding="utf-8")
    return outcome.state.where(F.lit(not outcome.loaded))
