"""Load disciplines and deduplication over the sales tables.

Restated batches are whole tables with changed values: a re-sent report repeats
everything, and the discipline has to find what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.operators import dedup, load
from marketflow.plans.registry import query, table

REF_DATE = "1998-06-15"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _unknown_priority(orders: DataFrame) -> DataFrame:
    return orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))


def _filled(orders: DataFrame) -> DataFrame:
    """Open orders have been filled in the restated report."""
    return orders.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus")))


@query("""
SELECT o_orderkey AS order_id, o_orderdate AS day, o_totalprice AS amount FROM orders
UNION ALL
SELECT l_orderkey, l_shipdate, l_extendedprice FROM lineitem
""")
def append_union(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("amount")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("day"), F.col("l_extendedprice").alias("amount")
    )
    return load.union_batches(orders, lines)


@query("""
SELECT l_orderkey AS o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, l_linestatus AS o_orderstatus,
       l_extendedprice AS o_totalprice, l_shipdate AS o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM lineitem
""")
def truncate_load(spark, sf):
    batch = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), F.col("l_shipdate").alias("o_orderdate"), "l_tax",
    )
    return load.truncate_load(table(spark, sf, "orders"), batch)


_INSERT_TARGET = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
FROM orders
"""
_INSERT_BATCH = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
FROM orders
"""


def _same(columns: list[str], temporal: list[str]) -> str:
    def side(alias: str, c: str) -> str:
        return f"CAST({alias}.{c} AS DATE)" if c in temporal else f"{alias}.{c}"

    return " AND ".join(f"{side('t', c)} IS NOT DISTINCT FROM {side('b', c)}" for c in columns)


@query(f"""
WITH t AS ({_INSERT_TARGET}), b AS (SELECT DISTINCT * FROM ({_INSERT_BATCH} UNION ALL {_INSERT_BATCH}))
SELECT * FROM t
UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_same(ORDER_COLUMNS, ["o_orderdate"])})
""")
def insert_if_new(spark, sf):
    target = _unknown_priority(table(spark, sf, "orders"))
    restated = _filled(target)
    return load.insert_if_new(target, load.union_batches(restated, restated))


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_SHIFTED = "SELECT event_id, ts + INTERVAL 6 HOUR AS ts, user_id, event_type, value, props FROM events"


def _shifted(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts") + F.expr("interval 6 hours"))


@query(f"""
WITH t AS (SELECT * FROM events), b AS ({_SHIFTED})
SELECT * FROM t
UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_same(EVENT_COLUMNS, ["ts"])})
""")
def insert_if_new_day(spark, sf):
    events = table(spark, sf, "events")
    return load.insert_if_new(events, _shifted(events))


@query(f"""
WITH t AS (SELECT * FROM events), b AS ({_SHIFTED} UNION ALL SELECT * FROM events)
SELECT * FROM t
UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_same(EVENT_COLUMNS, [])})
""")
def insert_if_new_exact(spark, sf):
    events = table(spark, sf, "events")
    return load.insert_if_new(events, load.union_batches(_shifted(events), events), granularity="exact")


_RESTATED_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, total AS o_totalprice, o_orderdate, o_orderpriority
FROM orders JOIN (
  SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY l_orderkey
) ON l_orderkey = o_orderkey
"""


def restated_orders(spark, sf) -> DataFrame:
    """Orders that have lines, with the price their lines add up to."""
    lines = table(spark, sf, "lineitem")
    totals = lines.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"))
    orders = table(spark, sf, "orders").join(totals, F.col("o_orderkey") == F.col("l_orderkey"))
    return orders.withColumn("o_totalprice", F.col("total").cast("double")).select(*ORDER_COLUMNS)


_KEYED = f"""
WITH b AS ({_RESTATED_ORDERS})
SELECT * FROM orders t WHERE NOT EXISTS (
  SELECT 1 FROM b WHERE CAST(t.o_orderdate AS DATE) = CAST(b.o_orderdate AS DATE) AND t.o_custkey = b.o_custkey)
UNION ALL
SELECT * FROM b
"""


@query(_KEYED)
def keyed_replace(spark, sf):
    return load.keyed_replace(
        table(spark, sf, "orders"), restated_orders(spark, sf), ["o_orderdate", "o_custkey"]
    )


@query(f"""
SELECT strftime(o_orderdate, '%Y-%m') AS order_month, o_orderstatus, COUNT(*) AS orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM ({_KEYED}) GROUP BY 1, 2
""")
def restated_month_summary(spark, sf):
    """State of the table after a restated batch, by month and status."""
    state = keyed_replace(spark, sf)
    return state.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), "o_orderstatus").agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    )


_BUYER = "CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS buyer"


def _with_buyer(events: DataFrame) -> DataFrame:
    buyer = F.when(F.col("event_type") != "signup", F.col("user_id"))
    return events.select("event_id", "ts", buyer.alias("buyer"), "event_type", "value")


def _revalued(spark, sf) -> DataFrame:
    events = _with_buyer(table(spark, sf, "events"))
    return events.where(F.col("event_type").isin("purchase", "signup")).withColumn("value", F.col("value") + 1)


@query(f"""
WITH t AS (SELECT event_id, ts, {_BUYER}, event_type, value FROM events),
b AS (SELECT event_id, ts, buyer, event_type, value + 1 AS value FROM t WHERE event_type IN ('purchase', 'signup'))
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM b WHERE t.buyer = b.buyer AND CAST(t.ts AS DATE) = CAST(b.ts AS DATE))
UNION ALL
SELECT * FROM b
""")
def keyed_replace_null_key(spark, sf):
    return load.keyed_replace(_with_buyer(table(spark, sf, "events")), _revalued(spark, sf), ["buyer", "ts"])


@query("SELECT COUNT(*) AS null_key_rows FROM events WHERE event_type = 'signup'")
def null_key_rows(spark, sf):
    return load.null_key_rows(_revalued(spark, sf), ["buyer", "ts"])


_DATED = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority
FROM orders
"""


def _undated_urgent(orders: DataFrame) -> DataFrame:
    """Urgent orders carry no date."""
    return orders.withColumn("o_orderdate", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate")))


_YEAR = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'
"""


def _year_restated(orders: DataFrame) -> DataFrame:
    """The year 1998, delivered again with changed open orders."""
    year = orders.where((F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return _undated_urgent(year.withColumn("o_totalprice", price))


def _month_sql(kept: str) -> str:
    return f"""
WITH t AS ({_DATED}), b AS (SELECT DISTINCT * FROM ({_YEAR})), k AS (SELECT * FROM t WHERE {kept})
SELECT * FROM k
UNION ALL
SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM k AS t WHERE {_same(ORDER_COLUMNS, ["o_orderdate"])})
"""


@query(_month_sql("""o_orderdate IS NULL OR date_trunc('month', o_orderdate) NOT IN (
  SELECT date_trunc('month', o_orderdate) FROM b WHERE o_orderdate IS NOT NULL)"""))
def month_replace(spark, sf):
    orders = table(spark, sf, "orders")
    return load.month_replace(_undated_urgent(orders), _year_restated(orders), "o_orderdate")


@query(_month_sql("o_orderdate IS NULL OR o_orderdate < DATE '1998-06-01' OR o_orderdate >= DATE '1998-07-01'"))
def calendar_month_replace(spark, sf):
    orders = table(spark, sf, "orders")
    return load.calendar_month_replace(_undated_urgent(orders), _year_restated(orders), "o_orderdate", REF_DATE)


_TASK_BATCH = """
SELECT user_id AS task_id, event_type AS service, ts AS created_at, event_type AS status, props AS description, event_id AS seq
FROM events
"""


def task_changes(events: DataFrame) -> DataFrame:
    """Events as changes of one task per user."""
    return events.select(
        F.col("user_id").alias("task_id"), F.col("event_type").alias("service"), F.col("ts").alias("created_at"),
        F.col("event_type").alias("status"), F.col("props").alias("description"), F.col("event_id").alias("seq"),
    )


@query(f"""
WITH log AS (
  SELECT c_custkey AS task_id, c_mktsegment AS service, TIMESTAMP '2023-12-31 00:00:00' AS created_at,
         'started' AS status, c_name AS description, -1 AS seq FROM customer
  UNION ALL {_TASK_BATCH})
SELECT task_id, arg_min(service, seq) AS service, arg_min(created_at, seq) AS created_at,
       arg_max(status, seq) AS status, arg_max(description, seq) AS description
FROM log GROUP BY task_id
""")
def task_upsert(spark, sf):
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("task_id"), F.col("c_mktsegment").alias("service"),
        F.lit("2023-12-31 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("started").alias("status"), F.col("c_name").alias("description"),
    )
    return load.upsert(target, task_changes(table(spark, sf, "events")), "task_id", ["seq"], ["status", "description"])


@query("""
SELECT MIN(strftime(o_orderdate, '%Y-%m-%d')) AS date, MIN(strftime(o_orderdate, '%Y-%m')) AS period,
       o_custkey, o_orderstatus, o_orderpriority
FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority
""")
def dedup_min_date(spark, sf):
    loads = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        "o_custkey", "o_orderstatus", "o_orderpriority",
    )
    return dedup.dedup_loads(loads)


@query("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, l_discount FROM lineitem")
def dedup_distinct(spark, sf):
    return dedup.dedup_loads(table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_discount"))


@query("SELECT COUNT(*) AS row_count FROM lineitem")
def count_rows(spark, sf):
    return dedup.count_rows(table(spark, sf, "lineitem"))


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def insert_if_new_types(spark, sf):
    """A batch whose whole numbers and days have other types than the table's is no new rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    batch = orders.select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("double"), F.to_date("o_orderdate").alias("o_orderdate"))
    return orders.unionByName(load.new_rows(orders, batch).select(orders.columns).to(orders.schema))
