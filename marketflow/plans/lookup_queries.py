"""Filters, lookups, gaps, nested records over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import names, periods
from marketflow.operators import filters, lookups, messages, nested, shapes
from marketflow.plans.registry import query, table
from marketflow.plans.schema_queries import CODES_SQL, payloads

NOW = "2024-01-15 12:00:00"


@query("SELECT * FROM events WHERE event_type = 'purchase' AND user_id = 42")
def status_filter(spark, sf):
    return filters.matching(table(spark, sf, "events"), event_type="purchase", user_id=42, props=None)


@query("SELECT * FROM part WHERE p_name LIKE '%ring%'")
def name_filter(spark, sf):
    return filters.named_like(table(spark, sf, "part"), "p_name", "ring")


def _tasks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("task_id"), F.col("user_id"), F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise(F.col("event_type")).alias("status"),
    )


@query(f"""
SELECT event_id AS task_id, user_id, ts AS created_at, 'failed' AS status FROM events
WHERE event_type = 'error' AND ts BETWEEN TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AND TIMESTAMP '{NOW}'
""")
def failed_recent(spark, sf):
    return filters.failed_recent(_tasks(table(spark, sf, "events")), NOW, hours=24)


def _listing(events: DataFrame) -> DataFrame:
    """Events as a listing of report documents: a click is a report of the day before."""
    before = F.date_format(F.date_sub(F.col("ts").cast("date"), 1), "yyyy-MM-dd")
    return events.select(
        F.col("event_id").alias("id"), F.when(F.col("event_type") == "click", 16).otherwise(13).alias("reportType"),
        F.col("user_id").alias("key"), before.alias("from"), before.alias("to"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("createdAt"),
        F.when(F.col("event_type").isin("click", "view"), "DONE").otherwise("IN_PROGRESS").alias("processingStatus"),
    )


_LISTED = """
SELECT event_id AS id, user_id AS key, strftime(ts, '%Y-%m-%d') AS created FROM events
WHERE event_type = 'click' AND CAST(ts AS DATE) = DATE '2024-01-15'
  AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
"""


@query(f"""
SELECT id, key, created FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY id) AS rn FROM ({_LISTED})) WHERE rn = 1
""")
def listing_filter(spark, sf):
    """First usable report per wanted key, of those listed on one day."""
    wanted = table(spark, sf, "customer").where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("key"))
    listed = filters.listed_reports(
        _listing(table(spark, sf, "events")), wanted, "key", periods.ref("2024-01-14"), periods.ref("2024-01-15")
    )
    first = filters.first_per_key(listed, "key", "id")
    return first.select("id", "key", F.substring("createdAt", 1, 10).alias("created"))


@query("SELECT event_id AS id, user_id AS key FROM events WHERE event_type IN ('click', 'view') ORDER BY event_id LIMIT 1")
def first_ready(spark, sf):
    return filters.first_ready(_listing(table(spark, sf, "events")), "id").select("id", "key")


_LINES = "SELECT o_orderkey // 25 AS page, strftime(o_orderdate, '%b') || ' ' || day(o_orderdate) || ' order' AS line FROM orders"


@query(f"""
WITH pages AS (
  SELECT page, bool_or(contains(line, 'Jun')) AS has_current,
         bool_or(NOT contains(line, 'Jun') AND contains(line, 'May')) AS has_previous
  FROM ({_LINES}) GROUP BY page)
SELECT *, has_previous AND page < COALESCE((SELECT MIN(page) FROM pages WHERE NOT has_current AND NOT has_previous), 1e18) AS kept
FROM pages
""")
def month_pages(spark, sf):
    lines = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 25).cast("long").alias("page"),
        F.concat_ws(" ", F.date_format("o_orderdate", "MMM"), F.dayofmonth("o_orderdate"), F.lit("order")).alias("line"),
    )
    return filters.month_pages(lines, "page", "line", "Jun", "May")


@query("SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer) WHERE pos >= 98")
def row_slice(spark, sf):
    return filters.row_slice(table(spark, sf, "customer"), "c_custkey", 98).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer) WHERE pos <= 99")
def row_slice_head(spark, sf):
    return filters.row_slice(table(spark, sf, "customer"), "c_custkey", 0, 99).select("c_custkey", "c_name")


# Every link of a sample page is an <a href="..."> with nothing else in its tag; the SQL cuts at that text.
_LINKS_SQL = """
WITH parts AS (SELECT page_id, url, unnest(string_split(html, '<a href="')[2:]) AS part FROM pages),
l AS (SELECT page_id, url, split_part(part, '"', 1) AS href FROM parts)
SELECT page_id, href, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || href AS target, split_part(url, '/', 3) AS target_host
FROM l WHERE left(href, 1) = '/' AND left(href, 2) <> '//' AND right(href, 4) NOT IN ('.pdf', '.jpg', '.png', '.zip')
"""


@query(_LINKS_SQL)
def page_links(spark, sf):
    return filters.page_links(table(spark, sf, "pages")).select("page_id", "href", "target", "target_host")


@query(_LINKS_SQL)
def page_link_styles(spark, sf):
    """The same links written in other ways, among tags, comments and scripts that only look like links."""
    href = r'<a href="([^"]*)"'
    styles = [
        F.regexp_replace("html", href, "<a title='a > b href=no' HREF = '$1'"),
        F.regexp_replace("html", href, "<A\n data-href=\"/no\"\thref=$1 class=x"),
        F.regexp_replace(F.regexp_replace("html", r'<a href="/', '<a href="&#47;'), r'<a href="([^"]*),', '<a href="$1&#x2C;'),
        F.concat(F.lit("<!-- <a href='/no'> --><script>'<a href=\"/no\">'</script><title><a href=/no></title><abbr href='/no'>"), "html"),
    ]
    kind = F.pmod("page_id", F.lit(len(styles) + 1))
    html = F.col("html")
    for k, style in enumerate(styles):
        html = F.when(kind == k, style).otherwise(html)
    pages = table(spark, sf, "pages").withColumn("html", html)
    return filters.page_links(pages).select("page_id", "href", "target", "target_host")


@query("SELECT page_id, split_part(url, '/', 3) AS page_host FROM pages")
def page_hosts(spark, sf):
    return table(spark, sf, "pages").select("page_id", filters.host(F.col("url")).alias("page_host"))


@query("SELECT o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) BETWEEN 901 AND 12001")
def row_slice_deep(spark, sf):
    """A slice whose ends are found by counting ranges, more than once, as no task may sort over 500 rows."""
    return filters.row_slice(table(spark, sf, "orders"), "o_orderkey", 900, 12000, most=500).select("o_orderkey", "o_totalprice")


MONTHS = [date(1998, m, 1) for m in range(1, 13)]


@query("""
WITH p AS (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS DATE) AS period),
have AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders)
SELECT c_custkey, string_agg(strftime(period, '%Y-%m-%d'), ',' ORDER BY period) AS missing, COUNT(*) AS gaps
FROM customer, p WHERE NOT EXISTS (SELECT 1 FROM have WHERE have.o_custkey = c_custkey AND have.period = p.period)
GROUP BY c_custkey
""")
def gap_detection(spark, sf):
    """Customers with the months of 1998 in which they ordered nothing."""
    orders = table(spark, sf, "orders")
    months = orders.select(F.col("o_custkey").alias("c_custkey"), F.trunc("o_orderdate", "MM").cast("timestamp_ntz").alias("period"))
    keys = table(spark, sf, "customer").select("c_custkey")
    gaps = lookups.missing_periods(keys, months, "c_custkey", "period", MONTHS)
    return gaps.select("c_custkey", F.array_join(F.col("missing").cast("array<string>"), ",").alias("missing"), F.size("missing").cast("long").alias("gaps"))


@query("""
SELECT o_orderkey, c_name, COALESCE(n_name, 'none') AS n_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3
""")
def lookup_join(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").where("n_regionkey < 3").select("n_nationkey", "n_name")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    named = lookups.lookup(lookups.lookup(orders, customers, ["o_custkey"]), nations, ["n_nationkey"], {"n_name": F.lit("none")})
    return named.select("o_orderkey", "c_name", "n_name")


@query("SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def membership(spark, sf):
    wanted = table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return lookups.members(table(spark, sf, "orders"), wanted, "o_custkey")


@query("""
SELECT event_id, user_id, ts, latest_event_id FROM (
  SELECT r.event_id, r.user_id, r.ts, m.event_id AS latest_event_id,
         row_number() OVER (PARTITION BY r.event_id ORDER BY m.ts DESC, m.event_id DESC) AS rn
  FROM events r LEFT JOIN events m
    ON m.event_type = 'signup' AND m.user_id = r.user_id AND m.ts > r.ts - INTERVAL 3600 SECOND AND m.ts <= r.ts
  WHERE r.event_type = 'error') WHERE rn = 1
""")
def latest_within(spark, sf):
    """Error events with the newest signup of their user in the hour before."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    errors = events.where("event_type = 'error'").drop("event_type")
    signups = events.where("event_type = 'signup'").drop("event_type")
    return lookups.latest_within(errors, signups, "user_id", "ts", "ts", ["event_id"], 3600)


@query(f"""
SELECT phone, arg_max(otp_code, ts) AS otp_code FROM ({CODES_SQL})
WHERE ts > TIMESTAMP '{NOW}' - INTERVAL 86400 SECOND AND ts <= TIMESTAMP '{NOW}' GROUP BY phone
""")
def latest_code(spark, sf):
    """The newest code of every phone that got one in the day before."""
    codes = messages.message_codes(payloads(table(spark, sf, "events")))
    return lookups.latest_code(codes, "phone", "otp_code", "ts", F.lit(NOW).cast("timestamp_ntz"), 86400)


@query("""
WITH usage AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
restarts AS (
  SELECT c_custkey, CAST(DATE '1996-01-15' + INTERVAL 1 MONTH * (c_nationkey * 2) AS DATE) AS day,
         c_name || '/1' AS old_id, c_name || '/2' AS new_id
  FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL
  SELECT c_custkey, CAST(DATE '2000-03-01' AS DATE), c_name || '/2', c_name || '/3'
  FROM customer WHERE c_mktsegment = 'MACHINERY'),
chosen AS (
  SELECT u.o_custkey, u.month,
    (SELECT min(day) FROM restarts r WHERE r.c_custkey = u.o_custkey AND r.day >= u.month) AS ahead,
    (SELECT max(day) FROM restarts r WHERE r.c_custkey = u.o_custkey AND r.day < u.month) AS behind
  FROM usage u),
ids AS (
  SELECT o_custkey, month, r.old_id AS effective_id FROM chosen JOIN restarts r ON r.c_custkey = o_custkey AND r.day = ahead
  UNION ALL
  SELECT o_custkey, month, r.new_id FROM chosen JOIN restarts r ON r.c_custkey = o_custkey AND r.day = ahead WHERE ahead <= last_day(month)
  UNION ALL
  SELECT o_custkey, month, r.new_id FROM chosen JOIN restarts r ON r.c_custkey = o_custkey AND r.day = behind WHERE ahead IS NULL
  UNION ALL
  SELECT o_custkey, month, c_name FROM chosen JOIN customer ON c_custkey = o_custkey WHERE ahead IS NULL AND behind IS NULL)
SELECT * FROM ids
""")
def effective_keys(spark, sf):
    """The ids under which customers bought in each month, with ids replaced over time."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    usage = table(spark, sf, "orders").select("o_custkey", "o_orderdate").join(customers.select("o_custkey", "c_name"), "o_custkey")

    def restart(rows: DataFrame, day, old: str, new: str) -> DataFrame:
        ids = [F.concat("c_name", F.lit(s)).alias(n) for s, n in ((old, "old_id"), (new, "new_id"))]
        return rows.select("o_custkey", day.alias("restart_date"), *ids)

    first_day = F.add_months(periods.ref("1996-01-15"), F.col("c_nationkey") * 2)
    restarts = restart(customers.where("c_mktsegment <> 'BUILDING'"), first_day, "/1", "/2").unionByName(
        restart(customers.where("c_mktsegment = 'MACHINERY'"), periods.ref("2000-03-01"), "/2", "/3")
    )
    return lookups.effective_keys(usage, restarts, "o_custkey", "o_orderdate", "c_name")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def latest_per_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return lookups.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT event_id, ts FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_row(spark, sf):
    return lookups.latest_row(filters.matching(table(spark, sf, "events"), event_type="click"), ["ts", "event_id"]).select("event_id", "ts")


MONEY = "struct<amount double, currencyCode string>"


@query("""
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value AS price,
       event_type = 'click' AS flagged, CASE WHEN event_type <> 'view' THEN 'None, True' END AS remark
FROM events
""")
def json_flatten(spark, sf):
    """Record cells, half of them Python-style, with a nested money object."""
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    flag = F.col("event_type") == "click"
    strict = F.concat(
        F.lit('{"k": '), k, F.lit(', "price": {"amount": '), F.col("value").cast("string"),
        F.lit(', "currencyCode": "USD"}, "more": {"flagged": '), flag.cast("string"),
        F.when(F.col("event_type") == "view", F.lit(', "remark": null}}')).otherwise(F.lit(', "remark": "None, True"}}')),
    )
    literal = F.concat(
        F.lit("{'k': "), k, F.lit(", 'price': {'amount': "), F.col("value").cast("string"),
        F.lit(", 'currencyCode': 'USD'}, 'more': {'flagged': "), F.when(flag, "True").otherwise("False"),
        F.when(F.col("event_type") == "view", F.lit(", 'remark': None}}")).otherwise(F.lit(", 'remark': 'None, True'}}")),
    )
    cells = events.select("event_id", "user_id", F.when(F.col("event_type").isin("click", "view"), literal).otherwise(strict).alias("cell"))
    schema = T.StructType.fromDDL(f"k bigint, price {MONEY}, more struct<flagged boolean, remark string>")
    return nested.flatten_columns(cells, ["cell"], {"cell": schema})


@query("""
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value AS price,
       CASE WHEN event_type <> 'error' THEN event_type = 'click' END AS flagged, CASE WHEN event_type = 'error' THEN 'no "data"' END AS more,
       CASE WHEN event_type <> 'error' THEN event_id END AS deep
FROM events
""")
def json_flatten_unknown(spark, sf):
    """Record cells of no declared shape; money is a bare number and an inner record a text in some, others are Python-style."""
    events = table(spark, sf, "events")
    k, value = F.get_json_object("props", "$.k"), F.col("value").cast("string")
    flag = F.col("event_type") == "click"
    strict = F.concat(F.lit('{"k": '), k, F.lit(', "price": '), value, F.lit(', "more": "no \\\"data\\\""}'))
    literal = F.concat(
        F.lit("{'k': "), k, F.lit(", 'price': {'amount': "), value, F.lit(", 'currencyCode': None}, 'more': {'flagged': "),
        F.when(flag, "True").otherwise("False"), F.lit(", 'in': {'deep': "), F.col("event_id").cast("string"), F.lit("}}}"),
    )
    cells = events.select("event_id", "user_id", F.when(F.col("event_type") == "error", strict).otherwise(literal).alias("cell"))
    return shapes.flatten_unknown(cells, ["cell"])


def _leaves() -> list[str]:
    return list(names.SEARCH_PERFORMANCE_COLUMNS)


def search_groups() -> dict[str, list[str]]:
    """Leaf names of the five groups of a search-performance record."""
    leaves = _leaves()
    bounds = [0, 3, 6, 15, 24, 33]
    return {g: leaves[a:b] for g, a, b in zip(nested.SEARCH_PERFORMANCE_GROUPS, bounds, bounds[1:])}


def search_schema() -> T.StructType:
    def leaf(name: str) -> str:
        kind = "string" if name == "searchQuery" else MONEY if name.endswith("Price") else "double" if name.endswith(("Share", "Rate")) else "bigint"
        return f"{name} {kind}"

    groups = [f"{g} struct<{', '.join(map(leaf, members))}>" for g, members in search_groups().items()]
    return T.StructType.fromDDL(", ".join([*groups, "asin string"]))


def search_records(lines: DataFrame) -> DataFrame:
    """Order lines as search-performance records."""

    def value(name: str, i: int):
        if name == "searchQuery":
            return F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string"))
        if name.endswith("Price"):
            return F.struct((F.col("l_extendedprice") + i).alias("amount"), F.lit("USD").alias("currencyCode"))
        if name.endswith(("Share", "Rate")):
            return F.col("l_discount") + i
        return F.col("l_linenumber").cast("long") * i

    order = {name: i for i, name in enumerate(_leaves())}
    groups = [F.struct(*[value(n, order[n]).alias(n) for n in members]).alias(g) for g, members in search_groups().items()]
    return lines.select(*groups, F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("asin"))


def search_sql() -> str:
    def value(name: str, i: int) -> str:
        if name == "searchQuery":
            return "l_returnflag || ' ' || l_linestatus || ' ' || CAST(l_partkey AS VARCHAR)"
        if name.endswith("Price"):
            return f"l_extendedprice + {i}"
        return f"l_discount + {i}" if name.endswith(("Share", "Rate")) else f"CAST(l_linenumber * {i} AS BIGINT)"

    columns = [f"{value(n, i)} AS {names.SEARCH_PERFORMANCE_COLUMNS[n]}" for i, n in enumerate(_leaves())]
    return f"SELECT {', '.join(columns)}, 'B' || CAST(l_partkey AS VARCHAR) AS sku, DATE '1998-06-13' AS reporting_date FROM lineitem"


@query(search_sql())
def search_perf_flatten(spark, sf):
    records = search_records(table(spark, sf, "lineitem"))
    return nested.search_performance(records, F.col("asin"), periods.ref("1998-06-13"))
