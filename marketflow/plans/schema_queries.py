"""Names, stamps, types and scalar coercions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions import coerce, names, periods
from marketflow.operators import filters, messages, projections
from marketflow.operators.projections import Field
from marketflow.plans import reports
from marketflow.plans.registry import query, table

MESSY_PART = ["Part Key #", "(Child) Part-Name", "Brand % Share", "Percentage Type", "2nd Size", "Retail--Price"]


def _part(spark, sf, headers: list[str]) -> DataFrame:
    return table(spark, sf, "part").toDF(*headers)


@query("""
SELECT p_partkey AS part_key, p_name AS child_part_name, p_brand AS brand_percent_share, p_type AS pct_type,
       p_size AS col_2nd_size, p_retailprice AS retail_price FROM part
""")
def clean_names(spark, sf):
    return names.clean_names(_part(spark, sf, MESSY_PART))


@query("""
SELECT p_partkey AS part_key, p_name AS campaign_name_14d, p_brand AS asincount, p_type AS is_primed,
       p_size AS size_2, p_retailprice AS retail_price FROM part
""")
def clean_names_camel(spark, sf):
    headers = ["partKey", "campaignName14d", "ASINCount", "IsPRIMEd", "size2", "retailPrice"]
    return names.clean_names(_part(spark, sf, headers), camel=True)


@query("""
SELECT p_partkey AS "Part Key ", p_name AS "Child_ Part_Name", p_brand AS "Brand percent Share",
       p_type AS "Percentage Type", p_size AS "col_2nd Size", p_retailprice AS "Retail_Price" FROM part
""")
def clean_names_cloud(spark, sf):
    return names.clean_names_cloud(_part(spark, sf, MESSY_PART))


@query("""
SELECT p_partkey AS part_key, p_name AS reporting_date, p_brand AS "brand_share", p_type AS type,
       p_size AS "size_cm", p_retailprice AS price FROM part
""")
def clean_names_simple(spark, sf):
    headers = ["Part Key", "Reporting Date", "Brand__Share", "Type", "Size_ cm", "PRICE"]
    return names.rename_all(_part(spark, sf, headers), names.share_name)


@query("""
SELECT event_id AS search_query, user_id AS search_query_score, event_type AS clicks_1d_shipping_speed,
       value AS cart_adds_price_median, props, ts AS purchases_click_marker FROM events
""")
def rename_map(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("searchQuery"), F.col("user_id").alias("searchQueryScore"),
        F.col("event_type").alias("totalOneDayShippingClickCount"), F.col("value").alias("totalMedianCartAddPrice"),
        "props", F.col("ts").alias("purchases_click_marker"),
    )
    return names.rename_search_performance(events)


@query("""
SELECT 'S-1' AS sku, '06/08/1998-06/15/1998' AS period, '1998-06-15' AS date, c_custkey, c_name, c_acctbal
FROM customer
""")
def stamp_columns(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    stamped = projections.stamp_all(
        customers, add_date="1998-06-15", custom_date="1998-06-14", period="06/08/1998-06/15/1998", sku="S-1"
    )
    return projections.stamp(stamped, period="other", sku="S-2")


def _rendered_lines(spark, sf) -> DataFrame:
    """Order lines as a report would spell them: all text."""
    money = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    percent = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_key"), F.col("l_quantity").cast("string").alias("quantity"),
        money.alias("price"), percent.alias("discount"), F.col("l_returnflag").alias("flag"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("shipped"), F.lit("x").alias("extra"),
    )


LINE_CONTRACT = (
    Field("order_key", "long"),
    Field("quantity", "long"),
    Field("price", "double"),
    Field("discount", "double"),
    Field("flag", "string"),
    Field("shipped", "timestamp", ("MM/dd/yyyy",)),
    Field("returned", "boolean"),
    Field("tax", "double"),
)


@query("""
SELECT l_orderkey AS order_key, CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price,
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS DOUBLE) AS discount, l_returnflag AS flag,
       l_shipdate AS shipped, CAST(NULL AS BOOLEAN) AS returned, CAST(NULL AS DOUBLE) AS tax
FROM lineitem
""")
def conform_schema(spark, sf):
    return projections.conform(_rendered_lines(spark, sf), LINE_CONTRACT)


@query("""
SELECT l_orderkey AS order_key, CAST(l_quantity AS DOUBLE) AS quantity, printf('$%,.2f', l_extendedprice) AS price,
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS discount, l_returnflag AS flag, l_shipdate AS shipped, 'x' AS extra
FROM lineitem
""")
def infer_contract(spark, sf):
    """First load of a text batch: types from the values, then conformed to them. Money and percents are text, as they read as no number."""
    rendered = _rendered_lines(spark, sf)
    return projections.conform(rendered, projections.infer_contract(rendered))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def drop_repeated_columns(spark, sf):
    nation = table(spark, sf, "nation")
    wide = nation.select("*", F.upper("n_name"), F.lit("z")).toDF(*nation.columns, "n_name", "n_nationkey")
    return names.keep_first_of_repeated(wide)


@query("""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_extendedprice AS price,
       CASE l_returnflag WHEN 'R' THEN CAST(l_linenumber AS DOUBLE) END AS mixed
FROM lineitem
""")
def money_percent(spark, sf):
    """A price column in dollars; a column with any percent keeps only its percents."""
    n = F.col("l_linenumber").cast("string")
    mixed = (
        F.when(F.col("l_returnflag") == "R", F.concat(n, F.lit("%")))
        .when(F.col("l_returnflag") == "A", F.concat(n, F.lit(",200%")))
        .otherwise(F.concat(F.lit("$"), n))
    )
    rendered = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("price"), mixed.alias("mixed"),
    )
    return projections.conform(
        rendered,
        (Field("l_orderkey", "long"), Field("l_linenumber", "long"), Field("l_partkey", "long"), Field("price", "double"), Field("mixed", "double")),
    )


@query("""
SELECT o_orderkey, o_custkey AS whole, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS fraction,
       NULLIF(o_orderpriority, '1-URGENT') AS words, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS answer,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS at, CAST(o_orderdate AS DATE) AS day
FROM orders
""")
def coerce_scalars(spark, sf):
    status, key = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(key, F.lit(".0")).alias("whole"),
        F.when(status == "F", F.concat(F.lit(" "), key)).when(status == "O", F.concat(key, F.lit(".5"))).otherwise("5d").alias("fraction"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "nan").otherwise(F.col("o_orderpriority")).alias("words"),
        F.when(status == "F", "True").when(status == "O", "0").otherwise("true").alias("flag"),
        F.when(status == "F", "Yes").when(status == "O", "No").otherwise("maybe").alias("answer"),
        F.when(status == "P", "soon").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy HH:mm")).alias("at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    return text.select(
        "o_orderkey", coerce.to_long("whole").alias("whole"), coerce.to_long("fraction").alias("fraction"),
        coerce.to_text("words").alias("words"), coerce.to_flag("flag").alias("flag"), coerce.yes_no("answer").alias("answer"),
        coerce.to_timestamp("at", ("MM/dd/yyyy HH:mm",)).alias("at"), coerce.to_date("day").alias("day"),
    )


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '-' || '0042'
       WHEN 'MACHINERY' THEN 'K1A ' || CAST(c_custkey AS VARCHAR) || '.0'
       WHEN 'HOUSEHOLD' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS postal
FROM customer
""")
def postal_clean(spark, sf):
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", F.concat(F.lpad(key, 9, "0"), F.lit("-0042")))
        .when(segment == "MACHINERY", F.concat(F.lit("K1A "), key, F.lit(".0")))
        .when(segment == "HOUSEHOLD", F.lit(None))
        .otherwise(F.concat(key, F.lit(".0")))
    )
    return table(spark, sf, "customer").select("c_custkey", coerce.postal(text).alias("postal"))


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS INTEGER) END AS week,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(user_id AS INTEGER) ELSE 53 END AS trailing
FROM events
""")
def extract_numbers(spark, sf):
    number, kind = F.col("user_id").cast("string"), F.col("event_type")
    title = F.when(kind == "error", F.concat(F.lit("Week of "), number)).otherwise(F.concat(F.lit("Report, Week  "), number, F.lit(" of 60")))
    note = (
        F.when(kind == "click", F.concat(F.lit("done: week: "), number, F.lit(" ")))
        .when(kind == "view", number)
        .when(kind == "error", F.lit("week: none"))
        .when(kind == "signup", F.concat(number, F.lit(":")))
    )
    return table(spark, sf, "events").select(
        "event_id", coerce.week_number(title).alias("week"), coerce.trailing_number(note).alias("trailing")
    )


_FILE_NAMES = """
SELECT o_orderkey, CASE o_orderstatus
  WHEN 'F' THEN 'orders_' || strftime(o_orderdate, '%d_%m_%Y') || '.log'
  WHEN 'O' THEN 'orders_45_13_1998_' || strftime(o_orderdate, '%Y-%m-%d') || '.log'
  ELSE 'orders_' || CAST(o_orderkey AS VARCHAR) || '.log' END AS name,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS file_date
FROM orders
"""


def _named_files(spark, sf) -> DataFrame:
    status = F.col("o_orderstatus")
    name = (
        F.when(status == "F", F.concat(F.lit("orders_"), F.date_format("o_orderdate", "dd_MM_yyyy"), F.lit(".log")))
        .when(status == "O", F.concat(F.lit("orders_45_13_1998_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".log")))
        .otherwise(F.concat(F.lit("orders_"), F.col("o_orderkey").cast("string"), F.lit(".log")))
    )
    return table(spark, sf, "orders").select("o_orderkey", name.alias("name"))


@query(_FILE_NAMES)
def filename_dates(spark, sf):
    return _named_files(spark, sf).withColumn("file_date", coerce.file_name_date("name"))


@query(f"SELECT * FROM ({_FILE_NAMES}) WHERE file_date <= DATE '1998-06-10'")
def expired_files(spark, sf):
    return filters.expired(_named_files(spark, sf), "name", "1998-06-15")


def payloads(events: DataFrame) -> DataFrame:
    """Events as message payloads: clicks and views carry a code, signups a greeting."""
    kind = F.col("event_type")
    code = F.lpad(F.col("event_id").cast("string"), 6, "0")
    text = (
        F.when(kind.isin("click", "view"), F.concat(code, F.lit(" is your code")))
        .when(kind == "purchase", F.substring(code, 4, 3))
        .otherwise(F.lit("hello"))
    )
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("caller_did"), text.alias("text")))
    return events.select(
        "event_id", "ts", F.when(kind == "view", "CALL").otherwise("SMS").alias("event"),
        F.when(kind == "error", "not json").otherwise(body).alias("result"),
    )


CODES_SQL = """
SELECT event_id, ts, CAST(user_id AS VARCHAR) AS phone,
       CASE event_type WHEN 'click' THEN substr(lpad(CAST(event_id AS VARCHAR), 6, '0'), 1, 6)
       ELSE substr(lpad(CAST(event_id AS VARCHAR), 6, '0'), 4, 3) END AS otp_code
FROM events WHERE event_type IN ('click', 'purchase')
"""


@query(CODES_SQL)
def message_codes(spark, sf):
    return messages.message_codes(payloads(table(spark, sf, "events")))


_PERIOD_SQL = "strftime(o_orderdate - INTERVAL 7 DAY, '%m/%d/%Y') || '-' || strftime(o_orderdate, '%m/%d/%Y')"


@query(f"""
SELECT o_orderkey, {_PERIOD_SQL} AS period, CAST(o_orderdate - INTERVAL 7 DAY AS DATE) AS starts,
       CAST(o_orderdate AS DATE) AS created_day, strftime(o_orderdate, '%B') AS month, strftime(o_orderdate, '%b') AS abbreviation
FROM orders
""")
def period_text(spark, sf):
    day = F.col("o_orderdate").cast("date")
    period = periods.period_text(periods.trailing_week(day))
    created = F.date_format("o_orderdate", "yyyy-MM-dd'T'23:59:59.485'Z'")
    return table(spark, sf, "orders").select(
        "o_orderkey", period.alias("period"), coerce.period_start(period).alias("starts"),
        coerce.utc_day(created).alias("created_day"), periods.month_name(day).alias("month"),
        periods.month_abbreviation(day).alias("abbreviation"),
    )


_D = "CAST(o_orderdate AS DATE)"
_BACK = "date_trunc('month', d) - INTERVAL 1 MONTH"


@query(f"""
WITH days AS (SELECT DISTINCT {_D} AS d FROM orders)
SELECT d, CAST(date_trunc('month', d) AS DATE) AS month_start,
  CASE WHEN day(d) = 1 THEN d ELSE CAST(d - INTERVAL 1 DAY AS DATE) END AS month_end,
  CAST({_BACK} AS DATE) AS previous_start, CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE) AS previous_end,
  CAST(date_trunc('year', {_BACK}) AS DATE) AS year_start, CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE) AS year_end,
  CAST(d - INTERVAL 8 DAY AS DATE) AS week_start, CAST(d - INTERVAL 2 DAY AS DATE) AS week_end,
  CAST(d - INTERVAL 1 DAY AS DATE) AS yesterday, CAST(d - INTERVAL 3 DAY AS DATE) AS three_days_ago,
  CAST(d - CAST(CASE WHEN isodow(d) = 7 THEN 1 WHEN isodow(d) = 6 THEN 7 ELSE isodow(d) + 1 END AS INTEGER) AS DATE) AS saturday,
  isodow(d) <= 3 AS gap_day, CASE WHEN day(d) <= 3 THEN 2 ELSE 1 END AS reloads
FROM days
""")
def period_table(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    d = F.col("d")
    spans = {
        "month": periods.current_month(d), "previous": periods.previous_month(d),
        "year": periods.full_year(d), "week": periods.last_week(d),
    }
    bounds = [s[f"{end}_date"].alias(f"{name}_{end}") for name, s in spans.items() for end in ("start", "end")]
    return days.select(
        "d", *bounds,
        periods.days_ago(d, 1)["start_date"].alias("yesterday"), periods.days_ago(d, 3)["end_date"].alias("three_days_ago"),
        periods.search_week(d)["end_date"].alias("saturday"), periods.is_gap_day(d).alias("gap_day"),
        F.size(periods.reload_months(d)).alias("reloads"),
    )


@query(f"""
WITH days AS (SELECT DISTINCT {_D} AS d FROM orders),
spans AS (
  SELECT d, CAST(unnest(generate_series(d - INTERVAL 7 DAY, d - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS start_date,
         'refetch' AS kind FROM days
  UNION ALL
  SELECT d, CAST(unnest(generate_series(date_trunc('year', d), date_trunc('month', d), INTERVAL 1 MONTH)) AS DATE), 'month' FROM days)
SELECT d, kind, start_date,
       CASE kind WHEN 'month' THEN last_day(start_date) ELSE start_date END AS end_date
FROM spans
""")
def period_lists(spark, sf):
    """The refetched days of every order date, and the months of its year so far."""
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    d = F.col("d")
    refetch = days.select("d", F.lit("refetch").alias("kind"), F.explode(periods.refetch_days(d)).alias("start_date"))
    months = days.select("d", F.lit("month").alias("kind"), F.inline(periods.months_between(F.trunc(d, "YEAR"), d)))
    return months.unionByName(refetch.withColumn("end_date", F.col("start_date"))).select("d", "kind", "start_date", "end_date")


def _covered_sql() -> str:
    previous = "date_trunc('month', d) - INTERVAL 1 MONTH"
    spans = {
        "current_month": [("date_trunc('month', d)", "CASE WHEN day(d) = 1 THEN d ELSE d - INTERVAL 1 DAY END")],
        "previous_month": [(previous, "date_trunc('month', d) - INTERVAL 1 DAY")],
        "full_year": [(f"date_trunc('year', {previous})", "date_trunc('month', d) - INTERVAL 1 DAY")],
        "last_week": [("d - INTERVAL 8 DAY", "d - INTERVAL 2 DAY")],
        "trailing_week": [("d - INTERVAL 7 DAY", "d")],
        "yesterday": [("d - INTERVAL 1 DAY", "d - INTERVAL 1 DAY")],
        "single_days": [(f"d - INTERVAL {n} DAY", f"d - INTERVAL {n} DAY") for n in (1, 3)],
        "refetch_days": [(f"d - INTERVAL {n} DAY", f"d - INTERVAL {n} DAY") for n in range(1, 8)],
        "search_week": [
            ("d - INTERVAL 1 DAY * (isodow(d) % 7 + 7)", "d - INTERVAL 1 DAY * (isodow(d) % 7 + 1)")
        ],
    }
    selects = []
    for r in reports.REPORTS.values():
        if r.period == "reload_months":
            selects.append(f"SELECT d, '{r.name}' AS report, date_trunc('month', d) AS s, last_day(d) AS e FROM days")
            selects.append(f"SELECT d, '{r.name}', {previous}, date_trunc('month', d) - INTERVAL 1 DAY FROM days WHERE day(d) <= 3")
        else:
            selects += [f"SELECT d, '{r.name}' AS report, {s} AS s, {e} AS e FROM days" for s, e in spans.get(r.period, [])]
    return f"""
WITH days AS (SELECT DISTINCT {_D} AS d FROM orders)
SELECT d, report, CAST(s AS DATE) AS start_date, CAST(e AS DATE) AS end_date FROM ({' UNION ALL '.join(selects)})
"""


@query(_covered_sql())
def report_periods(spark, sf):
    """What every report would cover if it ran on each order date."""
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return reports.covered_periods(days, "d")


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'")
def day_window(spark, sf):
    yesterday = F.date_sub(periods.ref("2024-01-15"), 1)
    return table(spark, sf, "events").where(periods.in_day(F.col("ts"), yesterday))





@query("""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS "Sessions _ Browser", l_returnflag = 'R' AS "IsPrime",
       l_linestatus = 'F' AS is_business_order, l_shipdate AS reporting_date
FROM lineitem
""")
def cloud_types(spark, sf):
    text = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("Sessions _ Browser"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("IsPrime"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_business_order"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("reporting_date"),
    )
    return projections.cloud_types(text, "sales_traffic_daily")
