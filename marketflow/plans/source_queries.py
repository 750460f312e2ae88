"""Scans: tables rendered as report files on the shared folder, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions import coerce, names
from marketflow.operators import filters, nested, projections
from marketflow.operators.projections import Field
from marketflow.plans.lookup_queries import search_records, search_schema, search_sql
from marketflow.plans.registry import query, table
from marketflow.plans.rendered import array_files, csv_line, framed_files, headed_files, small_splits
from marketflow.session import scratch_path, stage
from marketflow.sinks import tables as sinks
from marketflow.sources import delimited, documents, lines, spans

PREAMBLE = [f"Definition line {n}, with commas" for n in range(1, 8)]


def _text(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _bytes(text, code: str):
    """Text followed by one raw byte."""
    return F.concat(F.encode(text, "ISO-8859-1"), F.unhex(F.lit(code)))


ORDER_CONTRACT = (
    Field("order_key", "long"),
    Field("cust_key", "long"),
    Field("total_price", "double"),
    Field("order_date", "timestamp"),
    Field("note", "string"),
)

_ORDERS_SQL = """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_totalprice AS total_price, o_orderdate AS order_date,
       'ordered, "' || o_orderpriority || '"' AS note FROM orders
"""


def _note():
    return F.concat(F.lit('ordered, "'), F.col("o_orderpriority"), F.lit('"'))


def order_files(spark, sf) -> list[str]:
    """Orders as files with seven lines before the header, in two column orders."""
    orders = table(spark, sf, "orders")
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    done = orders.where("o_orderstatus = 'F'")
    rest = orders.where("o_orderstatus <> 'F'")
    one = csv_line(_text("o_orderkey").alias("a"), _text("o_custkey").alias("b"), price.alias("c"), day.alias("d"), _note().alias("e"))
    two = csv_line(_note().alias("a"), day.alias("b"), price.alias("c"), _text("o_orderkey").alias("d"), _text("o_custkey").alias("e"))
    return [
        headed_files(done, one, [*PREAMBLE, "Order Key,Cust Key,Total Price,Order Date,Note"], "orders"),
        headed_files(rest, two, [*PREAMBLE, "Note,Order Date,Total Price,Order Key,Cust Key"], "orders"),
    ]


@query(_ORDERS_SQL)
def csv_preamble(spark, sf):
    raw = delimited.read_delimited(spark, order_files(spark, sf), skip_rows=7)
    return projections.conform(names.clean_names(raw), ORDER_CONTRACT)


@query("""
SELECT p_partkey AS part_key, chr(8220) || p_name || chr(8221) AS title, CAST(p_size AS VARCHAR) || chr(8364) AS price FROM part
""")
def csv_cp1252(spark, sf):
    """Files that are not UTF-8 but code page 1252: curly quotes and euro signs."""
    title = F.concat(F.unhex(F.lit("93")), _bytes(F.col("p_name"), "94"))
    line = F.concat(
        F.encode(F.concat(_text("p_partkey"), F.lit(",")), "ISO-8859-1"), title, F.encode(F.lit(","), "ISO-8859-1"),
        _bytes(_text("p_size"), "80"),
    ).cast("string")
    path = headed_files(table(spark, sf, "part"), line, ["part_key,title,price"], "part")
    raw = delimited.read_delimited(spark, path)
    return raw.withColumn("part_key", coerce.to_long("part_key"))


@query("SELECT p_partkey AS part_key, p_name || chr(129) || chr(147) AS title FROM part")
def csv_latin1(spark, sf):
    """Files with a byte that code page 1252 lacks are read as Latin-1 throughout."""
    line = F.concat(
        F.encode(F.concat(_text("p_partkey"), F.lit(",")), "ISO-8859-1"), _bytes(F.col("p_name"), "81"), F.unhex(F.lit("93"))
    ).cast("string")
    path = headed_files(table(spark, sf, "part"), line, ["part_key,title"], "part")
    return delimited.read_delimited(spark, path).withColumn("part_key", coerce.to_long("part_key"))


@query("""
SELECT c_custkey, c_name || chr(10) || chr(8220) || c_mktsegment || chr(8221) || ', "quoted"' || chr(10) || chr(10) || 'end' AS address,
       c_nationkey || chr(8364) || ' 5" pipe' AS note
FROM customer
""")
def csv_multiline(spark, sf):
    """Line breaks inside quotes below seven lines, one with an odd quote, in files of code page 1252 that are cut into splits."""
    latin = lambda text: F.encode(text, "ISO-8859-1")
    address = F.concat(
        latin(F.concat(F.col("c_name"), F.lit("\n"))), F.unhex(F.lit("93")), latin(F.col("c_mktsegment")), F.unhex(F.lit("94")),
        latin(F.lit(', ""quoted""\n\nend')),
    )
    note = F.concat(latin(_text("c_nationkey")), F.unhex(F.lit("80")), latin(F.lit(' 5" pipe')))
    line = F.concat(latin(F.concat(_text("c_custkey"), F.lit(',"'))), address, latin(F.lit('",')), note).cast("string")
    path = headed_files(table(spark, sf, "customer"), line, [*PREAMBLE[:6], 'Range=["open', '"c_custkey",address,note'], "multiline")
    with small_splits(spark):
        raw = delimited.read_delimited(spark, path, skip_rows=7, multi_line=True)
        return stage(raw.withColumn("c_custkey", coerce.to_long("c_custkey")), "multiline")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def tsv_scan(spark, sf):
    line = csv_line("c_custkey", "c_name", "c_mktsegment", sep="\t")
    path = headed_files(table(spark, sf, "customer"), line, ["c_custkey\tc_name\tc_mktsegment"], "customer")
    return delimited.read_tsv(spark, path).withColumn("c_custkey", coerce.to_long("c_custkey"))


@query("SELECT c_name AS \"SKU\", CAST(c_custkey AS VARCHAR) AS \"Asin\" FROM customer WHERE c_mktsegment = 'BUILDING'")
def sheet_active(spark, sf):
    """A sheet with two lines above its real header, reduced to its active rows."""
    status = F.when(F.col("c_mktsegment") == "BUILDING", "Active").otherwise("Closed")
    line = csv_line(status.alias("s"), F.col("c_name"), F.col("c_custkey"))
    head = ["Key sheet,,", "status,ids,ids", "Status,SKU,Asin"]
    path = headed_files(table(spark, sf, "customer"), line, head, "sheet")
    return filters.matching(delimited.read_sheet(spark, path, header_row=2), Status="Active").select("SKU", "Asin")


@query("SELECT p_partkey, true AS labelled FROM part")
def file_labels(spark, sf):
    """Rows labelled by the metadata line of their file."""
    part = table(spark, sf, "part").withColumn("file", F.concat(F.lit("Brand "), F.spark_partition_id().cast("string")))
    head = F.concat(F.lit('Brand=["'), F.col("file"), F.lit('"],Range=[1]'))
    path = headed_files(part, csv_line("p_partkey", "file"), [head, "p_partkey,brand"], "labels")
    rows = delimited.read_delimited(spark, path, skip_rows=1, path_column="path")
    labelled = rows.join(lines.file_labels(spark, path, "Brand"), "path")
    return labelled.select(coerce.to_long("p_partkey").alias("p_partkey"), (F.col("brand") == F.col("label")).alias("labelled"))


@query("SELECT o_orderkey AS order_key, o_orderdate AS start_date, o_totalprice AS cost, o_orderstatus AS ad_status_14d FROM orders")
def json_array_gz(spark, sf):
    """Gzipped JSON arrays with camel-case keys."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderKey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("startDate"),
        F.col("o_totalprice").alias("cost"), F.col("o_orderstatus").alias("adStatus14D"),
    )
    path = framed_files(orders, F.to_json(F.struct("*")), "[", "]", ",", "campaign", compression="gzip")
    schema = T.StructType.fromDDL("orderKey bigint, startDate string, cost double, adStatus14D string")
    rows = documents.array_records(spark, path, schema)
    return rows.withColumn("start_date", coerce.to_timestamp("start_date"))


@query("""
SELECT o_orderkey AS order_key, o_orderstatus AS status, '{"' || o_orderpriority || '\\' AS note, o_totalprice AS price FROM orders
""")
def json_array_split(spark, sf):
    """One-line JSON arrays cut into splits; nested objects, and braces, brackets and escapes in strings."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderKey"), F.col("o_orderstatus").alias("status"),
        F.concat(F.lit('{"'), F.col("o_orderpriority"), F.lit("\\")).alias("note"),
        F.struct(F.struct(F.col("o_totalprice").alias("amount")).alias("total"), F.array(F.lit("]}")).alias("marks")).alias("price"),
    )
    path = array_files(orders, F.to_json(F.struct("*")), "arrays")
    schema = T.StructType.fromDDL("orderKey bigint, status string, note string, price struct<total struct<amount double>>")
    with small_splits(spark):
        rows = names.rename_all(spans.array_members(spark, path, schema), names.snake_case)
        return stage(rows.withColumn("price", F.col("price.total.amount")), "arrays")


@query(search_sql())
def json_search_records(spark, sf):
    """Search-performance documents, gzipped: the records under one named path."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    path = framed_files(
        search_records(table(spark, sf, "lineitem")), record, '{"spec": {"a": [1]}, "dataByAsin": [', "]}", ",", "search", compression="gzip"
    )
    rows = documents.named_records(documents.read_documents(spark, path), documents.SEARCH_RECORDS, search_schema())
    return nested.search_performance(rows, F.col("asin"), F.lit("1998-06-13").cast("date"))


@query("SELECT event_id, value, event_type FROM events")
def json_documents(spark, sf):
    """Documents of unknown shape: a list, an object with lists, a plain object."""
    body = F.to_json(F.struct("event_id", "value", "event_type"))
    kind = F.col("event_type")
    document = (
        F.when(kind == "click", F.concat(F.lit(" ["), body, F.lit("]")))
        .when(kind == "view", F.concat(F.lit('{"note": "[x]", "n": 1, "zrows": ['), body, F.lit('], "arows": [{"event_id": -1}]}')))
        .otherwise(body)
    )
    path = scratch_path(spark, "documents")
    table(spark, sf, "events").select(document.alias("value")).write.text(path)
    docs = documents.read_documents(spark, path, per_line=True)
    return documents.generic_records(docs, T.StructType.fromDDL("event_id bigint, value double, event_type string"))


@query("SELECT event_id, event_type, user_id FROM events")
def json_or_tsv(spark, sf):
    """Documents announced as JSON that may be TSV instead."""
    body = F.to_json(F.struct("event_id", "event_type", "user_id"))
    tabs = F.concat(F.lit("event_type\tuser_id\tevent_id\n"), F.concat_ws("\t", "event_type", _text("user_id"), _text("event_id")))
    docs = table(spark, sf, "events").select(F.when(F.col("event_type") == "view", tabs).otherwise(body).alias("document"))
    good = F.coalesce(documents.is_json("document"), F.lit(False))
    schema = T.StructType.fromDDL("event_id bigint, event_type string, user_id bigint")
    tsv = documents.tab_records(docs.where(~good), ["event_id", "event_type", "user_id"])
    typed = tsv.select(coerce.to_long("event_id").alias("event_id"), "event_type", coerce.to_long("user_id").alias("user_id"))
    return documents.generic_records(docs.where(good), schema).unionByName(typed)


@query("""
SELECT o_orderkey AS order_key, o_orderdate AS updated FROM orders WHERE o_orderdate >= DATE '1998-05-16'
""")
def recent_orders(spark, sf):
    """Orders updated in the 30 days before 15 June 1998 or later, from order documents."""
    orders = table(spark, sf, "orders").select(
        F.to_json(F.struct(F.array(F.struct(F.col("o_orderkey").alias("order_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"))).alias("Orders"))).alias("document")
    )
    schema = T.StructType.fromDDL("order_key bigint, updated string")
    recent = documents.recent_orders(orders, schema, "updated", F.lit("1998-06-15").cast("date"))
    return recent.withColumn("updated", coerce.to_timestamp("updated"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(p_retailprice AS VARCHAR) AS price,
       p_brand AS leaf, CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS box_size
FROM part
""")
def xml_rows(spark, sf):
    """XML files: rows below other elements, attributes, a text leaf, rows in comments, CDATA, trailing text."""
    size = F.when(F.col("p_size") > 25, F.concat(F.lit('<box size=""'), _text("p_size"), F.lit('""/>'))).otherwise(F.lit("<box/>"))
    row = F.concat(
        F.lit('<!-- <Node id=""0""><name>old</name></Node> --><Node id=""'), _text("p_partkey"), F.lit('""><name><![CDATA['), F.col("p_name"),
        F.lit(']]></name><note><![CDATA[</Node><Node>]]></note><price currency=""USD"">'),
        _text("p_retailprice"), F.lit("</price>"), size, F.lit("<sub><leaf>"), F.col("p_brand"), F.lit("</leaf></sub></Node>"),
    )
    path = framed_files(
        table(spark, sf, "part"), row, "<?xml version=\"1.0\"?>\n<Report><Body>", "</Body></Report>\ntrailing <text>", "", "xml"
    )
    schema = T.StructType.fromDDL(
        "_id string, name string, price struct<_VALUE string, _currency string>, box struct<_size string>, sub struct<leaf string>"
    )
    rows = documents.xml_records(documents.read_documents(spark, path), schema)
    return rows.select("id", "name", "price", "leaf", "box_size")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer_ref, 'USD' AS total_currency
FROM orders
""")
def xml_row_files(spark, sf):
    """Large XML files, split between tasks by their row element."""
    row = F.concat(
        F.lit('<Row id="'), _text("o_orderkey"), F.lit('"><status>'), F.col("o_orderstatus"), F.lit('</status><customer ref="'),
        _text("o_custkey"), F.lit('"/><total currency="USD"/></Row>'),
    )
    path = framed_files(table(spark, sf, "orders"), row, "<Rows>\n", "\n</Rows>", "\n", "xmlrows")
    schema = T.StructType.fromDDL("_id string, status string, customer struct<_ref string>, total struct<_currency string>")
    return documents.xml_files(spark, path, "Row", schema)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_export(spark, sf):
    """Rows exported as CSV and read back."""
    path = scratch_path(spark, "export")
    sinks.export_csv(table(spark, sf, "supplier").drop("s_nationkey"), path)
    back = delimited.read_delimited(spark, path)
    return projections.conform(back, projections.contract(s_suppkey="long", s_name="string", s_acctbal="double"))


@query("SELECT * FROM events")
def json_export(spark, sf):
    """Rows exported as JSON lines, times as text, and read back."""
    path = scratch_path(spark, "export")
    events = table(spark, sf, "events")
    sinks.export_json(events, path)
    kept = [f"{n} {'string' if k == 'timestamp_ntz' else k}" for n, k in events.dtypes]
    back = spark.read.schema(", ".join(kept)).json(path)
    return back.select(*[F.col(n).cast(k) for n, k in events.dtypes])


@query("SELECT COUNT(*) AS rows, COUNT(DISTINCT event_type) AS files FROM events")
def listed_files(spark, sf):
    """Files written per event type, listed by name and counted with their rows."""
    path = scratch_path(spark, "listing")
    table(spark, sf, "events").write.partitionBy("event_type").parquet(path)
    files = lines.listed_files(spark, path).select(F.regexp_extract("path", "event_type=([a-z]+)/", 1).alias("kind"))
    kinds = files.agg(F.countDistinct("kind").alias("files"))
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.select("rows", kinds.scalar().alias("files"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def paged_files(spark, sf):
    """Pages of a report, one folder per status, as a single batch."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "pages")
    orders.withColumn("page", F.col("o_orderstatus")).write.partitionBy("page").option("header", True).csv(path)
    raw = delimited.read_delimited(spark, f"{path}/page=*")
    return projections.conform(raw, projections.contract(o_orderkey="long", o_custkey="long", o_orderstatus="string"))


@query("SELECT o_orderkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS position FROM orders")
def sheet_positions(spark, sf):
    """Every row of a sheet in several files, which many tasks write and read, has its position."""
    orders = table(spark, sf, "orders").select("o_orderkey").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    path = headed_files(orders, csv_line("o_orderkey"), ["o_orderkey"], "positions")
    with small_splits(spark):
        sheet = delimited.row_positions(spark, path, continued=True)
        return stage(sheet.select(coerce.to_long("o_orderkey").alias("o_orderkey"), "position"), "positions")
