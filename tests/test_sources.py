import datetime as dt
import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from marketflow.operators import filters
from marketflow.plans import source_queries
from marketflow.session import shared_folder
from marketflow.sources import delimited, documents, lines, tables


def test_preamble_in_several_files(spark, land, folder):
    for i in range(5):
        body = "".join(f"{i},{n},\"a, \"\"b\"\"\"\n" for n in range(10))
        land(f"f{i}.csv", f"p1\n\np3, with comma\nfile,n,text\n{body}\n\n")
    got = delimited.read_delimited(spark, folder, skip_rows=3)
    assert got.columns == ["file", "n", "text"]
    assert got.count() == 50 and got.select("text").distinct().collect()[0][0] == 'a, "b"'


def test_preamble_with_files_cut_into_splits(spark, land, folder):
    """Only a file's first split holds its header; later splits lose no line."""
    for i in range(3):
        land(f"f{i}.csv", "skip me\n" * 7 + "file,n\n" + "".join(f"{i},{n}\n" for n in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        got = delimited.read_delimited(spark, folder, skip_rows=7)
        assert got.rdd.getNumPartitions() > 10
        summary = got.groupBy("file").agg(F.count("*").alias("c"), F.sum(F.col("n").cast("int")).alias("s")).collect()
        assert [(r["c"], r["s"]) for r in summary] == [(20000, 199990000)] * 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_files_with_different_layouts(spark, land, folder):
    land("a.csv", "x,y\n1,2\n")
    land("b.csv", "y,x,z\n4,3,5\n")
    got = delimited.read_delimited(spark, folder)
    assert rows(got.select("x", "y", "z")) == [("1", "2", None), ("3", "4", "5")]


def test_repeated_and_blank_headers(spark, land):
    got = delimited.read_delimited(spark, land("a.csv", "x,x,,y\n1,2,3,4\n"))
    assert got.columns == ["x", "x.1", "Unnamed: 2", "y"] and got.first()[:] == ("1", "2", "3", "4")


def test_null_words_and_byte_order_mark(spark, land):
    got = delimited.read_delimited(spark, land("a.csv", "﻿x,y\nNA,null\nNULL,n/a\n,nan\n none,-\n"))
    assert got.columns == ["x", "y"]
    assert rows(got) == sorted([(None, None)] * 3 + [(" none", "-")], key=repr)


def test_encodings_are_chosen_per_file(spark, land, folder):
    land("utf.csv", "n,t\nutf,“é”\n")
    land("win.csv", b"n,t\nwin,\x93\xe9\x94\nplain,Ab\n")
    land("lat.csv", b"n,t\nlat,\x81\x93\n")
    got = {r["n"]: r["t"] for r in delimited.read_delimited(spark, folder).collect()}
    assert got == {"utf": "“é”", "win": "“é”", "plain": "Ab", "lat": "\x81\x93"}


def test_a_valid_looking_line_of_a_cp1252_file_is_cp1252(spark, land):
    """The whole file decides: C3 A9 is two characters here, although valid UTF-8."""
    got = delimited.read_delimited(spark, land("win.csv", b"t\n\xc3\xa9\n\x80\n"))
    assert {r["t"] for r in got.collect()} == {"Ã©", "€"}


def test_blank_lines_before_the_header(spark, land, folder):
    land("a.csv", "\n \nx,y\n1,2\n")
    land("b.csv", "x,y\n\n3,4\n")
    assert rows(delimited.read_delimited(spark, folder)) == [("1", "2"), ("3", "4")]
    assert delimited.read_delimited(spark, land("c.tsv", "p\n\n\nx,y\n1,2\n"), skip_rows=1).first()[:] == ("1", "2")


def test_no_header(spark, land):
    with pytest.raises(delimited.EmptyReport):
        delimited.read_delimited(spark, land("a.csv", "only\n"), skip_rows=3)


def test_tsv_and_sheet(spark, land):
    assert delimited.read_tsv(spark, land("a.tsv", "x\ty\n1\t2\n")).first()[:] == ("1", "2")
    sheet = delimited.read_sheet(spark, land("s.csv", "title,\ngroup,\nStatus,SKU\nActive,\n"), header_row=2)
    assert sheet.first()[:] == ("Active", "")


def test_row_positions(spark, land):
    path = land("k.csv", "sku,asin\n" + "".join(f"s{i},a{i}\n" for i in range(150)))
    sheet = delimited.row_positions(spark, path)
    assert rows(sheet.where("position between 98 and 99").select("sku")) == [("s98",), ("s99",)]
    assert filters.row_slice(sheet, "position", 98).count() == 52


def test_labels(spark, land, folder):
    land("a.csv", 'Brand=["X y"],Week=[1]\nh\n1\n')
    land("b.csv", "Brand=[Z]\nh\n1\n")
    land("c.csv", "nothing\nh\n1\n")
    labels = {r["path"][-5:]: r["label"] for r in lines.file_labels(spark, folder, "Brand").collect()}
    assert labels == {"a.csv": "X y", "b.csv": "Z", "c.csv": None}


def test_gzipped_json_array(spark, land):
    data = [{"campaignId": 1, "startDate": "2025-06-01"}, {"campaignId": 2}]
    path = land("a.json.gz", gzip.compress(json.dumps(data).encode()))
    got = documents.array_records(spark, path, T.StructType.fromDDL("campaignId bigint, startDate string"))
    assert got.columns == ["campaign_id", "start_date"] and rows(got) == [(1, "2025-06-01"), (2, None)]
    empty = land("b.json.gz", gzip.compress(b"[]"))
    assert documents.array_records(spark, empty, T.StructType.fromDDL("campaignId bigint")).isEmpty()


def docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "document string")


def test_named_records(spark):
    schema = T.StructType.fromDDL("a int")
    found = documents.named_records(docs(spark, '{"dataByAsin": [{"a": 1}, {"a": 2}]}', '{"dataByAsin": []}', "{}"), "dataByAsin", schema)
    assert rows(found) == [(1,), (2,)]


def test_generic_records(spark):
    schema = T.StructType.fromDDL("a int, n string")
    found = documents.generic_records(
        docs(
            spark,
            ' [{"a": 1}]',
            '{"n": "[x]", "m": {"l": [9]}, "rows": [{"a": 2, "n": "q"}], "also": [{"a": 3}]}',
            '{"a": 4, "n": "z"}',
            '{"rows": []}',
        ),
        schema,
    )
    assert rows(found) == [(1, None), (2, "q"), (4, "z")]


def test_scalars_and_non_json(spark):
    mixed = docs(spark, "5", '"x"', "[1]", "{}", "a\tb\n1\t2\n")
    assert rows(documents.scalar_documents(mixed)) == [("5",), ("x",)]
    assert mixed.where(~documents.is_json("document")).count() == 1
    tsv = documents.tab_records(docs(spark, "b\ta\r\n1\t2\r\n\r\n3\t\n", "a\tb\n"), ["a", "b", "c"])
    assert rows(tsv) == sorted([("2", "1", None), (None, "3", None)], key=repr)


def test_recent_orders(spark):
    found = documents.recent_orders(
        docs(spark, '{"Orders": [{"id": 1, "at": "2025-06-01T10:00:00"}, {"id": 2, "at": "2025-04-01T10:00:00"}]}'),
        T.StructType.fromDDL("id int, at timestamp_ntz"), "at", F.lit("2025-06-15").cast("date"),
    )
    assert rows(found.select("id")) == [(1,)]


XML = """<?xml version="1.0"?>
<Report kind=""x""><Body><Record id=""7""><name> a </name><price cur=""USD"">5</price><sub><leaf>q</leaf></sub></Record>
<Record id=""8""><name>b</name></Record></Body></Report> trailing </junk>"""


def test_xml_records(spark, land):
    schema = T.StructType.fromDDL("_id string, name string, price struct<_VALUE string, _cur string>, sub struct<leaf string>")
    found = documents.xml_records(documents.read_documents(spark, land("a.xml", XML)), schema)
    assert found.columns == ["id", "name", "price_cur", "price", "leaf"]
    assert [tuple(r) for r in found.orderBy("id").collect()] == [("7", "a", None, "5", "q"), ("8", "b", None, None, None)]


def test_xml_first_tag_present_counts(spark):
    found = documents.xml_records(docs(spark, "<R><Item><a>1</a></Item><Row><a>2</a></Row></R>", "<R><Item><a>3</a></Item></R>"), T.StructType.fromDDL("a string"))
    assert rows(found) == [("2",), ("3",)]


def test_xml_root_without_rows(spark):
    found = documents.xml_root_record(docs(spark, "<R><a>1</a><b>2</b></R>x"), T.StructType.fromDDL("a string, b string"))
    assert found.first()[:] == ("1", "2")


def test_xml_files_are_split(spark, land):
    body = "".join(f'<Row id="{i}"><v>{i}</v></Row>\n' for i in range(2000))
    path = land("big.xml", f"<Rows>\n{body}</Rows>")
    found = documents.xml_files(spark, path, "Row", T.StructType.fromDDL("_id string, v string"))
    assert found.count() == 2000 and found.where("id <> v").count() == 0


def test_file_listing_reads_no_content(spark, land, folder):
    land("x_01_06_2025.log", "1")
    listing = lines.listed_files(spark, folder)
    assert "content" not in listing.columns
    assert filters.expired(listing, "name", dt.date(2025, 6, 10)).count() == 1


def test_tables(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("mf_source_test")
    assert tables.read_table(spark, "mf_source_test").count() == 3
    assert tables.column_names(spark, "mf_source_test") == ["id"]
    assert tables.stored_contract(spark, "mf_source_test")[0].kind == "long"


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_positions_of_a_sheet_in_many_splits(spark, land, small_splits):
    path = land("k.csv", "sku,asin\n" + "".join(f"s{i},a{i}\n" for i in range(5000)))
    got = delimited.row_positions(spark, path).collect()
    assert len(got) == 5000 and all(r["sku"] == f"s{r['position']}" for r in got)


def test_a_preamble_longer_than_a_split(spark, land, small_splits):
    path = land("k.csv", "".join(f"note {i}\n" for i in range(3000)) + "sku,asin\ns,a\n")
    assert rows(delimited.read_delimited(spark, path, skip_rows=3000)) == [("s", "a")]


def test_a_file_without_header_is_named(spark, land, folder):
    land("a.csv", "p1\np2\np3\nsku\nx\n")
    land("short.csv", "p1\np2\n")
    with pytest.raises(delimited.EmptyReport, match="short.csv"):
        delimited.read_delimited(spark, folder, skip_rows=3)


def test_many_layouts(spark, land, folder):
    for k in range(300):
        land(f"{k}.csv", f"sku,c{k}\ns{k},{k}\n" if k % 2 else f"c{k},sku\n{k},s{k}\n")
    frame = delimited.read_delimited(spark, folder, encoding="utf-8")
    assert len(frame.columns) == 301
    got = {r["sku"]: [v for c, v in r.asDict().items() if c != "sku" and v is not None] for r in frame.collect()}
    assert got == {f"s{k}": [str(k)] for k in range(300)}


def test_xml_comments_cdata_nested_rows_and_children(spark):
    schema = T.StructType.fromDDL("_id string, a string")
    text = '<R><!-- <Row id="0"><a>no</a></Row> --><Row id="1"><a><![CDATA[<Row id="9"> & <!-- x -->]]></a></Row><Row id="2"><a>2</a></Row><Row id="3"/></R>'
    assert rows(documents.xml_records(docs(spark, text), schema)) == [("1", '<Row id="9"> & <!-- x -->'), ("2", "2"), ("3", None)]
    nested = '<R><Row id="1"><a>1</a><Row id="2"><a>2</a></Row><Row id="3"/></Row><Row id="4"><a>4</a></Row></R>'
    assert [r[0] for r in rows(documents.xml_records(docs(spark, nested), schema))] == ["1", "2", "3", "4"]
    plain = T.StructType.fromDDL("_id string, a string, b string")
    assert rows(documents.xml_records(docs(spark, '<R><x id="1"><a>1</a></x><y id="2"><a>2</a><b>3</b></y></R>'), plain)) == [("1", "1", None), ("2", "2", "3")]
    assert rows(documents.xml_records(docs(spark, "<R><a>1</a><b>2</b></R>"), plain)) == [(None, "1", None), (None, None, "2")]
    assert rows(documents.xml_records(docs(spark, '<Row id="5"/>', '<Row><Row id="6"><a>7</a></Row></Row>'), schema)) == [("5", None), ("6", "7")]


def landed_bytes(spark, label):
    """Bytes of the sample files of a label that were written so far."""
    folder = shared_folder(spark).removeprefix("file://") + "/marketflow"
    return sum(f.stat().st_size for p in Path(folder).glob(f"{label}-*") for f in p.rglob("part-*"))


def test_search_documents_land_gzipped(spark):
    before = landed_bytes(spark, "search")
    found = source_queries.json_search_records(spark, "/root/testdata/sf0.001").count()
    assert found and landed_bytes(spark, "search") - before < 150 * found
