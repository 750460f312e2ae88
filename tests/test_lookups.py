import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketflow.operators import filters, lookups, messages


def at(seconds):
    return dt.datetime(2025, 6, 1) + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_within_against_brute_force(spark, seed):
    rng = random.Random(seed)
    asked = [(i, rng.choice("ab"), at(rng.randrange(600))) for i in range(60)]
    told = [(rng.choice("abc"), at(rng.randrange(600)), f"{i:06d}") for i in range(60)]
    want = []
    for i, key, t in asked:
        seen = [(m[1], m[2]) for m in told if m[0] == key and t - dt.timedelta(seconds=60) < m[1] <= t]
        want.append((i, key, t, max(seen)[1] if seen else None))
    requests = spark.createDataFrame(asked, "id int, phone string, asked_at timestamp_ntz")
    codes = spark.createDataFrame(told, "phone string, created_at timestamp_ntz, otp_code string")
    got = lookups.latest_within(requests, codes, "phone", "asked_at", "created_at", ["otp_code"], 60)
    assert rows(got) == sorted(want, key=repr)


def test_latest_within_bounds(spark):
    requests = spark.createDataFrame([(1, "a", at(100))], "id int, phone string, asked_at timestamp_ntz")
    for offset, seen in ((0, True), (-59, True), (-60, False), (1, False)):
        codes = spark.createDataFrame([("a", at(100 + offset), "123456")], "phone string, created_at timestamp_ntz, otp_code string")
        found = lookups.latest_within(requests, codes, "phone", "asked_at", "created_at", ["otp_code"], 60).first()
        assert (found["latest_otp_code"] == "123456") is seen


def test_latest_code(spark):
    codes = spark.createDataFrame(
        [("a", "111111", at(0)), ("a", "222222", at(30)), ("a", "333333", at(90)), ("b", "444444", at(0))],
        "phone string, otp_code string, created_at timestamp_ntz",
    )
    now = F.lit(str(at(60))).cast("timestamp_ntz")
    assert rows(lookups.latest_code(codes, "phone", "otp_code", "created_at", now)) == [("a", "222222")]


def test_effective_keys(spark):
    day = dt.date
    usage = spark.createDataFrame(
        [("m", day(2025, m, 5), "cur") for m in range(1, 6)] + [("none", day(2025, 1, 1), "cur")], "model string, used date, current string"
    )
    restarts = spark.createDataFrame(
        [("m", day(2025, 2, 10), "A", "B"), ("m", day(2025, 4, 1), "B", "C")], "model string, restart_date date, old_id string, new_id string"
    )
    got = lookups.effective_keys(usage, restarts, "model", "used", "current")
    found = {}
    for model, month, key in rows(got):
        found.setdefault((model, month.month), []).append(key)
    assert found == {
        ("m", 1): ["A"], ("m", 2): ["A", "B"], ("m", 3): ["B"], ("m", 4): ["B", "C"], ("m", 5): ["C"], ("none", 1): ["cur"],
    }


def test_gaps_complement_what_is_present(spark):
    expected = [dt.date(2025, 6, 7), dt.date(2025, 6, 14), dt.date(2025, 6, 21)]
    keys = spark.createDataFrame([("a", "A1"), ("b", "B1"), ("c", "C1")], "sku string, asin string")
    present = spark.createDataFrame(
        [("a", dt.datetime(2025, 6, 14, 8)), ("a", dt.datetime(2025, 6, 15)), ("b", dt.datetime(2025, 6, 7)), ("b", dt.datetime(2025, 6, 14)), ("b", dt.datetime(2025, 6, 21)), ("z", dt.datetime(2025, 6, 7))],
        "sku string, reporting_date timestamp_ntz",
    )
    gaps = lookups.missing_periods(keys, present, "sku", "reporting_date", expected)
    assert rows(gaps) == [("a", "A1", [expected[0], expected[2]]), ("c", "C1", expected)]


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None)], "k string, pos int, v string")
    assert rows(lookups.latest_per_key(df, ["k"], ["pos"])) == [("a", 3, "y"), ("b", 2, None)]
    assert rows(filters.first_per_key(df, "k", "pos")) == [("a", 1, "x"), ("b", 2, None)]
    assert lookups.latest_row(df, ["pos"]).first()["v"] == "y"


def test_lookup_fallback(spark):
    df = spark.createDataFrame([("a",), ("b",)], "sku string")
    table = spark.createDataFrame([("a", "A1")], "sku string, asin string")
    assert rows(lookups.lookup(df, table, ["sku"], {"asin": F.lit("?")})) == [("a", "A1"), ("b", "?")]


def test_optional_filters(spark):
    df = spark.createDataFrame([("1", "s", "c"), ("2", "s", None)], "user_id string, service string, category string")
    assert filters.matching(df, service="s", category=None, user_id="").count() == 2
    assert filters.matching(df, service="s", category="c").count() == 1


def test_failed_recent_includes_both_ends(spark):
    tasks = spark.createDataFrame([("failed", at(0)), ("failed", at(3600)), ("failed", at(3601)), ("stopped", at(10))], "status string, created_at timestamp_ntz")
    assert filters.failed_recent(tasks, at(3600)).count() == 2


def test_month_pages_stop_at_the_first_page_without_either(spark):
    pages = [(0, "Jun 3"), (1, "Jun 1"), (1, "May 9 and Jun"), (2, "May 1"), (3, "Apr 2"), (4, "May 8"), (1, "May 2")]
    df = spark.createDataFrame(pages, "page int, line string")
    got = filters.month_pages(df, "page", "line", "Jun", "May")
    assert [(r["page"], r["kept"]) for r in got.orderBy("page").collect()] == [(0, False), (1, True), (2, True), (3, False), (4, False)]
    assert filters.month_pages(df, "page", "line", "Jun", "May", max_pages=2).where("kept").count() == 1


def test_row_slice(spark):
    df = spark.range(1000).repartition(7)
    assert [r[0] for r in filters.row_slice(df, "id", 98).orderBy("id").limit(2).collect()] == [98, 99]
    assert filters.row_slice(df, "id", 98).count() == 902
    assert filters.row_slice(df, "id", 0, 99).count() == 100
    assert filters.row_slice(df, "id", 5000).count() == 0
    assert filters.row_slice(df, "id", 990, 5000).count() == 10


@pytest.mark.parametrize(
    "base, href, target",
    [
        ("https://a.com/x/y?q=1#f", "/z", "https://a.com/z"),
        ("https://a.com/x/y?q=1", "z", "https://a.com/x/z"),
        ("https://a.com/x/", "z?p=2", "https://a.com/x/z?p=2"),
        ("https://a.com", "z", "https://a.com/z"),
        ("https://a.com/x", "?p=2", "https://a.com/x?p=2"),
        ("https://a.com/x", "//b.com/z", "https://b.com/z"),
        ("https://a.com/x", "http://b.com/z", "http://b.com/z"),
        ("https://a.com/x/y/w", "../z", "https://a.com/x/z"),
        ("https://a.com/x/y", "./z", "https://a.com/x/z"),
        ("https://a.com/x/y/", "..", "https://a.com/x/"),
    ],
)
def test_resolved_link(spark, base, href, target):
    found = spark.range(1).select(filters.resolved_link(F.lit(href), F.lit(base)).alias("t")).first()["t"]
    assert found == target


def test_page_links(spark):
    html = '<a href="#top">x</a><a class="k" href="mailto:q@a.com">x</a><A HREF="/ok">x</A><a href="tel:1">x</a><a href="/f.pdf">x</a><a href="https://b.com/">x</a><link href="/css">'
    df = spark.createDataFrame([("https://a.com/p", html)], "url string, html string")
    assert [r["target"] for r in filters.page_links(df).collect()] == ["https://a.com/ok"]
    assert filters.page_links(df, same_host=False).count() == 2
    assert spark.range(1).select(filters.host(F.lit("https://a.com:8080/p")).alias("h")).first()["h"] == "a.com:8080"


def test_expired(spark):
    df = spark.createDataFrame([("a_01_06_2025.log",), ("b_2025-06-06.log",), ("c.log",)], "name string")
    assert [r["name"] for r in filters.expired(df, "name", "2025-06-10").collect()] == ["a_01_06_2025.log"]


def test_message_codes(spark):
    payload = '{"caller_did": "49", "text": "%s"}'
    df = spark.createDataFrame(
        [("SMS", payload % "123456 is it"), ("CALL", payload % "123456"), ("SMS", payload % "12345x"), ("SMS", payload % "77"), ("SMS", "junk"), ("SMS", payload % "")],
        "event string, result string",
    )
    assert rows(messages.message_codes(df)) == [("49", "123456"), ("49", "77")]


def test_listing(spark):
    listing = spark.createDataFrame(
        [
            (1, 16, "B1", "2025-06-01", "2025-06-01", "2025-06-02T23:59:59.9Z"),
            (2, 16, "B1", "2025-06-01", "2025-06-01", "2025-06-02T08:00:00Z"),
            (3, 13, "B2", "2025-06-01", "2025-06-01", "2025-06-02T08:00:00Z"),
            (4, 16, "B2", "2025-06-01", "2025-06-02", "2025-06-02T08:00:00Z"),
            (5, 16, "B2", "2025-06-01", "2025-06-01", "2025-06-03T00:00:00Z"),
            (6, 16, "B9", "2025-06-01", "2025-06-01", "2025-06-02T08:00:00Z"),
        ],
        "id int, reportType int, key string, `from` string, `to` string, createdAt string",
    )
    wanted = spark.createDataFrame([("B1",), ("B2",), ("B1",)], "key string")
    day = F.lit("2025-06-01").cast("date")
    found = filters.listed_reports(listing, wanted, "key", day, F.date_add(day, 1))
    assert sorted(r["id"] for r in found.collect()) == [1, 2]
    assert filters.first_per_key(found, "key", "id").first()["id"] == 1
    ready = spark.createDataFrame([(1, "IN_PROGRESS"), (3, "DONE"), (2, "DONE")], "pos int, processingStatus string")
    assert filters.first_ready(ready, "pos").first()["pos"] == 2


def test_null_keys_have_no_latest(spark):
    import datetime as dt

    requests = spark.createDataFrame([(None, dt.datetime(2025, 6, 1, 10)), ("p", dt.datetime(2025, 6, 1, 10))], "phone string, at timestamp_ntz")
    told = spark.createDataFrame([(None, "1", dt.datetime(2025, 6, 1, 10)), ("p", "2", dt.datetime(2025, 6, 1, 10))], "phone string, code string, made timestamp_ntz")
    got = lookups.latest_within(requests, told, "phone", "at", "made", ["code"], 60).collect()
    assert {r["phone"]: r["latest_code"] for r in got} == {None: None, "p": "2"}
