import datetime as dt

import pytest

from conftest import rows
from marketflow.functions.names import NameCollision
from marketflow.operators import load
from marketflow.plans import reports
from marketflow.session import stage


def test_families():
    assert reports.family("sponsored_brands_campaign").keys == ("campaign_id", "start_date", "end_date")
    assert reports.family("transaction").skip_rows == 7
    with pytest.raises(KeyError):
        reports.family("unknown")


def test_empty_batch_is_no_load(spark, land):
    path = land("a.csv", "sku,units\n")
    target = spark.createDataFrame([("a", 1)], "sku string, units bigint")
    outcome = reports.load_report(spark, reports.family("promotions"), path, target, "2025-06-02")
    assert not outcome.loaded and outcome.state is target


def test_stored_schema_rules_later_batches(spark, land):
    report = reports.family("promotions")
    first = reports.load_report(spark, report, land("a.csv", "Sku,Unit Price,When\nx,$5,2025-06-01\n"), None, "2025-06-02")
    assert first.state.dtypes == [("sku", "string"), ("unit_price", "string"), ("when", "timestamp_ntz")]
    second = reports.load_report(spark, report, land("b.csv", "Sku,When,Extra\ny,soon,1\nx,2025-06-01,2\n"), first.state, "2025-06-03")
    assert second.dropped == ("extra",)
    assert rows(second.state) == [("x", "$5", dt.datetime(2025, 6, 1)), ("x", None, dt.datetime(2025, 6, 1)), ("y", None, None)]


def test_stamps_by_report(spark, land):
    path = land("a.csv", "l1\nl2\nl3\nSku,Units\nx,1\n")
    stamped = reports.load_report(spark, reports.family("inventory"), path, None, "2025-06-02").state
    assert stamped.first()[:] == (dt.datetime(2025, 6, 2), "x", 1)
    plain = land("b.csv", "Sku,Units\nx,1\n")
    weekly = reports.load_report(spark, reports.family("sales_traffic_weekly"), plain, None, "2025-06-10", period="06/02/2025-06/08/2025").state
    assert weekly.columns == ["period", "sku", "units"]
    api = land("c.tsv", "sellerSku\tunits7d\nx\t1\n")
    assert reports.load_report(spark, reports.family("seller_api"), api, None, "2025-06-02").state.first()[:] == (dt.datetime(2025, 6, 1), "x", 1)


def test_competitors_sheet(spark, land):
    path = land("a.csv", "Sku,Price,Sku,\nx,NA,y,1\nz,,w,2\n")
    raw = reports.scan_report(spark, reports.family("competitors"), path)
    assert raw.columns == ["Sku", "Price", "Unnamed: 3"] and raw.first()[:] == ("x", "NA", "1")
    state = reports.load_report(spark, reports.family("competitors"), path, None, "2025-06-10", period="p").state
    assert state.columns == ["period", "sku", "price", "unnamed_3"]


def test_colliding_headers_are_an_error(spark, land):
    with pytest.raises(NameCollision):
        reports.load_report(spark, reports.family("promotions"), land("a.csv", "a b,a-b\n1,2\n"), None, "2025-06-02")


def test_unknown_sources_and_lost_dates(spark, land):
    import dataclasses

    with pytest.raises(ValueError):
        reports.scan_report(spark, dataclasses.replace(reports.family("promotions"), source="odd"), "x")
    path = land("a.csv", "p\n" * 7 + "Order ID,Date / Time,Total\n1,\"Jan 5, 2025 12:03:15 AM PST\",1\n2,whenever,1\n")
    outcome = reports.load_report(spark, reports.family("transaction"), path, None, "2025-02-01")
    assert outcome.nulled == (("date_time", 1),)
    assert sorted(str(r["date_time"]) for r in outcome.state.collect()) == ["2025-01-05 00:03:15", "None"]


def test_a_batch_of_stored_types_is_staged_once(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(reports, "stage", lambda df, label: staged.append(df.columns) or stage(df, label))
    monkeypatch.setattr(load, "stage", lambda df, label: staged.append(df.columns) or stage(df, label))
    raw = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "sku string, units long")
    target = spark.createDataFrame([("x", 1)], "sku string, units long")
    report = reports.family("promotions")
    assert rows(reports.load_batch(report, raw, target, "2025-06-02").state) == [("x", 1), ("y", 2)]
    assert staged.count(["sku", "units"]) == 1
    assert not reports.load_batch(report, raw.limit(0), target, "2025-06-02").loaded
    clashing = raw.toDF("a b", "a-b")
    assert not reports.load_batch(report, clashing.limit(0), target, "2025-06-02").loaded
    with pytest.raises(NameCollision):
        reports.load_batch(report, clashing, target, "2025-06-02")
