import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketflow.functions import periods
from marketflow.plans import reports


def day(text):
    return dt.date.fromisoformat(text)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def span(spark, rule, d):
    found = one(spark, rule(periods.ref(d)))
    return str(found["start_date"]), str(found["end_date"])


@pytest.mark.parametrize(
    "rule, d, expected",
    [
        (periods.current_month, "2025-06-15", ("2025-06-01", "2025-06-14")),
        (periods.current_month, "2025-06-01", ("2025-06-01", "2025-06-01")),
        (periods.previous_month, "2025-01-01", ("2024-12-01", "2024-12-31")),
        (periods.previous_month, "2024-03-31", ("2024-02-01", "2024-02-29")),
        (periods.full_year, "2025-01-10", ("2024-01-01", "2024-12-31")),
        (periods.full_year, "2025-06-10", ("2025-01-01", "2025-05-31")),
        (periods.last_week, "2025-06-10", ("2025-06-02", "2025-06-08")),
        (periods.trailing_week, "2025-06-10", ("2025-06-03", "2025-06-10")),
        # 2025-06-14 is a Saturday
        (periods.search_week, "2025-06-14", ("2025-06-01", "2025-06-07")),
        (periods.search_week, "2025-06-15", ("2025-06-08", "2025-06-14")),
        (periods.search_week, "2025-06-16", ("2025-06-08", "2025-06-14")),
    ],
)
def test_spans(spark, rule, d, expected):
    assert span(spark, rule, d) == expected


def test_gap_days(spark):
    week = [one(spark, periods.is_gap_day(periods.ref(f"2025-06-{d}"))) for d in range(16, 23)]
    assert week == [True, True, True, False, False, False, False]


def test_lists(spark):
    assert one(spark, periods.refetch_days(periods.ref("2025-06-10"))) == [day(f"2025-06-0{d}") for d in range(3, 10)]
    months = one(spark, periods.months_between(periods.ref("2024-12-15"), periods.ref("2025-02-01")))
    assert [(str(m[0]), str(m[1])) for m in months] == [
        ("2024-12-01", "2024-12-31"), ("2025-01-01", "2025-01-31"), ("2025-02-01", "2025-02-28"),
    ]
    assert one(spark, periods.reload_months(periods.ref("2025-06-03"))) == [day("2025-06-01"), day("2025-05-01")]
    assert one(spark, periods.reload_months(periods.ref("2025-06-04"))) == [day("2025-06-01")]
    assert one(spark, periods.reload_months(periods.ref("2025-06-04"), True)) == [day("2025-05-01")]
    assert periods.month_table(spark, "2025-08-01", "2025-09-30").count() == 2


def test_period_text(spark):
    assert one(spark, periods.period_text(periods.trailing_week(periods.ref("2025-06-10")))) == "06/03/2025-06/10/2025"


def test_names(spark):
    assert one(spark, periods.month_name(periods.ref("2025-09-10"))) == "September"
    assert one(spark, periods.month_abbreviation(periods.ref("2025-09-10"))) == "Sep"


def test_every_report_period_is_defined(spark):
    days = spark.range(1).select(periods.ref("2025-06-02").alias("d"))
    covered = reports.covered_periods(days, "d")
    assert {r.period for r in reports.REPORTS.values()} - {""} <= set(reports.COVERED)
    assert covered.where("report = 'transaction'").count() == 2
    assert covered.where("report = 'sponsored_campaign'").count() == 7
    assert covered.where(F.col("start_date") > F.col("end_date")).count() == 0
