import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketflow.functions import coerce


def values(spark, items, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_to_long(spark):
    items = ["12", " 12 ", "-3", "12.0", "12.", "1e3", "2.5e1", "12.5", "1,234", "5d", "", None, "9223372036854775807", "99999999999999999999", "inf", "0x10"]
    assert values(spark, items, coerce.to_long) == [
        12, 12, -3, 12, 12, 1000, 25, None, None, None, None, None, 9223372036854775807, None, None, None,
    ]


def test_to_long_of_doubles(spark):
    assert values(spark, [1.0, 2.5, 3e10, None], coerce.to_long, "double") == [1, None, 30000000000, None]


def test_number(spark):
    items = ["1.5", ".5", "5.", "+5", "-.5e-1", "5d", "5f", "NaN", "1_0", "e5", "-", "0x1p3", "--1"]
    assert values(spark, items, coerce.number) == [1.5, 0.5, 5.0, 5.0, -0.05] + [None] * 8
    assert values(spark, ["inf", "-Infinity"], coerce.number) == [math.inf, -math.inf]


def test_money_and_percent(spark):
    items = ["5%", "1,200%", "$3"]
    assert values(spark, items, lambda c: coerce.to_double(c, F.lit(True))) == [5.0, None, None]
    assert values(spark, ["$1,234.50", "7", "-$2", "x", "nan"], lambda c: coerce.to_double(c, F.lit(False))) == [1234.5, 7.0, -2.0, None, None]


def test_has_percent(spark):
    df = spark.createDataFrame([("a", None), ("5%", None)], "x string, y string")
    assert df.agg(coerce.has_percent("x"), coerce.has_percent("y")).first()[:] == (True, False)


def test_to_text(spark):
    assert values(spark, ["a", "nan", "None", "NaT", "<NA>", None], coerce.to_text) == ["a", None, None, "NaT", "<NA>", None]


def test_to_flag(spark):
    assert values(spark, ["True", "1", "False", "0", "true", "1.0", "yes", None], coerce.to_flag) == [True, True, False, False, None, None, None, None]
    assert values(spark, [1, 0, 2], coerce.to_flag, "int") == [True, False, None]
    assert values(spark, [1.0, 0.0], coerce.to_flag, "double") == [True, False]
    assert values(spark, [True, False], coerce.to_flag, "boolean") == [True, False]


def test_timestamps(spark):
    items = ["2025-09-01", "2025-09-01 10:11:12", "2025-09-01T10:11:12.5", "09/01/2025", "20260", "soon", None]
    assert values(spark, items, lambda c: coerce.to_timestamp(c, ("MM/dd/yyyy",))) == [
        dt.datetime(2025, 9, 1), dt.datetime(2025, 9, 1, 10, 11, 12), dt.datetime(2025, 9, 1, 10, 11, 12, 500000),
        dt.datetime(2025, 9, 1), None, None, None,
    ]


def test_postal(spark):
    items = ["12345.0", "01234", "12345-6789", "12345-6789.0", "K1A 0B1", "1.2.3", "A.0", None]
    assert values(spark, items, coerce.postal) == ["12345", "01234", "12345-6789", "12345-6789", "K1A 0B1", "1.2.3", "A.0", None]


def test_yes_no(spark):
    assert values(spark, ["Yes", "No", "yes", None], coerce.yes_no) == [True, False, None, None]


def test_numbers_in_text(spark):
    assert values(spark, ["Top, Week  23 of", "Week of 3", None], coerce.week_number) == [23, None, None]
    assert values(spark, ["a: b: 7 ", "12", "week:", "x: y", None], coerce.trailing_number) == [7, 12, 53, 53, 53]


def test_file_name_date(spark):
    items = ["awd_04_06_2025.csv", "app.2025-06-04.log", "x_45_13_2025_2025-06-04", "none", "x_31_02_2025"]
    assert values(spark, items, coerce.file_name_date) == [
        dt.date(2025, 6, 4), dt.date(2025, 6, 4), dt.date(2025, 6, 4), None, None,
    ]


def test_periods_in_text(spark):
    assert values(spark, ["06/01/2025-06/07/2025", "x"], coerce.period_start) == [dt.date(2025, 6, 1), None]
    assert values(spark, ["2025-05-31T08:40:53.485Z", "bad"], coerce.utc_day) == [dt.date(2025, 5, 31), None]


@pytest.mark.parametrize("empty, expected", [([], True)])
def test_all_of_nothing(spark, empty, expected):
    assert spark.range(1).select(coerce.all_of(empty)).first()[0] is expected


def test_spelled_dates(spark):
    import datetime as dt

    texts = {
        "06/15/2024": dt.datetime(2024, 6, 15), "15 Jun 2024": dt.datetime(2024, 6, 15), "Jan 5, 2025 12:03:15 AM PST": dt.datetime(2025, 1, 5, 0, 3, 15),
        "Jan 5, 2025": dt.datetime(2025, 1, 5), "6/5/2024 13:02": dt.datetime(2024, 6, 5, 13, 2), "Jan 5, 2025 1:03:15 PM": dt.datetime(2025, 1, 5, 13, 3, 15),
        "2025-01-05 10:00:00 UTC": dt.datetime(2025, 1, 5, 10), "soon": None, "13/45/2024": None, "": None, "May": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", coerce.to_timestamp("t").alias("at"))
    assert {r["t"]: r["at"] for r in frame.collect()} == texts


def test_the_usual_spellings_read_like_any_other(spark):
    texts = [
        "2024-01-05", "2024-01-05 10:11:12", "2024-01-05T10:11:12Z", "2024-01-05 10:11:12 PST", "2024-01-05 PST\n", " 2024-01-05 ", "2024-13-05", "2024-",
        "1/5/2024", "01/05/2024", "13/45/2024", "1/5/2024 ", "1/5/2024\n", "1/5/20245", "Jan 5, 2024", "5 Jan 2024",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    # A given pattern that nothing matches leaves the quick ways out.
    both = df.select("t", coerce.to_timestamp("t").alias("quick"), coerce.to_timestamp("t", ("yyyy_MM",)).alias("slow"), F.trim("t").rlike(coerce.DATE_START).alias("start"))
    for row in both.collect():
        assert row["quick"] == row["slow"], row["t"]
        assert row["start"] or row["quick"] is None, row["t"]
