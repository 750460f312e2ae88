"""Reporting-period arithmetic over an explicit reference date column."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Period text format, and the last day of a month on which the
# previous month is still reloaded.
PERIOD_FORMAT = "MM/dd/yyyy"
GRACE_DAYS = 3


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("date").alias("start_date"), end.cast("date").alias("end_date"))


def ref(day: date | Column | str) -> Column:
    """A reference date as a column: a date, an ISO text or a column."""
    if isinstance(day, Column):
        return day.cast("date")
    return F.lit(str(day)).cast("date")


def current_month(d: Column) -> Column:
    """First of the month to yesterday; on the first day, to that day."""
    return _span(F.trunc(d, "MM"), F.when(F.dayofmonth(d) == 1, d).otherwise(F.date_sub(d, 1)))


def previous_month(d: Column) -> Column:
    back = F.add_months(d, -1)
    return _span(F.trunc(back, "MM"), F.last_day(back))


def full_year(d: Column) -> Column:
    """January of the previous month's year to the end of the previous month."""
    back = F.add_months(d, -1)
    return _span(F.trunc(back, "YEAR"), F.last_day(back))


def last_week(d: Column) -> Column:
    return _span(F.date_sub(d, 8), F.date_sub(d, 2))


def days_ago(d: Column, days: int) -> Column:
    return _span(F.date_sub(d, days), F.date_sub(d, days))


def trailing_week(d: Column) -> Column:
    return _span(F.date_sub(d, 7), d)


def period_text(span: Column) -> Column:
    """``MM/dd/yyyy-MM/dd/yyyy``."""
    return F.concat(
        F.date_format(span["start_date"], PERIOD_FORMAT), F.lit("-"), F.date_format(span["end_date"], PERIOD_FORMAT)
    )


def last_saturday(d: Column) -> Column:
    """The last Saturday strictly before ``d``."""
    return F.next_day(F.date_sub(d, 8), "SAT")


def search_week(d: Column) -> Column:
    """Sunday to the last Saturday."""
    saturday = last_saturday(d)
    return _span(F.date_sub(saturday, 6), saturday)


def is_gap_day(d: Column) -> Column:
    """Weekly gaps are filled from Monday to Wednesday only."""
    return F.weekday(d).between(0, 2)


def months_between(start: Column, end: Column) -> Column:
    """Array of whole months, as spans, from the month of ``start`` to ``end``."""
    firsts = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    return F.transform(firsts, lambda first: _span(first, F.last_day(first)))


def refetch_days(d: Column, days: int = 7) -> Column:
    """The days, latest last, that are fetched again because they may be restated."""
    return F.sequence(F.date_sub(d, days), F.date_sub(d, 1))


def reload_months(d: Column, previous_only: bool = False) -> Column:
    """Month starts a monthly report reloads on day ``d``, in load order."""
    this = F.trunc(d, "MM").cast("date")
    before = F.trunc(F.add_months(d, -1), "MM").cast("date")
    if previous_only:
        return F.array(before)
    return F.when(F.dayofmonth(d) <= GRACE_DAYS, F.array(this, before)).otherwise(F.array(this))


def in_day(ts: Column, d: Column) -> Column:
    """Half-open filter for the day ``d``; a bare column range, so it is pushed down."""
    return (ts >= d.cast("timestamp_ntz")) & (ts < F.date_add(d, 1).cast("timestamp_ntz"))


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def month_abbreviation(d: Column) -> Column:
    return F.date_format(d, "MMM")


def month_table(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per month from ``start`` to ``end``."""
    return spark.range(1).select(F.inline(months_between(ref(start), ref(end))))
