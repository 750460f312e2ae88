"""Text-to-typed column expressions. Bad input becomes null, never an error."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of finite numbers, the words for infinite ones, the
# default week when a description carries none, the week in a page title, and the dates
# in file names, in the order they are tried.
WHOLE = r"^[+-]?[0-9]+$"
WHOLE_WITH_POINT = r"^[+-]?[0-9]+\.0*$"
FINITE = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"
DEFAULT_WEEK = 53
WEEK_TITLE = r"Week\s+(\d+)"
FILE_DATES = (
    (r"(\d{2}_\d{2}_\d{4})", "dd_MM_yyyy"),
    (r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"),
)

_LONG_EDGE = float(2**63)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there.

    Also when Spark puts the expression in place of a column that a filter names: the expression stays as large as it is written.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def number(c: Column | str) -> Column:
    """Double from numeric text; Spark's own cast would also accept ``5d`` and ``NaN``."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(FINITE) | text.rlike(INFINITE), text.try_cast("double"))


def to_long(c: Column | str) -> Column:
    """Whole numbers (also written ``12.0`` or ``1e3``) to long; fractions to null."""
    text = F.trim(_col(c).cast("string"))
    value = number(text)
    whole = (value == F.floor(value)) & (value >= -_LONG_EDGE) & (value < _LONG_EDGE)
    return (
        F.when(text.rlike(WHOLE), text.try_cast("long"))
        .when(text.rlike(WHOLE_WITH_POINT), F.substring_index(text, ".", 1).try_cast("long"))
        .when(F.contains(F.lower(text), F.lit("e")) & whole, value.try_cast("long"))
    )


def has_percent(c: Column | str) -> Column:
    """Aggregate: does any value of the column carry a percent sign?"""
    return F.coalesce(F.max(F.contains(_col(c).cast("string"), F.lit("%"))), F.lit(False))


def to_double(c: Column | str, percent: Column) -> Column:
    """Money or percent text to double.

    ``percent`` tells whether the whole column is a percent column: then only
    the percent sign is removed; otherwise dollar signs and thousands commas.
    """

    def without(text: Column, mark: str) -> Column:
        return F.replace(text, F.lit(mark), F.lit(""))

    text = _col(c).cast("string")
    return F.when(percent, number(without(text, "%"))).otherwise(number(without(without(text, "$"), ",")))


def to_text(c: Column | str) -> Column:
    """String, with the missing-value words ``nan`` and ``None`` as null."""
    text = _col(c).cast("string")
    return F.when(~text.isin("nan", "None"), text)


def to_flag(c: Column | str) -> Column:
    """``True``/``1`` and ``False``/``0``; anything else, also the text ``true``, is null."""
    source = _col(c)
    text, is_text = source.cast("string"), F.typeof(source) == "string"
    yes = F.when(is_text, text.isin("True", "1")).otherwise(text.isin("true", "1", "1.0"))
    no = F.when(is_text, text.isin("False", "0")).otherwise(text.isin("false", "0", "0.0"))
    return F.when(yes, True).when(no, False)


def yes_no(c: Column | str) -> Column:
    return F.when(_col(c) == "Yes", True).when(_col(c) == "No", False)


# Spellings of dates in report files besides ISO; months come before days. Their shapes, with 9 for digits and
# A for letters, differ, so the shape of a text tells which one to try.
DATE_FORMATS = (
    "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a", "d MMM yyyy", "d MMM yyyy H:mm:ss",
    "MMM d, yyyy", "MMM d, yyyy H:mm:ss", "MMM d, yyyy h:mm a", "MMM d, yyyy h:mm:ss a",
)
_SPELLED = r"^(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2} [A-Za-z]{3} [0-9]{4}|[A-Za-z]{3} [0-9]{1,2}, [0-9]{4})"
# What every text that reads as a date or time begins with.
DATE_START = r"^(?:[+-]?[0-9]{4}|[0-9]{1,2}[/ ]|[A-Za-z]{3} )"
# The two spellings nearly all files have. Texts of these forms read the same way as any other, only without the dear steps.
_ISO_DAY = r"^[0-9]{4}-.*[^A-Z\s]\z"
_SLASHED_DAY = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
# A zone word after the time; times stay local to it.
_ZONE_WORD = r"(?<=[0-9apmAPM])\s+(?!(?i:am|pm)$)[A-Z]{2,5}$"


def _shape(pattern: str) -> str:
    return re.sub("[A-Za-z]+", lambda m: "A" if m[0] in ("MMM", "a") else "9", pattern)


def _spelled(text: Column) -> Column:
    """The usual spellings: one is tried, that of the text's shape."""

    def tried(text: Column, shape: Column) -> Column:
        found = F.lit(None).cast("timestamp_ntz")
        for form in DATE_FORMATS:
            found = F.when(shape == _shape(form), F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")).otherwise(found)
        return found

    shape = F.regexp_replace(F.regexp_replace(text, "[A-Za-z]+", "A"), "[0-9]+", "9")
    return F.when(text.rlike(_SPELLED), let(F.struct(text.alias("t"), shape.alias("s")), lambda v: tried(v["t"], v["s"])))


def to_timestamp(c: Column | str, formats: tuple[str, ...] = ()) -> Column:
    """Naive timestamp: ISO text first, then each given pattern, then the usual spellings; a zone word at the end is left out."""
    source = _col(c).cast("string")
    text = F.trim(F.when(source.rlike("[A-Z]$"), F.regexp_replace(source, _ZONE_WORD, "")).otherwise(source))
    # ISO text begins with a year. A bare number is not a date, although Spark's cast would read four digits as a year. Casts
    # that fail are dear, so they are not tried on other texts.
    iso = F.when(text.rlike(r"^[+-]?[0-9]{4}") & ~text.rlike(r"^[0-9]+$"), text.try_cast("timestamp_ntz"))
    given = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    read = F.coalesce(iso, *given, _spelled(text))
    if formats:
        return read
    slashed = F.try_to_timestamp(source, F.lit("M/d/yyyy")).cast("timestamp_ntz")
    return F.when(source.rlike(_ISO_DAY), source.try_cast("timestamp_ntz")).when(source.rlike(_SLASHED_DAY), slashed).otherwise(read)


def to_date(c: Column | str, formats: tuple[str, ...] = ()) -> Column:
    return F.to_date(to_timestamp(c, formats))


def postal(c: Column | str) -> Column:
    """Postal code read as a number (``12345.0``) back to its digits.

    Numeric-looking means digits with at most one dot and one dash. Null stays null.
    """
    text = _col(c).cast("string")
    digits = F.regexp_replace(F.regexp_replace(text, r"^([^.]*)\.", "$1"), "^([^-]*)-", "$1")
    return F.when(digits.rlike("^[0-9]+$"), F.regexp_replace(text, r"\.[0-9]+$", "")).otherwise(text)


def week_number(c: Column | str) -> Column:
    """The number after ``Week`` in a page title, else null."""
    return F.nullif(F.regexp_extract(_col(c), WEEK_TITLE, 1), F.lit("")).try_cast("int")


def trailing_number(c: Column | str, default: int = DEFAULT_WEEK) -> Column:
    """The whole number after the last colon, or ``default``."""
    tail = F.trim(F.substring_index(_col(c), ":", -1))
    return F.coalesce(F.when(tail.rlike(WHOLE), tail.try_cast("int")), F.lit(default))


def file_name_date(c: Column | str) -> Column:
    """First ``dd_MM_yyyy`` in a file name, or first ``yyyy-MM-dd`` if that is no date."""
    dates = [F.try_to_date(F.regexp_extract(_col(c), pattern, 1), form) for pattern, form in FILE_DATES]
    return F.coalesce(*dates)


def period_start(c: Column | str) -> Column:
    """Start date of a ``MM/dd/yyyy-MM/dd/yyyy`` period text."""
    return F.try_to_date(F.split_part(_col(c), F.lit("-"), F.lit(1)), "MM/dd/yyyy")


def utc_day(c: Column | str) -> Column:
    """Calendar day of an ISO timestamp; a trailing ``Z`` is already UTC."""
    return F.to_date(F.rtrim(_col(c), F.lit("Z")).try_cast("timestamp_ntz"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
