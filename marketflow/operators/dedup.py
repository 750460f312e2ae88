"""Whole-table deduplication after appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that tell when a row was loaded, not what it says.
LOAD_COLUMNS = ("date", "period")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_loads(df: DataFrame) -> DataFrame:
    """One row per content: earliest ``date`` and smallest ``period`` of its loads.

    Tables without these columns are reduced to their distinct rows. The minimum
    combines before the shuffle, so content that was loaded very often costs one
    row per input partition.
    """
    stamps = [c for c in LOAD_COLUMNS if c in df.columns]
    if not stamps:
        return distinct_rows(df)
    content = [c for c in df.columns if c not in stamps]
    return df.groupBy(*content).agg(*[F.min(c).alias(c) for c in stamps]).select(*df.columns)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
