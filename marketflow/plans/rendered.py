"""Report files rendered from tables, in the shapes reports arrive in."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import scratch_path, settings

_ROW_BITS = (1 << 33) - 1

# Splits that files are cut into while that makes none of them larger than the session's own size.
_SPLITS = 64


@contextmanager
def small_splits(spark: SparkSession, size: str | None = None) -> Iterator[None]:
    """Files scanned meanwhile are cut into splits of ``size``, so that sample files are split like large ones.

    Without a size there are some 64 splits, of 64 KiB at least, and of the session's own size where files are large: the
    number of tasks does not grow faster than that of any other scan.
    """
    files = "spark.sql.files."
    meant = {f"{files}maxPartitionBytes": size} if size else {f"{files}openCostInBytes": "64k", f"{files}minPartitionNum": str(_SPLITS)}
    with settings(spark, meant):
        yield


def headed_files(df: DataFrame, line: Column, head: Sequence[str | Column], label: str) -> str:
    """Text files of ``line`` values, each starting with the ``head`` lines."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    heads = [F.lit(h) if isinstance(h, str) else h for h in head]
    numbered = df.select("*", line.alias("_line"), row.alias("_row"))
    lines = F.when(F.col("_row") == 0, F.array(*heads, F.col("_line"))).otherwise(F.array("_line"))
    path = scratch_path(df.sparkSession, label)
    numbered.select(F.explode(lines).alias("value")).write.text(path)
    return path


def framed_files(df: DataFrame, line: Column, first: str, last: str, separator: str, label: str, **options: str) -> str:
    """Files of one document each: ``first``, some thousand lines, ``last``."""

    def framed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": [first + separator.join(batch["value"]) + last]})

    path = scratch_path(df.sparkSession, label)
    documents = df.select(line.alias("value")).mapInPandas(framed, "value string")
    documents.write.options(maxRecordsPerFile="1", **options).text(path)
    return path


def array_files(df: DataFrame, line: Column, label: str) -> str:
    """Files of one JSON array each on one line, however large: a task writes its own in pieces, and a blank ends every piece."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": [lead + ", ".join(batch["value"])]})
                lead = ", "
        if lead != "[":
            yield pd.DataFrame({"value": ["]"]})

    path = scratch_path(df.sparkSession, label)
    df.select(line.alias("value")).mapInPandas(pieces, "value string").write.options(lineSep=" ").text(path)
    return path


def csv_line(*columns: Column, sep: str = ",") -> Column:
    return F.to_csv(F.struct(*columns), {"sep": sep, "escape": '"'})
