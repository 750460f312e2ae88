"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound, in bytes of measured data, of anything this package broadcasts.
BROADCAST_LIMIT = 64 * 1024 * 1024


def get_spark(app: str = "marketflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    Report timestamps are naive local times, so the session runs in UTC and all
    stored timestamps are TIMESTAMP_NTZ. Adaptive execution is on: it sizes
    shuffle partitions, and splits the partitions of hot keys in joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may run without that setting.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never cleared."""
    return f"{shared_folder(spark)}/marketflow/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, meant: dict[str, str]) -> Iterator[None]:
    """The session has these settings meanwhile."""
    before = {key: spark.conf.get(key, None) for key in meant}
    for key, value in meant.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts its lineage. The shuffles of the write go when it has ended."""
    path = scratch_path(df.sparkSession, label)
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(df: DataFrame) -> Column:
    """Bytes of data in ``df``, as an aggregate over its rows."""
    fixed = 16 + 8 * len(df.columns)
    variable = [F.octet_length(f"`{name}`") for name, kind in df.dtypes if kind in ("string", "binary")]
    row = sum((F.coalesce(size, F.lit(0)) for size in variable), F.lit(fixed)).cast("long")
    return F.coalesce(F.sum(row), F.lit(0)).alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    return df.agg(bytes_of(df)).first()["bytes"]


def _measurable(df: DataFrame) -> bool:
    return all(kind in _FLAT or kind.startswith("decimal") for _, kind in df.dtypes)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Is the measured size of ``df`` within ``limit``? ``limit=0`` skips measuring."""
    return bool(limit) and _measurable(df) and measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured size is within ``limit``.

    Beyond the limit the frame is marked for a merge, and the join shuffles both
    sides with adaptive skew splitting. Without that mark Spark would go by the size
    of staged files, and millions of rows that repeat a path take few bytes there.
    """
    if fits_broadcast(df, limit):
        return F.broadcast(df)
    return df.hint("merge") if limit and _measurable(df) else df


_FLAT = {
    "string", "binary", "boolean", "tinyint", "smallint", "int", "bigint",
    "float", "double", "date", "timestamp", "timestamp_ntz",
}
