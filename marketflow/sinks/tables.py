"""Catalog tables: creation, loads, copies.

A load that rewrites a table never overwrites the files it reads: the new state is
written to a fresh folder and the table is pointed at it, which is one catalog
change. Partitioned tables replace only the partitions a batch touches.

Every load commits a version beside the table (:mod:`marketflow.sinks.manifest`). A rewrite names the version that it
read; one that somebody else has changed since is refused with a :class:`Conflict`, so that no rows are lost, and
loads that decide by the table's content are made again. Loads that write in place commit before and after.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators import dedup, load
from marketflow.operators.projections import KINDS, Contract
from marketflow.session import broadcast_if_small, scratch_path, stage
from marketflow.sinks.content import ContentIndex
from marketflow.sinks.manifest import Conflict, Versions

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# Partitions named in one statement.
_SPECS = 200
# Versions whose folders stay for queries that read them, and times a load is tried.
KEPT = 4
RETRIES = 5


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def create_table(
    spark: SparkSession, name: str, fields: Contract, partition_by: Sequence[str] = (), location: str | None = None
) -> None:
    """Create a Parquet table from a contract; an existing table is left alone."""
    columns = ", ".join(f"`{f.name}` {KINDS[f.kind]}" for f in fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table with the folders of its older versions."""
    if spark.catalog.tableExists(name):
        versions, location = _versions(spark, name), _location(spark, name)
        for folder in _version_folders(versions):
            if folder != location:
                versions.delete_folder(folder)
        versions.delete_folder(versions.root)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def copy_table(spark: SparkSession, source: str, target: str, location: str | None = None) -> None:
    options = {"path": location} if location else {}
    spark.read.table(source).write.options(**options).saveAsTable(target)


def _ordered(df: DataFrame, name: str) -> DataFrame:
    return df.select(*df.sparkSession.read.table(name).columns)


_VERSION = "__v"


def _location(spark: SparkSession, name: str) -> str:
    # Details follow the columns, one of which might have that name too.
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").tail(1)[0]["data_type"].rstrip("/")


def _versions(spark: SparkSession, name: str) -> Versions:
    """The versions of a table, in a folder beside it."""
    return Versions(spark, _location(spark, name).rsplit(_VERSION, 1)[0] + "__log")


def _version_folders(versions: Versions) -> list[str]:
    parent, _, stem = versions.root.removesuffix("__log").rpartition("/")
    return [f"{parent}/{n}" for n in versions.folders(parent) if n.startswith(stem + _VERSION)]


def table_version(spark: SparkSession, name: str) -> int:
    """The version to name in a rewrite of what is read from now on. A swap that was committed and then interrupted is finished."""
    versions = _versions(spark, name)
    number, state = versions.latest()
    if state and state["location"] != _location(spark, name):
        _point(spark, name, versions)
    spark.catalog.refreshTable(name)
    return number


def _point(spark: SparkSession, name: str, versions: Versions) -> None:
    """Point the table at the newest version's folder; again if there is a newer one by then."""
    number = None
    while number != versions.latest()[0]:
        number, state = versions.latest()
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{state['location']}'")
    parts = _partition_columns(spark, name)
    if parts:
        # The catalog keeps a folder per partition, so they are registered anew; files of old ones can then never come back.
        known = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        specs = [", ".join(f"`{p}` = {_literal(_unescaped(v))}" for p, v in (kv.split("=", 1) for kv in part.split("/"))) for part in known]
        for at in range(0, len(specs), _SPECS):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs[at : at + _SPECS]))
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _unescaped(value: str) -> str | None:
    return None if value in ("null", "__HIVE_DEFAULT_PARTITION__") else unquote(value)


def tidy_versions(spark: SparkSession, name: str, keep: int = KEPT) -> None:
    """Remove the folders of versions older than the last ``keep``; queries that still read one of them fail."""
    versions = _versions(spark, name)
    gone = {state["location"] for state in versions.forget(keep)}
    kept = {versions.read(n)["location"] for n in versions.numbers()} | {_location(spark, name)}
    for folder in sorted(gone - kept):
        versions.delete_folder(folder)


@contextmanager
def _in_place(spark: SparkSession, name: str) -> Iterator[None]:
    """A write into the table's own folder: rewrites that read the table before its end are refused, and it is itself
    refused if one was committed meanwhile."""
    number, versions = table_version(spark, name), _versions(spark, name)
    state = {"location": _location(spark, name)}
    number = versions.commit(number, state)
    yield
    versions.commit(number, state)


def retried(load: Callable[[], None], times: int = RETRIES) -> None:
    """Run a load that decides by the table's content again if another one was first."""
    for _ in range(times - 1):
        try:
            return load()
        except Conflict:
            continue
    load()


def append_rows(df: DataFrame, name: str) -> None:
    with _in_place(df.sparkSession, name):
        _ordered(df, name).write.mode("append").insertInto(name)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def replace_table(df: DataFrame, name: str, version: int | None = None) -> None:
    """Make ``df``, which may read the table itself, its whole content.

    ``version`` is what :func:`table_version` gave before ``df`` read the table; without it, the version of now.
    """
    spark = df.sparkSession
    base = table_version(spark, name) if version is None else version
    versions = _versions(spark, name)
    folder = versions.root.removesuffix("__log") + _VERSION + uuid.uuid4().hex
    _ordered(df, name).write.partitionBy(*_partition_columns(spark, name)).parquet(folder)
    try:
        versions.commit(base, {"location": folder})
    except Conflict:
        versions.delete_folder(folder)
        raise
    _point(spark, name, versions)


def _literal(value) -> str:
    if value is None:
        return "null"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace exactly the partitions that occur in ``df``, which may read the table."""
    spark = df.sparkSession
    parts = _partition_columns(spark, name)
    if not parts:
        raise ValueError(f"{name} is not partitioned")
    path = scratch_path(spark, "partitions")
    rows = _ordered(df, name)
    rows.write.parquet(path)
    # Table inserts follow a setting of the session only; as a writer option it is not
    # heeded, and the default mode would empty the partitions that are not in the rows.
    # A session of its own keeps it from inserts that run at the same time.
    apart = spark.newSession()
    apart.conf.set(_OVERWRITE_MODE, "dynamic")
    apart.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    apart.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    # Few files per partition, and several tasks for a partition that is much larger.
    even = apart.read.schema(rows.schema).parquet(path).hint("rebalance", *parts)
    with _in_place(spark, name):
        even.write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)


def insert_new(batch: DataFrame, name: str, granularity: str = "day") -> None:
    """Insert-if-new: only new rows are written, the table's files stay."""
    spark = batch.sparkSession

    def run() -> None:
        target = spark.read.table(name)
        fresh = load.new_rows(target.select(*batch.columns), batch, granularity)
        append_rows(stage(fresh, "new"), name)

    retried(run)


def replace_keys(batch: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Keyed replace of a whole, unpartitioned table."""
    spark = batch.sparkSession

    def run() -> None:
        version = table_version(spark, name)
        replace_table(load.keyed_replace(spark.read.table(name), batch, keys), name, version)

    retried(run)


def load_partitions(
    batch: DataFrame,
    name: str,
    partition: str,
    discipline: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Apply a load discipline to the partitions a batch touches, and write only them.

    ``discipline`` must not move rows between partitions: its keys, or its period,
    have to contain the partition column.
    """
    batch = stage(batch, "batch")
    target = batch.sparkSession.read.table(name)
    # The touched values, one per partition folder, prune the table's partitions when
    # the query is planned.
    values = [row[0] for row in batch.select(partition).distinct().collect()]
    listed = F.col(partition).isin([v for v in values if v is not None])
    affected = target.where(listed | F.col(partition).isNull() if None in values else listed)
    replace_partitions(discipline(affected, batch), name)


def upsert_keys(batch: DataFrame, name: str, key: str, order: Sequence[str], mutable: Sequence[str], bucket: str, buckets: int) -> None:
    """Upsert into a table of state, one row per key, that is partitioned by ``bucket``, the :func:`load.key_bucket` of its key.

    Only the buckets that the batch's keys fall into are read and rewritten.
    """
    changes = batch.withColumn(bucket, load.key_bucket(F.col(key), buckets))
    load_partitions(changes, name, bucket, lambda target, rows: load.upsert(target, rows, key, order, mutable))


def replace_keys_in_partitions(batch: DataFrame, name: str, keys: Sequence[str], partition: str) -> None:
    """Keyed replace on a table partitioned by one of the keys."""
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys {list(keys)}")
    load_partitions(batch, name, partition, lambda target, rows: load.keyed_replace(target, rows, keys))


def append_content(batch: DataFrame, name: str) -> None:
    """Append what the table does not say yet; load stamps do not count as content.

    An index of contents tells which of the table's files may hold some of the batch, and only these are read. Only if some
    content was loaded with a later stamp before is the table rewritten, as the earliest stamp is kept.
    """
    spark = batch.sparkSession
    fresh = stage(dedup.dedup_loads(_ordered(batch, name)), "content")
    stamps = [c for c in dedup.LOAD_COLUMNS if c in fresh.columns]
    content = [c for c in fresh.columns if c not in stamps]

    def run() -> None:
        version = table_version(spark, name)
        target = spark.read.table(name)
        index = ContentIndex(spark, name, f"{_versions(spark, name).root}/{_location(spark, name).rpartition('/')[2]}", content)
        known = index.candidates(_typed_like(fresh, target))
        new = load.new_rows(known.select(*content), fresh.select(*content), "exact")
        same = reduce(lambda a, b: a & b, [fresh[c].eqNullSafe(new[c]) for c in content])
        rows = stage(fresh.join(new, same, "left_semi"), "new")
        stamped = fresh.select(F.xxhash64(*content).alias("_content"), *[F.col(c).alias(f"_{c}") for c in stamps])
        earlier = F.lit(False)
        for c in stamps:
            earlier = earlier | (F.col(f"_{c}") < F.col(c))
        late = known.withColumn("_content", F.xxhash64(*content)).join(broadcast_if_small(stamped), "_content").where(earlier)
        if stamps and not late.isEmpty():
            replace_table(dedup.dedup_loads(load.append(target, fresh)), name, version)
        else:
            append_rows(rows, name)

    retried(run)


def _typed_like(df: DataFrame, target: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{n}`").cast(k).alias(n) for n, k in target.dtypes])


def replace_months(batch: DataFrame, name: str, date_column: str, partition: str) -> None:
    """Month replace on a table partitioned by a column that follows from the month."""
    load_partitions(batch, name, partition, lambda target, rows: load.month_replace(target, rows, date_column))


def dedup_table(spark: SparkSession, name: str) -> None:
    """Rewrite a table without repeated content."""
    def run() -> None:
        version = table_version(spark, name)
        replace_table(dedup.dedup_loads(spark.read.table(name)), name, version)

    retried(run)


def swap_in(df: DataFrame, name: str) -> None:
    """First load or truncate-load: create the table if needed, then swap."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.limit(0).write.saveAsTable(name)
    replace_table(df, name)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines; dates, times and decimals as text."""
    texts = [
        F.col(name).cast("string").alias(name)
        if kind in ("date", "timestamp", "timestamp_ntz") or kind.startswith("decimal")
        else F.col(name)
        for name, kind in df.dtypes
    ]
    df.select(*texts).write.json(path)
