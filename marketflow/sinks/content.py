"""Which files of a table may hold given contents: an index of row digests beside the table.

Loads that have to know whether the table says something already need not read it. Every file's rows are hashed
once, when a load first meets the file, into (digest, file) rows clustered by digest; a later load looks its own
digests up there and opens the files found. Digests may agree by chance, so the rows of those files decide.
Entries of files that the table no longer has are passed over, and go with the version folder the index belongs to.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import broadcast_if_small

# Clusters of the index; a load reads those its digests fall into.
CLUSTERS = 256


def _plain(file: str) -> str:
    """One spelling of a file's address: a frame lists its files as URIs, and rows name theirs as paths."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", file)


def _digest(columns: Sequence[str]):
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _cluster(digest):
    return F.pmod(digest, F.lit(CLUSTERS)).cast("int")


class ContentIndex:
    """The index over ``content`` columns of table ``name``, below ``folder``."""

    def __init__(self, spark: SparkSession, name: str, folder: str, content: Sequence[str]):
        self.spark, self.name, self.content = spark, name, sorted(content)
        marks = spark.range(1).select(F.xxhash64(*[F.lit(c) for c in self.content])).first()[0]
        self.path = f"{folder}/content-{marks & (1 << 64) - 1:016x}"

    def _entries(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema("digest long, file string, cluster int").parquet(self.path)

    def refresh(self) -> list[str]:
        """Index the files that are not yet in it; returns the table's files."""
        table = self.spark.read.table(self.name)
        files = sorted(_plain(unquote(f)) for f in table.inputFiles())
        entries = self._entries()
        known = {_plain(r["file"]) for r in entries.select("file").distinct().collect()} if entries is not None else set()
        missing = [f for f in files if f not in known]
        if missing:
            rows = self._read(missing).select(_digest(self.content).alias("digest"), F.col("_metadata.file_path").alias("file"))
            rows = rows.distinct().withColumn("cluster", _cluster(F.col("digest")))
            # One file a cluster and load; sorted, so that the digests' ranges prune row groups.
            rows.repartition("cluster").sortWithinPartitions("cluster", "digest").write.mode("append").partitionBy("cluster").parquet(self.path)
        return files

    def _read(self, files: Sequence[str]) -> DataFrame:
        table = self.spark.read.table(self.name)
        location = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'").tail(1)[0]["data_type"]
        return self.spark.read.schema(table.schema).option("basePath", location).parquet(*files)

    def candidates(self, batch: DataFrame) -> DataFrame:
        """The table's rows in files that may hold a content of ``batch``, which has the table's column types."""
        files = self.refresh()
        entries = self._entries()
        table = self.spark.read.table(self.name)
        if entries is None or not files:
            return table.limit(0)
        wanted = batch.select(_digest(self.content).alias("digest")).distinct()
        wanted = wanted.withColumn("cluster", _cluster(F.col("digest")))
        clusters = [r["cluster"] for r in wanted.select("cluster").distinct().collect()]
        found = entries.where(F.col("cluster").isin(clusters)).join(broadcast_if_small(wanted), ["cluster", "digest"], "left_semi")
        hit = {_plain(r["file"]) for r in found.select("file").distinct().collect()}
        some = [f for f in files if f in hit]
        return self._read(some) if some else table.limit(0)
