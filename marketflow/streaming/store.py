"""A store that streams write to: one base and a tail of micro-batches, under numbered versions.

Every micro-batch writes a folder of its own and then commits a version that lists it. A version names the base,
the folders of the tail with their sequence numbers, and per stream the last micro-batch done. A micro-batch that is
replayed after a crash finds itself done and adds nothing; its place in the sequence is the one it got first,
whatever the clocks of drivers say. Compaction folds base and tail into a new base, partitioned by day; streams go
on meanwhile, and readers see one version or the next. Folders that no kept version names are removed by ``tidy``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.session import broadcast_if_small
from marketflow.sinks.manifest import Conflict, Versions

SEED = "seed"
# Column of the order in which micro-batches were committed, in rows that are read with it; the seed has 0.
SEQUENCE = "_sequence"
_DAY = "_day"
# Folders of the tail after which a stream folds them, and versions that are kept for readers.
TAIL = 64
KEPT = 8

_EMPTY = {"base": None, "done": {}, "tail": [], "next": 1}


class Store:
    """Rows of ``schema`` under ``path``; ``day`` names the time column that the base is partitioned by."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str | None = None):
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day
        self.versions = Versions(spark, self.path)

    def state(self) -> tuple[int, dict]:
        number, state = self.versions.latest()
        return number, state or _EMPTY

    def read(self, state: dict | None = None, days: tuple | None = None) -> DataFrame:
        """All rows with their ``_sequence``. With ``days``, files of the base and folders of the tail that have only days
        outside of that range (first, last; text) are not opened; rows without a day always count."""
        state = state or self.state()[1]
        names = [*self.schema.names, SEQUENCE]
        parts = []
        if state["base"]:
            marks = [T.StructField(SEQUENCE, T.LongType()), T.StructField(_DAY, T.DateType())]
            base = self.spark.read.schema(T.StructType([*self.schema.fields, *marks])).parquet(f"{self.path}/{state['base']}")
            if days and self.day:
                base = base.where(F.col(_DAY).isNull() | F.col(_DAY).between(*(F.lit(d).cast("date") for d in days)))
            parts.append(base.select(*names))
        tail = [t for t in state["tail"] if not days or _overlaps(t, days)]
        if tail:
            rows = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{t['folder']}" for t in tail))
            folder = F.regexp_extract("_metadata.file_path", r"/(tail-[0-9a-f]{32})/", 1)
            order = self.spark.createDataFrame([(t["folder"], t["sequence"]) for t in tail], f"_folder string, {SEQUENCE} long")
            rows = rows.withColumn("_folder", folder).join(broadcast_if_small(order), "_folder")
            parts.append(rows.select(*names))
        if not parts:
            return self.spark.createDataFrame([], self.schema).withColumn(SEQUENCE, F.lit(None).cast("long"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def append(self, make: Callable[[dict], DataFrame], delivery: str, batch: int) -> bool:
        """Commit the rows that ``make`` gives for the store's state as micro-batch ``batch`` of a stream; false if it is done
        already. Made again if another stream commits first, since they may depend on what the store holds."""
        while True:
            number, state = self.state()
            if batch <= state["done"].get(delivery, -2):
                return False
            entry = self._written(make(state), 0 if delivery == SEED else state["next"])
            after = {
                "base": state["base"], "done": {**state["done"], delivery: batch}, "tail": [*state["tail"], entry],
                "next": state["next"] + 1,
            }
            try:
                self.versions.commit(number, after)
                return True
            except Conflict:
                self.versions.delete_folder(f"{self.path}/{entry['folder']}")

    def _written(self, df: DataFrame, sequence: int) -> dict:
        folder = f"tail-{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(f"{self.path}/{folder}")
        entry = {"folder": folder, "sequence": sequence}
        if self.day:
            day = F.to_date(self.day)
            kept = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
            row = kept.agg(F.min(day).cast("string"), F.max(day).cast("string"), F.count_if(day.isNull())).first()
            entry["days"], entry["undated"] = row[:2], row[2]
        return entry

    def compact(self, fold: Callable[[DataFrame], DataFrame] | None = None) -> bool:
        """Fold base and tail into a new base. ``fold`` gets all rows with ``_sequence`` and gives those that still count.

        What is committed meanwhile stays in the tail. False if another compaction was first.
        """
        _, state = self.state()
        rows = self.read(state)
        rows = fold(rows) if fold else rows
        base = f"base-{uuid.uuid4().hex}"
        day = F.to_date(self.day) if self.day else F.lit(None).cast("date")
        rows = rows.select(*self.schema.names, SEQUENCE, day.alias(_DAY))
        # Few files a day, and several tasks for a day that is much larger than others.
        rows = rows.hint("rebalance", _DAY) if self.day else rows.hint("rebalance")
        rows.write.partitionBy(_DAY).parquet(f"{self.path}/{base}")
        folded = {t["folder"] for t in state["tail"]}
        while True:
            number, now = self.state()
            if now["base"] != state["base"]:
                self.versions.delete_folder(f"{self.path}/{base}")
                return False
            after = {**now, "base": base, "tail": [t for t in now["tail"] if t["folder"] not in folded]}
            try:
                self.versions.commit(number, after)
                return True
            except Conflict:
                continue

    def compact_if_long(self, fold: Callable[[DataFrame], DataFrame] | None = None, tail: int = TAIL) -> None:
        """Fold the tail when it has grown to so many folders; old versions and what only they name go."""
        if len(self.state()[1]["tail"]) >= tail:
            self.compact(fold)
            self.tidy()

    def tidy(self, keep: int = KEPT) -> None:
        """Remove all but the last versions, and the folders that the removed ones name and the kept ones do not.

        Readers of a version older than the last ``keep`` lose their files.
        """
        gone = {f for state in self.versions.forget(keep) for f in _folders(state)}
        kept = {f for n in self.versions.numbers() for f in _folders(self.versions.read(n))}
        for folder in sorted(gone - kept):
            self.versions.delete_folder(f"{self.path}/{folder}")


def _folders(state: dict) -> set[str]:
    return {t["folder"] for t in state["tail"]} | ({state["base"]} if state["base"] else set())


def _overlaps(entry: dict, days: tuple) -> bool:
    if "days" not in entry or entry["undated"]:
        return True
    low, high = entry["days"]
    return low is not None and low <= days[1] and high >= days[0]
