"""Running a Python function over Arrow batches of a frame, and fresh column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows of a batch are handed to Python in slices of at most this many characters, or of one row.
SLICE_CHARS = 2 << 20
# Rows of one Arrow batch, at most: texts are long, and both sides hold whole batches.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound(spark: SparkSession) -> None:
    """Keep this session's Arrow batches small; a smaller setting stays."""
    if not 0 < int(spark.conf.get(_ROWS)) <= BATCH_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(lengths: list[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths add up to ``limit`` at most (``SLICE_CHARS`` by default), or of one row."""
    start = total = 0
    for i, length in enumerate(lengths):
        if i > start and total + length > limit:
            yield start, i
            start, total = i, 0
        total += length
    if lengths:
        yield start, len(lengths)


def with_columns(df: DataFrame, text: str, added: list[tuple[str, str]], make: Callable) -> DataFrame:
    """All columns of ``df`` and ``added`` ones. ``make`` gets a list of texts and returns one list per added column."""
    bound(df.sparkSession)
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(",".join(f"`{n}` {k}" for n, k in added)).fields)
    arrow = to_arrow_schema(schema)
    place = df.columns.index(text)
    kinds = [arrow.field(i).type for i in range(len(df.columns), len(arrow))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()
            for a, b in slices(sizes):
                part = batch.slice(a, b - a)
                made = [pa.array(v, k) for v, k in zip(make(part.column(place).to_pylist()), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(part.columns + made, names=arrow.names)
            # Workers are used again by later stages; they should not keep what this one freed.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
