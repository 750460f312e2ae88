"""Codes joined to the requests that wait for them, both arriving as streams.

A request sees the codes of its key that were made in the seconds before it, whichever of the two lands first.
Spark keeps requests and codes as state and joins them as they come; the watermarks say how late either may
land, and with the bounds on time, when a row can be forgotten. A request without a code is answered with
null once none can come any more. Both states live in the checkpoint, so a restart goes on where it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketflow.operators import lookups
from marketflow.streaming import ingest
from marketflow.streaming.store import Store

_MADE, _KEY, _SEEN = "_made", "_key", "_seen"


def match_codes(requests: DataFrame, codes: DataFrame, key: str, at: str, created_at: str, value: str, seconds: int, late: str) -> DataFrame:
    """Stream of (request columns, ``value``, when it was made): one row per code that a request can see, or one with nulls."""
    # Watermarks need an instant; in the UTC session naive times convert one to one.
    asked = requests.withColumn(_SEEN, F.col(at).cast("timestamp")).withWatermark(_SEEN, late)
    made = codes.select(F.col(key).alias(_KEY), F.col(value).alias(f"latest_{value}"), F.col(created_at).cast("timestamp").alias(_MADE))
    made = made.withWatermark(_MADE, late)
    in_time = (F.col(_MADE) > F.col(_SEEN) - F.expr(f"interval {int(seconds)} seconds")) & (F.col(_MADE) <= F.col(_SEEN))
    return asked.join(made, (F.col(key) == F.col(_KEY)) & in_time, "leftOuter").drop(_KEY, _SEEN)


def _newest(matches: DataFrame, of: Sequence[str], value: str) -> DataFrame:
    """One row per request: the newest code, of equally new ones the greatest."""
    latest = F.max(F.when(F.col(_MADE).isNotNull(), F.struct(_MADE, value))).alias("_latest")
    found = matches.groupBy(*of).agg(latest)
    return found.select(*of, F.col(f"_latest.{value}").alias(value), F.col(f"_latest.{_MADE}").alias(_MADE))


def answer_as_they_come(
    requests: DataFrame,
    codes: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    at: str,
    created_at: str,
    value: str = "otp_code",
    seconds: int = lookups.CODE_SECONDS,
    late: str = "10 minutes",
    delivery: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Answer requests from a stream of codes. Rows later than ``late`` behind the newest of both streams are left out.

    Requests are told apart by all their columns. A micro-batch writes at most one row of each, its newest code so far.
    """
    of = requests.columns
    latest = f"latest_{value}"
    store = _answers(requests.sparkSession, path, requests.schema, value)
    matches = match_codes(requests, codes, key, at, created_at, value, seconds, late)

    each = ingest.log_into(store, delivery or ingest.delivery_name(checkpoint), lambda batch: _newest(batch, of, latest))
    return ingest.run_available(matches, checkpoint, each, every=every)


def _answers(spark: SparkSession, path: str, schema: T.StructType, value: str) -> Store:
    found = [T.StructField(f"latest_{value}", T.StringType()), T.StructField(_MADE, T.TimestampType())]
    return Store(spark, path, T.StructType([*schema.fields, *found]))


def answered(spark: SparkSession, path: str, schema: T.StructType, value: str = "otp_code") -> DataFrame:
    """Every request answered so far with its newest code; ``schema`` is that of the request stream.

    A code that lands later replaces an older one.
    """
    return _newest(_answers(spark, path, schema, value).read(), schema.names, f"latest_{value}").drop(_MADE)
