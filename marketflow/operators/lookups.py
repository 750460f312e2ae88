"""Lookups: latest per key, as-of, membership, effective-dated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions import periods
from marketflow.session import broadcast_if_small

# Fixed value: a message code is looked up this many seconds back.
CODE_SECONDS = 60


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest in ``order``.

    Combines before the shuffle; a window would sort every row of a hot key in
    one task.
    """
    others = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`") for c in df.columns])


def latest_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The single latest row (a top-1 query)."""
    return df.orderBy(*[F.col(o).desc() for o in order]).limit(1)


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], fallback: dict[str, Column] | None = None) -> DataFrame:
    """Left join to a lookup table; columns not found take their fallback."""
    joined = df.join(broadcast_if_small(table), list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), f) for c, f in (fallback or {}).items()})


def members(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return df.join(broadcast_if_small(wanted.select(key).distinct()), key, "left_semi")


def latest_code(messages: DataFrame, phone: str, code: str, created_at: str, now: Column, seconds: int = CODE_SECONDS) -> DataFrame:
    """Newest code per phone, as seen at ``now``, not older than ``seconds``."""
    recent = messages.where((F.col(created_at) > now - F.expr(f"interval {int(seconds)} seconds")) & (F.col(created_at) <= now))
    return recent.groupBy(phone).agg(F.max_by(code, F.struct(created_at, code)).alias(code))


def latest_within(
    requests: DataFrame,
    messages: DataFrame,
    key: str,
    at: str,
    created_at: str,
    values: Sequence[str],
    seconds: int,
    order: Sequence[str] = (),
) -> DataFrame:
    """Each request with the newest message of its key in the preceding ``seconds``.

    A message counts from its own instant up to, not including, ``seconds`` later.
    Requests without one have null values, and so have requests with a null key, which
    equals no other key; ``order`` breaks ties of equal times.

    Requests and messages are merged into time buckets one span long, each message
    also into the next bucket, so a bucket holds all a request can see. One window
    per key and bucket carries the newest message forward. A hot key is thereby
    spread over its buckets, and no pairs are built.
    """
    micros = seconds * 1_000_000
    unkeyed = requests.where(F.col(key).isNull())
    unkeyed = unkeyed.select("*", *[F.lit(None).cast(messages.schema[v].dataType).alias(f"latest_{v}") for v in values])
    requests = requests.where(F.col(key).isNotNull()).select("*", _micros(F.col(at)).alias("_t"))
    messages = messages.where(F.col(key).isNotNull()).select(key, *values, *[c for c in order if c not in (*values, key)], _micros(F.col(created_at)).alias("_t"))
    # One message per key and instant is enough; repeats combine before the shuffle.
    tie = F.struct(*(order or values))
    newest = messages.groupBy(key, "_t").agg(F.max_by(F.struct(*values), tie).alias("_m"))

    bucket = F.floor(F.col("_t") / F.lit(micros)).cast("long")
    body = [c for c in requests.columns if c not in (key, "_t")]
    asked = requests.select(
        key, "_t", bucket.alias("_bucket"), F.lit(1).alias("_kind"), F.struct(*body).alias("_r"),
    )
    told = newest.select(
        key, "_t", F.explode(F.array(bucket, bucket + 1)).alias("_bucket"), F.lit(0).alias("_kind"),
        F.struct(F.col("_t").alias("t"), F.col("_m").alias("m")).alias("_told"),
    )
    merged = asked.unionByName(told, allowMissingColumns=True)
    window = Window.partitionBy(key, "_bucket").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = merged.select("*", F.last("_told", ignorenulls=True).over(window).alias("_last")).where("_kind = 1")
    fresh = F.col("_last.t") > F.col("_t") - micros
    names = [c for c in requests.columns if c != "_t"]
    found = seen.select(
        *[F.col(c) if c == key else F.col(f"_r.`{c}`").alias(c) for c in names],
        *[F.when(fresh, F.col(f"_last.m.`{v}`")).alias(f"latest_{v}") for v in values],
    )
    return found.unionByName(unkeyed)


def _micros(ts: Column) -> Column:
    """Naive timestamp as microseconds since 1970; independent of the session zone."""
    minutes = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes.cast("long") * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def effective_keys(
    usage: DataFrame,
    restarts: DataFrame,
    model: str,
    month: str,
    current: str,
) -> DataFrame:
    """The ids a model had in each month it was used.

    ``restarts`` holds ``restart_date``, ``old_id`` and ``new_id`` per model. In the
    month of a restart both ids count, before it the old one, after the last one the
    new one; a model without restarts has its ``current`` id.

    Usage is first reduced to distinct model months and restarts to one per model
    and day, so a window holds at most the calendar of one model, however many
    rows the model has.
    """
    first = F.trunc(F.col(month), "MM").cast("date")
    months = usage.groupBy(model, first.alias("_at")).agg(F.max(current).alias("_current"))
    # Of restarts on one day the smallest pair counts.
    days = restarts.groupBy(model, F.col("restart_date").cast("date").alias("_at")).agg(
        F.min(F.struct("old_id", "new_id")).alias("_restart")
    )
    events = months.select(model, "_at", "_current", F.lit(0).alias("_kind")).unionByName(
        days.select(
            model, "_at", F.lit(1).alias("_kind"),
            F.struct(F.col("_at").alias("day"), "_restart.old_id", "_restart.new_id").alias("_change"),
        ),
        allowMissingColumns=True,
    )
    # Both windows run forward over their own order: a running last() is linear.
    forth = Window.partitionBy(model).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    back = (
        Window.partitionBy(model)
        .orderBy(F.col("_at").desc(), F.col("_kind").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ahead = F.last("_change", ignorenulls=True).over(back)
    behind = F.last("_change", ignorenulls=True).over(forth)
    placed = events.select("*", ahead.alias("_next"), behind.alias("_past")).where("_kind = 0")
    inside = F.col("_next.day") <= F.last_day("_at")
    ids = (
        F.when(F.col("_next").isNull() & F.col("_past").isNull(), F.array("_current"))
        .when(F.col("_next").isNull(), F.array("_past.new_id"))
        .when(inside, F.array("_next.old_id", "_next.new_id"))
        .otherwise(F.array("_next.old_id"))
    )
    return placed.select(model, F.col("_at").alias("month"), F.explode(ids).alias("effective_id"))


def missing_periods(keys: DataFrame, present: DataFrame, key: str, period: str, expected: Sequence) -> DataFrame:
    """Keys with the expected periods they lack, in expected order.

    What is present is filtered to the expected periods at the scan and combined to
    one small set per key before the shuffle, so no key-by-period grid is built.
    """
    wanted = F.array(*[periods.ref(p) for p in expected])
    day = F.to_date(F.col(period))
    # A plain range on the stored column prunes files; the exact test follows it.
    low, high = min(map(str, expected)), max(map(str, expected))
    column = F.col(period)
    near = (column >= periods.ref(low).cast("timestamp_ntz")) & (
        column < F.date_add(periods.ref(high), 1).cast("timestamp_ntz")
    )
    have = (
        present.where(near & day.isin([periods.ref(p) for p in expected]))
        .groupBy(key)
        .agg(F.collect_set(day).alias("_have"))
    )
    gaps = keys.join(have, key, "left").withColumn(
        "missing", F.array_except(wanted, F.coalesce("_have", F.array().cast("array<date>")))
    )
    return gaps.where(F.size("missing") > 0).drop("_have")
