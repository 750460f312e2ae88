"""Incremental loads: tables arrive as files and run through streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.operators.messages import message_codes
from marketflow.plans.load_queries import EVENT_COLUMNS, _same, _shifted, task_changes, _TASK_BATCH
from marketflow.plans.registry import query, table
from marketflow.plans.schema_queries import CODES_SQL, payloads
from marketflow.session import scratch_path
from marketflow.streaming import codes as code_streams
from marketflow.streaming import ingest


def _landed(df: DataFrame, label: str, files: int = 4) -> str:
    """The rows as several files in a landing folder."""
    path = scratch_path(df.sparkSession, f"landing-{label}")
    df.repartition(files).write.parquet(path)
    return path


def _places(spark, label: str) -> tuple[str, str]:
    return scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")


@query(f"""
WITH t AS (SELECT * FROM events),
b AS (SELECT event_id, ts + INTERVAL 6 HOUR AS ts, user_id, event_type, value, props FROM events)
SELECT * FROM t UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_same(EVENT_COLUMNS, ["ts"])})
""")
def stream_ingest(spark, sf):
    """Insert-if-new over micro-batches; a second delivery of the files adds nothing."""
    events = table(spark, sf, "events")
    store, checkpoint = _places(spark, "ingest")
    ingest.seed(events, store)
    for delivery in ("first", "second"):
        folder = _landed(_shifted(events), delivery)
        stream = ingest.arrivals(spark, folder, events.schema, max_files=2)
        ingest.ingest_new(stream, store, f"{checkpoint}-{delivery}", delivery=delivery)
    return ingest.rows(spark, store, events.schema)


@query("""
WITH t AS (SELECT event_id, ts, user_id, value FROM events),
b AS (SELECT event_id, ts, user_id, value + 1 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE CAST(b.ts AS DATE) = CAST(t.ts AS DATE) AND b.user_id = t.user_id)
UNION ALL SELECT * FROM b
""")
def stream_restated(spark, sf):
    """Seven days delivered again: their keys are replaced, later days are left alone."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-08", "2024-01-15"))
    week = events.where((F.col("ts") >= start) & (F.col("ts") < end)).withColumn("value", F.col("value") + 1)
    store, checkpoint = _places(spark, "restated")
    ingest.seed(events, store)
    stream = ingest.arrivals(spark, _landed(week, "restated"), events.schema)
    ingest.ingest_restated(stream, store, checkpoint)
    return ingest.restated_rows(spark, store, events.schema, ["ts", "user_id"])


@query("""
SELECT date_trunc('hour', ts) AS window_start, user_id AS service, COUNT(*) AS failures FROM events
WHERE event_type = 'error' GROUP BY 1, 2
""")
def stream_failures(spark, sf):
    """Failed tasks per hour and service, by event time."""
    events = table(spark, sf, "events")
    tasks = events.select("ts", F.col("user_id").alias("service"), F.col("event_type").alias("status"))
    store, checkpoint = _places(spark, "failures")
    stream = ingest.arrivals(spark, _landed(tasks, "failures"), tasks.schema, max_files=2)
    ingest.count_failures(stream, store, checkpoint, "ts", "service", "status", failed="error", watermark="40 days")
    return ingest.failure_counts(spark, store, tasks.schema, "ts", "service")


@query(f"""
SELECT task_id, arg_min(service, seq) AS service, arg_min(created_at, seq) AS created_at,
       arg_max(status, seq) AS status, arg_max(description, seq) AS description
FROM ({_TASK_BATCH}) GROUP BY task_id
""")
def stream_state(spark, sf):
    """The current row of every task, from a log of upserts."""
    changes = task_changes(table(spark, sf, "events"))
    store, checkpoint = _places(spark, "state")
    stream = ingest.arrivals(spark, _landed(changes, "state"), changes.schema, max_files=2)
    ingest.ingest_upserts(stream, store, checkpoint, "task_id", ["seq"])
    state = ingest.upsert_state(spark, store, changes.schema, "task_id", ["seq"], ["status", "description"])
    return state.drop("seq")


@query(f"""
SELECT event_id, phone, ts, latest_otp_code FROM (
  SELECT r.event_id, CAST(r.user_id AS VARCHAR) AS phone, r.ts, m.otp_code AS latest_otp_code,
         row_number() OVER (PARTITION BY r.event_id ORDER BY m.ts DESC) AS rn
  FROM events r LEFT JOIN ({CODES_SQL}) m
    ON m.phone = CAST(r.user_id AS VARCHAR) AND m.ts > r.ts - INTERVAL 86400 SECOND AND m.ts <= r.ts
  WHERE r.event_type = 'error') WHERE rn = 1
""")
def stream_codes(spark, sf):
    """Messages arrive as a stream of payloads; requests look up their newest code."""
    events = table(spark, sf, "events")
    messages = payloads(events)
    requests = events.where("event_type = 'error'").select("event_id", F.col("user_id").cast("string").alias("phone"), "ts")
    log, checkpoint = _places(spark, "codes")
    ingest.ingest_codes(ingest.arrivals(spark, _landed(messages, "messages"), messages.schema, max_files=2), log, checkpoint)

    def codes(session):
        return ingest.code_log(session, log, messages.schema).drop("event_id")

    answers, answered = _places(spark, "answers")
    stream = ingest.arrivals(spark, _landed(requests, "requests"), requests.schema)
    ingest.answer_requests(stream, answers, answered, codes, "phone", "ts", "ts", 86400)
    return ingest.answers(spark, answers, requests.schema)


@query(f"""
SELECT event_id, phone, ts, latest_otp_code FROM (
  SELECT r.event_id, CAST(r.user_id AS VARCHAR) AS phone, r.ts, m.otp_code AS latest_otp_code,
         row_number() OVER (PARTITION BY r.event_id ORDER BY m.ts DESC, m.otp_code DESC) AS rn
  FROM events r LEFT JOIN ({CODES_SQL}) m
    ON m.phone = CAST(r.user_id AS VARCHAR) AND m.ts > r.ts - INTERVAL 3600 SECOND AND m.ts <= r.ts
  WHERE r.event_type = 'error') WHERE rn = 1
""")
def stream_code_join(spark, sf):
    """Requests and codes as two streams joined by time: half of the codes land after the requests that wait for them."""
    events = table(spark, sf, "events")
    coded = message_codes(payloads(events)).select("phone", "otp_code", "ts")
    requests = events.where("event_type = 'error'").select("event_id", F.col("user_id").cast("string").alias("phone"), "ts")
    # A last row of either stream, long after all others, says that nothing else will come.
    end = F.lit("2100-01-01").cast("timestamp_ntz")
    # It has a phone, as rows that can join nothing are dropped before their time is seen.
    nobody = F.lit("-")
    closing_code = spark.range(1).select(nobody.alias("phone"), nobody.alias("otp_code"), end.alias("ts"))
    closing_request = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), nobody.alias("phone"), end.alias("ts"))
    early = F.pmod(F.xxhash64("phone", "otp_code"), F.lit(2)) == 0
    asked, made = scratch_path(spark, "landing-asked"), scratch_path(spark, "landing-made")
    answers, checkpoint = _places(spark, "joined")
    deliveries = (
        (requests, coded.where(early)), (requests.limit(0), coded.where(~early)), (closing_request, closing_code),
    )
    for some_requests, some_codes in deliveries:
        some_requests.write.mode("append").parquet(asked)
        some_codes.write.mode("append").parquet(made)
        # Every run goes on from the state that the one before left in the checkpoint.
        streams = (ingest.arrivals(spark, asked, requests.schema), ingest.arrivals(spark, made, coded.schema))
        code_streams.answer_as_they_come(*streams, answers, checkpoint, "phone", "ts", "ts", seconds=3600, late="60 days")
    return code_streams.answered(spark, answers, requests.schema).where("event_id >= 0")


@query("""
SELECT event_id, ts, user_id, value + CASE WHEN ts < TIMESTAMP '2024-01-08 00:00:00' THEN 1 WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 2 ELSE 0 END AS value
FROM events
""")
def stream_restated_twice(spark, sf):
    """Two streams with checkpoints of their own restate different weeks of one store; keys are whole rows here."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    store, checkpoint = _places(spark, "restated")
    ingest.seed(events, store)
    weeks = (("2024-01-01", "2024-01-08", 1), ("2024-01-08", "2024-01-15", 2))
    for start, end, more in weeks:
        inside = (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        week = events.where(inside).withColumn("value", F.col("value") + more)
        stream = ingest.arrivals(spark, _landed(week, "restated"), events.schema)
        ingest.ingest_restated(stream, store, f"{checkpoint}-{more}")
    return ingest.restated_rows(spark, store, events.schema, ["event_id"])
