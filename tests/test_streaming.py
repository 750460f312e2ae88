import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from marketflow.operators import load, lookups
from marketflow.plans.schema_queries import payloads
from marketflow.streaming import ingest
from marketflow.streaming.store import Store

SCHEMA = "k string, at timestamp_ntz, v int"


def at(hour, day=1):
    return dt.datetime(2025, 6, day, hour)


def landed(spark, path, *batches):
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_rerun_adds_nothing(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    seed = spark.createDataFrame([("a", at(1), 1)], SCHEMA)
    files = [[("a", at(2), 1), ("b", at(1), 2)], [("b", at(9), 2), ("c", at(1), 3), ("c", at(1), 3)]]
    landed(spark, f"{folder}/in", *files)
    ingest.seed(seed, f"{folder}/store")
    for _ in range(2):
        stream = ingest.arrivals(spark, f"{folder}/in", schema, max_files=1)
        ingest.ingest_new(stream, f"{folder}/store", f"{folder}/cp")
    got = rows(ingest.rows(spark, f"{folder}/store", schema))
    # Which of the equal-by-day rows of b arrives first depends on the file order.
    assert [(k, t.date(), v) for k, t, v in got] == [("a", at(1).date(), 1), ("b", at(1).date(), 2), ("c", at(1).date(), 3)]
    landed(spark, f"{folder}/in", [("d", at(1), 4), ("a", at(5), 1)])
    ingest.ingest_new(ingest.arrivals(spark, f"{folder}/in", schema), f"{folder}/store", f"{folder}/cp")
    assert ingest.rows(spark, f"{folder}/store", schema).count() == 4


def test_a_repeated_micro_batch_adds_nothing_and_keeps_its_place(spark, folder):
    df = spark.createDataFrame([("a", at(1), 1)], SCHEMA)
    store = Store(spark, f"{folder}/store", df.schema, "at")
    assert store.append(lambda state: df, "one", 0)
    assert store.append(lambda state: df.withColumn("v", F.lit(2)), "two", 0)
    # The driver of the first stream was lost before Spark's own checkpoint; it delivers again, later than the other.
    assert not store.append(lambda state: df.withColumn("v", F.lit(3)), "one", 0)
    assert rows(store.read()) == [("a", at(1), 1, 1), ("a", at(1), 2, 2)]
    assert rows(ingest.restated_rows(spark, f"{folder}/store", df.schema, ["k"])) == [("a", at(1), 2)]


def test_streams_that_commit_at_once_see_each_other(spark, folder):
    df = spark.createDataFrame([("a", at(1), 1)], SCHEMA)
    store = Store(spark, f"{folder}/store", df.schema, "at")
    seen = []

    def fresh(state):
        seen.append(len(state["tail"]))
        if len(seen) == 1:
            store.append(lambda s: df, "other", 0)
        return load.new_rows(store.read(state).select(*df.columns), df)

    store.append(fresh, "own", 0)
    assert seen == [0, 1] and rows(ingest.rows(spark, f"{folder}/store", df.schema)) == [("a", at(1), 1)]
    assert len(store.versions.folders(f"{folder}/store")) == 3


def test_compaction_changes_no_answer(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    ingest.seed(spark.createDataFrame([("a", at(1), 0), ("c", at(1, 3), 0), (None, at(1), 0)], SCHEMA), f"{folder}/store")
    store = Store(spark, f"{folder}/store", schema, "at")
    for n in range(8):
        batch = spark.createDataFrame([("a", at(n), n), (f"k{n % 3}", at(2, 2), n), (None, None, n)], SCHEMA)
        store.append(lambda state: batch, "one", n)
    fold = lambda df: ingest._current(df, ["k", "at"])
    before = rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k", "at"]))
    assert store.compact(fold) and store.state()[1]["tail"] == []
    assert rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k", "at"])) == before
    store.append(lambda state: spark.createDataFrame([("c", at(5, 3), 9)], SCHEMA), "one", 8)
    after = rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k", "at"]))
    assert ("c", at(5, 3), 9) in after and ("c", at(1, 3), 0) not in after
    assert store.compact(fold) and rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k", "at"])) == after
    assert not store.append(lambda state: 1 / 0, "one", 8)
    store.tidy(keep=1)
    assert len(store.versions.folders(f"{folder}/store")) == 2
    assert rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k", "at"])) == after


def test_what_is_committed_during_compaction_stays(spark, folder):
    df = spark.createDataFrame([("a", at(1), 1)], SCHEMA)
    store = Store(spark, f"{folder}/store", df.schema, "at")
    store.append(lambda state: df, "one", 0)

    def fold(rows_):
        store.append(lambda state: df.withColumn("k", F.lit("b")), "two", 0)
        return rows_

    assert store.compact(fold)
    assert rows(store.read()) == [("a", at(1), 1, 1), ("b", at(1), 1, 2)]


def test_a_long_stream_opens_few_files(spark, folder):
    """Many micro-batches of different days: a read of one day opens its base files and what the tail has of it."""
    schema = spark.createDataFrame([], SCHEMA).schema
    store = Store(spark, f"{folder}/store", schema, "at")
    for n in range(24):
        one = spark.createDataFrame([(f"k{n}", at(1, 1 + n % 12), n)], SCHEMA).coalesce(1)
        store.append(lambda state: one, "one", n)
        store.compact_if_long(tail=10)
    assert len(store.state()[1]["tail"]) < 10 and store.read().count() == 24
    day = store.read(days=("2025-06-03", "2025-06-03"))
    assert day.where("day(at) = 3").count() == 2
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert files(day) <= 4 < files(store.read())


def test_restated_keys(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    seed = [("a", at(1), 1), ("a", at(5), 2), ("b", at(1), 3), (None, at(1), 4)]
    batch = [("a", at(2), 9), (None, at(1), 5)]
    target = spark.createDataFrame(seed, SCHEMA)
    ingest.seed(target, f"{folder}/store")
    landed(spark, f"{folder}/in", batch)
    ingest.ingest_restated(ingest.arrivals(spark, f"{folder}/in", schema), f"{folder}/store", f"{folder}/cp")
    want = load.keyed_replace(target, spark.createDataFrame(batch, SCHEMA), ["k", "at"])
    assert rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k", "at"])) == rows(want)


def test_upserts(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    landed(spark, f"{folder}/in", [("a", at(1), 1), ("a", at(2), 2), ("a", at(3), 3)], [("b", at(1), 7)])
    stream = ingest.arrivals(spark, f"{folder}/in", schema, max_files=1)
    ingest.ingest_upserts(stream, f"{folder}/store", f"{folder}/cp", "k", ["v"])
    assert ingest.rows(spark, f"{folder}/store", schema).count() == 3
    state = ingest.upsert_state(spark, f"{folder}/store", schema, "k", ["v"], ["at"])
    assert rows(state) == [("a", at(3), 1), ("b", at(1), 7)]


def test_failure_windows(spark, folder):
    tasks = spark.createDataFrame([("s", at(1), "failed"), ("s", at(1), "failed"), ("s", at(2), "failed"), ("s", at(2), "stopped")], "service string, at timestamp_ntz, status string")
    tasks.coalesce(1).write.parquet(f"{folder}/in")
    stream = ingest.arrivals(spark, f"{folder}/in", tasks.schema)
    ingest.count_failures(stream, f"{folder}/store", f"{folder}/cp", "at", "service", "status")
    got = ingest.failure_counts(spark, f"{folder}/store", tasks.schema, "at", "service")
    assert rows(got.select("window_start", "service", "failures")) == [(at(1), "s", 2), (at(2), "s", 1)]


def test_codes(spark, folder):
    events = spark.createDataFrame(
        [(7, at(1), 3, "click"), (8, at(2), 3, "click"), (9, at(3), 3, "error")], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
    )
    messages = payloads(events)
    messages.write.parquet(f"{folder}/in")
    ingest.ingest_codes(ingest.arrivals(spark, f"{folder}/in", messages.schema), f"{folder}/log", f"{folder}/cp")
    log = ingest.code_log(spark, f"{folder}/log", messages.schema)
    assert [r["otp_code"] for r in log.orderBy("event_id").collect()] == ["000007", "000008"]
    requests = spark.createDataFrame([("3", at(3))], "phone string, at timestamp_ntz")
    found = lookups.latest_within(requests, log, "phone", "at", "ts", ["otp_code"], 7200)
    assert found.first()["latest_otp_code"] == "000008"


def test_ingest_without_a_seed(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    landed(spark, f"{folder}/in", [("a", at(1), 1), ("a", at(1), 1)])
    ingest.ingest_new(ingest.arrivals(spark, f"{folder}/in", schema), f"{folder}/store", f"{folder}/cp")
    assert rows(ingest.rows(spark, f"{folder}/store", schema)) == [("a", at(1), 1)]


def test_a_running_query_is_returned(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    landed(spark, f"{folder}/in", [("a", at(1), 1)])
    seen = []
    stream = ingest.arrivals(spark, f"{folder}/in", schema)
    query = ingest.run_available(stream, f"{folder}/cp", lambda batch, i: seen.append(batch.count()), every="1 second")
    try:
        query.processAllAvailable()
        assert seen == [1] and query.isActive
    finally:
        query.stop()


def test_streams_of_one_store_leave_each_other_alone(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    ingest.seed(spark.createDataFrame([("a", at(1), 1), ("b", at(1), 2)], SCHEMA), f"{folder}/store")
    for k, batch in enumerate([[("a", at(1), 5)], [("b", at(1), 6)], [("a", at(1), 7)]]):
        landed(spark, f"{folder}/in{k}", batch)
        ingest.ingest_restated(ingest.arrivals(spark, f"{folder}/in{k}", schema), f"{folder}/store", f"{folder}/cp{k}")
    assert rows(ingest.restated_rows(spark, f"{folder}/store", schema, ["k"])) == [("a", at(1), 7), ("b", at(1), 6)]


def test_answers_read_only_the_span_of_the_requests(spark, folder):
    log = spark.createDataFrame([("3", "1", at(1)), ("3", "2", at(9)), ("4", "3", at(9))], "phone string, otp_code string, made timestamp_ntz")
    log.coalesce(1).write.parquet(f"{folder}/log")
    spark.createDataFrame([("3", at(9)), (None, at(9))], "phone string, at timestamp_ntz").write.parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema
    codes = lambda session: session.read.parquet(f"{folder}/log")
    ingest.answer_requests(ingest.arrivals(spark, f"{folder}/in", schema), f"{folder}/store", f"{folder}/cp", codes, "phone", "at", "made")
    assert rows(ingest.answers(spark, f"{folder}/store", schema)) == sorted([("3", at(9), "2"), (None, at(9), None)], key=repr)
