import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketflow.operators import dedup, load

SCHEMA = "sku string, ts timestamp_ntz, price double, n int"


def at(text):
    return dt.datetime.fromisoformat(text)


def random_rows(seed, size=200):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    return [
        (
            pick("a", "b", "c", None),
            pick(at("2025-06-01T00:00"), at("2025-06-01T12:30"), at("2025-06-02T00:00"), None),
            pick(1.0, 2.5, None),
            pick(1, 2, None),
        )
        for _ in range(size)
    ]


def day(value):
    return value.date() if isinstance(value, dt.datetime) else value


def expected_insert(target, batch, by_day=True):
    key = (lambda r: tuple(map(day, r))) if by_day else (lambda r: r)
    have = {key(r) for r in target}
    return sorted(target + [r for r in set(batch) if key(r) not in have], key=repr)


@pytest.mark.parametrize("limit", [load.BROADCAST_LIMIT, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_insert_if_new_against_brute_force(spark, seed, limit):
    target, batch = random_rows(seed, 12), random_rows(seed + 10)
    t, b = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA)
    assert rows(load.insert_if_new(t, b, broadcast_limit=limit)) == expected_insert(target, batch)
    exact = load.insert_if_new(t, b, granularity="exact", broadcast_limit=limit)
    assert rows(exact) == expected_insert(target, batch, by_day=False)


def test_insert_if_new_twice_is_once(spark):
    t = spark.createDataFrame(random_rows(3, 10), SCHEMA)
    b = spark.createDataFrame(random_rows(4), SCHEMA)
    once = load.insert_if_new(t, b)
    assert rows(load.insert_if_new(once, b)) == rows(once)


def test_insert_into_an_empty_table(spark):
    b = spark.createDataFrame(random_rows(4), SCHEMA)
    assert rows(load.insert_if_new(b.limit(0), b)) == rows(b.distinct())


def test_insert_is_independent_of_partitioning(spark):
    t = spark.createDataFrame(random_rows(5, 10), SCHEMA)
    b = spark.createDataFrame(random_rows(6), SCHEMA)
    one = load.insert_if_new(t.coalesce(1), b.coalesce(1))
    many = load.insert_if_new(t.repartition(7), b.repartition(5))
    assert rows(one) == rows(many)


def test_negative_zero_and_nan_are_compared_by_value(spark):
    t = spark.createDataFrame([(0.0,), (float("nan"),)], "x double")
    b = spark.createDataFrame([(-0.0,), (float("nan"),), (1.0,)], "x double")
    assert load.new_rows(t, b).collect()[0][0] == 1.0
    assert load.new_rows(t, b).count() == 1


def test_wide_tables_plan_quickly(spark):
    wide = spark.range(10).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(120)])
    assert load.new_rows(wide, wide.union(wide.select(*[F.col(c) + 100 for c in wide.columns]))).count() == 10


@pytest.mark.parametrize("limit", [load.BROADCAST_LIMIT, 0])
def test_keyed_replace_against_brute_force(spark, limit):
    target, batch = random_rows(7), random_rows(8, 6)
    t, b = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA)
    taken = {(r[0], day(r[1])) for r in batch if r[0] is not None and r[1] is not None}
    kept = [r for r in target if (r[0], day(r[1])) not in taken]
    assert rows(load.keyed_replace(t, b, ["sku", "ts"], limit)) == sorted(kept + list(set(batch)), key=repr)


def test_keyed_replace_replay(spark):
    keyed = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    batch = spark.createDataFrame([("a", 5), ("a", 6)], "k string, v int")
    once = load.keyed_replace(keyed, batch, ["k"])
    assert rows(once) == [("a", 5), ("a", 6), ("b", 3)]
    assert rows(load.keyed_replace(once, batch, ["k"])) == rows(once)
    # Null keys never match, so they pile up; the count of them is reported.
    unkeyed = spark.createDataFrame([(None, 5)], "k string, v int")
    grown = load.keyed_replace(load.keyed_replace(keyed, unkeyed, ["k"]), unkeyed, ["k"])
    assert grown.count() == 5
    assert load.null_key_rows(unkeyed, ["k"]).first()[0] == 1


def test_month_replace(spark):
    schema = "id int, at timestamp_ntz"
    target = [(1, at("2025-05-31T23:59")), (2, at("2025-06-01T00:00")), (3, at("2024-06-10T00:00")), (4, None)]
    batch = [(9, at("2025-06-30T12:00")), (9, at("2025-06-30T12:00")), (4, None), (5, None)]
    t, b = spark.createDataFrame(target, schema), spark.createDataFrame(batch, schema)
    expected = sorted([target[0], target[2], target[3], batch[0], (5, None)], key=repr)
    assert rows(load.month_replace(t, b, "at")) == expected
    assert rows(load.month_replace(load.month_replace(t, b, "at"), b, "at")) == expected


def test_calendar_month_replace_deletes_the_reference_month(spark):
    schema = "id int, at timestamp_ntz"
    t = spark.createDataFrame([(1, at("2025-06-10T00:00")), (2, at("2025-05-10T00:00"))], schema)
    b = spark.createDataFrame([(3, at("2025-05-11T00:00"))], schema)
    state = load.calendar_month_replace(t, b, "at", "2025-06-02")
    assert rows(state) == [(2, at("2025-05-10T00:00")), (3, at("2025-05-11T00:00"))]


def test_upsert_keeps_first_and_takes_last(spark):
    t = spark.createDataFrame([("t1", "svc", "old", "d0")], "id string, service string, status string, note string")
    b = spark.createDataFrame(
        [("t1", "other", "started", "d1", 1), ("t1", "other", "failed", None, 2), ("t2", "x", "started", "a", 1), ("t2", "y", "stopped", "b", 3)],
        "id string, service string, status string, note string, seq int",
    )
    assert rows(load.upsert(t, b, "id", ["seq"], ["status", "note"])) == [
        ("t1", "svc", "failed", None), ("t2", "x", "stopped", "b"),
    ]


def test_append_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert rows(load.append(a, b)) == [(1, "x"), (2, None)]
    assert load.truncate_load(a, spark.createDataFrame([("3", 9)], "a string, c int")).collect()[0][:] == (3, None)


def test_dedup_loads(spark):
    df = spark.createDataFrame(
        [("2025-06-02", "p2", "a", 1.5), ("2025-06-01", "p1", "a", 1.5), ("2025-06-01", "p1", "b", None), ("2025-06-03", None, "b", None)],
        "date string, period string, k string, v double",
    )
    assert rows(dedup.dedup_loads(df)) == [("2025-06-01", "p1", "a", 1.5), ("2025-06-01", "p1", "b", None)]
    assert dedup.dedup_loads(df.select("k", "v")).count() == 2
    assert dedup.count_rows(df).first()[0] == 4


def test_one_hot_key(spark):
    """A third of the target shares one key; nothing is lost on either join path."""
    target = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    batch = spark.createDataFrame([(0, -1), (1, -2)], "k bigint, v bigint")
    for limit in (load.BROADCAST_LIMIT, 0):
        state = load.keyed_replace(target, batch, ["k"], limit)
        assert state.count() == 3000 - 1000 - 1 + 2
        assert load.new_rows(target, target, broadcast_limit=limit).count() == 0


def test_types_that_differ_are_compared_by_value(spark):
    target = spark.createDataFrame([(1, "x")], "n int, s string")
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "n bigint, s string")
    assert rows(load.new_rows(target, batch)) == [(2, "y")]
    with pytest.raises(TypeError):
        load.new_rows(target, spark.createDataFrame([("1", "x")], "n string, s string"))


def test_new_rows_of_a_large_batch_are_not_joined_where_no_digest_agrees(spark):
    target = spark.createDataFrame([(1, "a"), (2, None)], "k long, t string")
    fresh = spark.createDataFrame([(3, "a"), (2, "b"), (4, None)], "k long, t string")
    new = load.new_rows(target, fresh, broadcast_limit=1)
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString()
    assert rows(new) == rows(fresh)


@pytest.mark.parametrize("limit", [1, 30, load.BROADCAST_LIMIT])
def test_rows_of_agreeing_digests_and_repeated_ones_are_compared(spark, limit):
    target = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "k long, t string")
    fresh = spark.createDataFrame([(3, "a"), (3, "a"), (2, "b"), (4, None), (4, None), (2, None)], "k long, t string")
    assert rows(load.new_rows(target, fresh, broadcast_limit=limit)) == sorted([(2, "b"), (4, None)], key=repr)


def test_a_large_batch_is_compared_in_slices(spark, monkeypatch):
    monkeypatch.setattr(load, "_SLICE_BYTES", 2000)
    target, batch = random_rows(5, 12), random_rows(15)
    t, b = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA)
    for granularity in ("day", "exact"):
        new = load.new_rows(t, b, granularity, broadcast_limit=1)
        # What is left to do is reading the new rows of every slice.
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("FileScan") > 1
        assert rows(new.union(t)) == expected_insert(target, batch, granularity == "day")


def test_rows_are_shuffled_once_for_the_comparison(spark):
    b = spark.createDataFrame([(1, "a", at("2025-06-01T12:30")), (2, "b", None)], "k long, t string, ts timestamp_ntz")
    new = load.new_rows(b.where("k = 1"), b, broadcast_limit=0)
    plan = new._jdf.queryExecution().executedPlan().toString()
    batch = next(line for line in plan.splitlines() if "xxhash64(_identity" in line)
    assert "ts#" in batch and "k#" not in batch and " t#" not in batch
    assert rows(new) == [(2, "b", None)]
