"""Physical plans: what is pushed down, what is shuffled, what is never there."""

import pytest
from pyspark.sql import functions as F

from marketflow.operators import load, lookups
from marketflow.plans import catalog
from marketflow.plans.registry import table

SF = "/root/testdata/sf0.001"

# These scan or stream files, or read documents whose writer needs Python.
LAZY = [n for n in catalog.QUERIES if not n.startswith("stream_")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_keyed_replace_does_not_shuffle_the_target(spark):
    target = table(spark, SF, "lineitem")
    batch = spark.createDataFrame([(1, 1)], "l_orderkey bigint, l_partkey bigint")
    plan = plan_of(load.without_keys(target, batch, ["l_orderkey", "l_partkey"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's distinct keys


def test_insert_if_new_filters_the_target_in_place(spark):
    target = table(spark, SF, "lineitem")
    plan = plan_of(load.new_rows(target, target.limit(10)))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_gap_detection_prunes_and_pushes_down(spark):
    orders = table(spark, SF, "orders")
    keys = table(spark, SF, "customer").select(F.col("c_custkey").alias("o_custkey"))
    plan = plan_of(lookups.missing_periods(keys, orders, "o_custkey", "o_orderdate", ["1998-06-01"]))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_calendar_month_is_pushed_down(spark):
    orders = table(spark, SF, "orders")
    plan = plan_of(load.calendar_month_replace(orders, orders.limit(1), "o_orderdate", "1998-06-15"))
    assert "PushedFilters: [Or(Or(IsNull(o_orderdate),LessThan(o_orderdate" in plan


def test_latest_per_key_combines_before_the_shuffle(spark):
    plan = plan_of(lookups.latest_per_key(table(spark, SF, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "partial_max_by" in plan and "Window" not in plan


def test_insert_if_new_reads_only_the_days_of_the_batch(spark):
    orders = table(spark, SF, "orders")
    june = F.date_format("o_orderdate", "yyyy-MM") == "1998-06"
    plan = plan_of(load.new_rows(orders, orders.where(june)))
    scan = next(line for line in plan.splitlines() if "orders.parquet" in line)
    assert "GreaterThanOrEqual(o_orderdate,1998-06-" in scan and "LessThan(o_orderdate,1998-0" in scan


def test_without_broadcast_the_target_is_combined_then_shuffled_once(spark):
    target = table(spark, SF, "lineitem").select("l_orderkey", "l_partkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(load.new_rows(target, target, broadcast_limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
    assert "LeftSemi" not in plan


def test_a_hot_key_is_split_beyond_the_broadcast_limit(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    target = spark.range(0, 60000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    batch = spark.range(0, 60000, 7).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        kept = load.without_keys(target, batch, ["k"], broadcast_limit=0)
        want = kept.count()
        kept.collect()
        assert "isSkew=true" in plan_of(kept) or "skew=true" in plan_of(kept)
        assert want == 60000 - 20000 - sum(1 for i in range(0, 60000, 7) if i % 3)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
