import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketflow.operators import load
from marketflow.operators.projections import Field
from marketflow.sinks import tables
from marketflow.sinks.content import ContentIndex
from marketflow.sinks.manifest import Conflict, Versions


@pytest.fixture
def name(spark):
    name = f"mf_{uuid.uuid4().hex}"
    yield name
    tables.drop_table(spark, name)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "day string, sku string, n bigint")


def test_one_writer_gets_a_version(spark, folder):
    one, two = Versions(spark, folder), Versions(spark, folder)
    assert one.latest() == (-1, {})
    assert one.commit(-1, {"a": 1}) == 0
    with pytest.raises(Conflict):
        two.commit(-1, {"b": 2})
    assert two.latest() == (0, {"a": 1}) and two.commit(0, {"b": 2}) == 1
    # Both see a name that is free until the first gives it; the link is refused to the second.
    one._fs.create(one._path(f"{folder}/draft"), False).close()
    assert not one._named(one._path(f"{folder}/draft"), one._file(1))
    assert one.forget(1) == [{"a": 1}] and one.numbers() == [1]


def test_two_rewrites_of_one_version_conflict(spark, name):
    tables.swap_in(frame(spark, ("d1", "a", 1)), name)
    first = second = tables.table_version(spark, name)
    both = [load.append(spark.table(name), frame(spark, ("d1", sku, 2))) for sku in "bc"]
    tables.replace_table(both[0], name, first)
    with pytest.raises(Conflict):
        tables.replace_table(both[1], name, second)
    assert rows(spark.table(name)) == [("d1", "a", 1), ("d1", "b", 2)]


def test_a_load_that_was_second_is_made_again(spark, name, monkeypatch):
    tables.swap_in(frame(spark, ("d1", "a", 1), ("d1", "b", 1)), name)
    other, real = [frame(spark, ("d1", "b", 5))], load.keyed_replace

    def slow(target, batch, keys, *more):
        # Another load of the same table ends while this one is at work.
        if other:
            tables.replace_keys(other.pop(), name, ["sku"])
        return real(target, batch, keys, *more)

    monkeypatch.setattr(load, "keyed_replace", slow)
    tables.replace_keys(frame(spark, ("d1", "a", 9)), name, ["sku"])
    assert rows(spark.table(name)) == [("d1", "a", 9), ("d1", "b", 5)]


def test_an_append_and_a_rewrite_conflict(spark, name):
    tables.swap_in(frame(spark, ("d1", "a", 1)), name)
    version = tables.table_version(spark, name)
    rewritten = spark.table(name).withColumn("n", F.col("n") + 1)
    tables.append_rows(frame(spark, ("d1", "b", 1)), name)
    with pytest.raises(Conflict):
        tables.replace_table(rewritten, name, version)
    assert spark.table(name).count() == 2


def test_an_interrupted_swap_is_finished(spark, name, monkeypatch):
    tables.swap_in(frame(spark, ("d1", "a", 1)), name)
    with monkeypatch.context() as m:
        m.setattr(tables, "_point", lambda *a: None)
        tables.replace_table(frame(spark, ("d2", "b", 2)), name)
    assert rows(spark.table(name)) == [("d1", "a", 1)]
    tables.table_version(spark, name)
    assert rows(spark.table(name)) == [("d2", "b", 2)]


def test_old_versions_go_and_kept_ones_stay(spark, name):
    tables.swap_in(frame(spark, ("d1", "a", 0)), name)
    for n in range(1, 4):
        tables.replace_table(frame(spark, ("d1", "a", n)), name)
    versions = tables._versions(spark, name)
    before = tables._version_folders(versions)
    held = spark.read.parquet(versions.read(versions.numbers()[-2])["location"])
    tables.tidy_versions(spark, name, keep=2)
    after = tables._version_folders(versions)
    assert len(before) == 4 and len(after) == 2 and rows(held) == [("d1", "a", 2)] and rows(spark.table(name)) == [("d1", "a", 3)]
    tables.drop_table(spark, name)
    assert not tables._version_folders(versions)


def test_a_partitioned_table_keeps_odd_partition_values(spark, name):
    tables.create_table(spark, name, (Field("n", "long"), Field("day")), ["day"])
    odd = spark.createDataFrame([(1, "a b=c/d%"), (2, None), (3, "2025-01-01 10:00")], "n bigint, day string")
    tables.replace_table(odd, name)
    tables.replace_table(odd.where("n > 1"), name)
    assert rows(spark.table(name).select("n", "day")) == [(2, None), (3, "2025-01-01 10:00")]


def test_only_files_that_may_match_are_opened(spark, name, folder):
    tables.create_table(spark, name, (Field("sku"), Field("n", "long")))
    for k in range(3):
        tables.append_content(spark.range(100 * k, 100 * k + 100, 1, 1).select(F.concat(F.lit("s"), "id").alias("sku"), F.col("id").alias("n")), name)
    index = ContentIndex(spark, name, folder, ["sku", "n"])
    some = index.candidates(spark.createDataFrame([("s150", 150), ("s151", 151), ("s999", 999)], "sku string, n bigint"))
    assert len(some.inputFiles()) == 1 and len(spark.table(name).inputFiles()) == 3 and some.count() == 100
    assert index.candidates(spark.createDataFrame([("x", 1)], "sku string, n bigint")).isEmpty()
    indexed = set(spark.read.parquet(index.path).inputFiles())
    tables.append_content(spark.createDataFrame([("s150", 150), ("new", None), ("new", None)], "sku string, n bigint"), name)
    assert spark.table(name).count() == 301
    index.refresh()
    # A later refresh reads the new file only.
    assert indexed < set(spark.read.parquet(index.path).inputFiles())
    assert spark.read.parquet(index.path).where("digest is not null").count() == 301


def test_content_with_stamps_and_replaced_files(spark, name):
    load_of = lambda *data: spark.createDataFrame(list(data), "date string, sku string, n bigint")
    tables.swap_in(load_of(("2025-02-01", "a", 1), ("2025-02-01", "b", 2)), name)
    tables.append_content(load_of(("2025-03-01", "a", 1), ("2025-03-01", "c", 3)), name)
    assert rows(spark.table(name)) == [("2025-02-01", "a", 1), ("2025-02-01", "b", 2), ("2025-03-01", "c", 3)]
    tables.append_content(load_of(("2025-01-01", "b", 2)), name)
    assert rows(spark.table(name)) == [("2025-01-01", "b", 2), ("2025-02-01", "a", 1), ("2025-03-01", "c", 3)]
    tables.append_content(load_of(("2025-04-01", "b", 2)), name)
    assert spark.table(name).count() == 3


def test_upsert_leaves_other_keys_alone(spark):
    target = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    batch = spark.createDataFrame([(5, 1, 1), (5, 2, 2), (2000, 3, 3), (None, 4, 4)], "k bigint, v int, seq int")
    state = load.upsert(target, batch, "k", ["seq"], ["v"])
    assert state.count() == 1002 and rows(state.where("v > 0")) == [(2000, 3), (5, 2), (None, 4)]
    plan = state._jdf.queryExecution().executedPlan().toString()
    untouched = plan[plan.index("LeftAnti") - 200 :]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in untouched.split("LeftSemi")[0].split("Union")[-1]


def test_only_buckets_of_the_batch_are_rewritten(spark, name):
    tables.create_table(spark, name, (Field("k", "long"), Field("status"), Field("made", "long"), Field("bucket", "long")), ["bucket"])
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} (k bigint, status string, made bigint, bucket int) USING parquet PARTITIONED BY (bucket)")
    start = spark.range(64).select(F.col("id").alias("k"), F.lit("new").alias("status"), F.col("id").alias("made"))
    tables.append_rows(start.withColumn("bucket", load.key_bucket("k", 16)), name)
    files = set(spark.table(name).inputFiles())
    batch = spark.createDataFrame([(3, "done", 99, 1), (3, "failed", 98, 2), (100, "new", 5, 1)], "k bigint, status string, made bigint, seq int")
    tables.upsert_keys(batch, name, "k", ["seq"], ["status"], "bucket", 16)
    assert rows(spark.table(name).where("k in (3, 100)").select("k", "status", "made")) == [(100, "new", 5), (3, "failed", 3)]
    assert spark.table(name).count() == 65
    kept = files & set(spark.table(name).inputFiles())
    touched = {r[0] for r in batch.select(load.key_bucket("k", 16)).distinct().collect()}
    assert all(f"bucket={b}/" not in f for f in kept for b in touched) and len(kept) >= 16 - len(touched) - 1
