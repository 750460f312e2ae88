import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from marketflow.operators.projections import Field, contract
from marketflow.session import measured_bytes, shared_folder
from marketflow.sinks import tables


@pytest.fixture
def name(spark):
    name = f"mf_{uuid.uuid4().hex}"
    yield name
    tables.drop_table(spark, name)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "day string, sku string, n bigint")


def test_create_append_drop(spark, name):
    tables.create_schema(spark, "mf_schema")
    tables.create_table(spark, name, (Field("day"), Field("sku"), Field("n", "long")))
    tables.create_table(spark, name, contract(other="long"))
    tables.append_rows(frame(spark, ("d1", "a", 1)).select("n", "sku", "day"), name)
    assert rows(spark.table(name)) == [("d1", "a", 1)]
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_replace_reads_the_table_it_writes(spark, name):
    tables.swap_in(frame(spark, ("d1", "a", 1), ("d1", "a", 1)), name)
    tables.replace_table(spark.table(name).union(spark.table(name)), name)
    assert spark.table(name).count() == 4
    tables.dedup_table(spark, name)
    assert spark.table(name).count() == 1


def test_insert_new_leaves_files_alone(spark, name):
    tables.swap_in(frame(spark, ("d1", "a", 1)), name)
    before = set(spark.table(name).inputFiles())
    batch = frame(spark, ("d1", "a", 1), ("d2", "a", 1))
    for _ in range(2):
        tables.insert_new(batch, name)
    assert rows(spark.table(name)) == [("d1", "a", 1), ("d2", "a", 1)]
    assert before <= set(spark.table(name).inputFiles())


def test_only_touched_partitions_are_written(spark, name):
    tables.create_table(spark, name, (Field("sku"), Field("n", "long"), Field("day")), ["day"])
    tables.append_rows(frame(spark, ("d1", "a", 1), ("d2", "a", 2), ("d2", "b", 3)), name)
    untouched = {f for f in spark.table(name).inputFiles() if "day=d1" in f}
    tables.replace_keys_in_partitions(frame(spark, ("d2", "a", 9), ("d3", "c", 4)), name, ["day", "sku"], "day")
    assert rows(spark.table(name).select("day", "sku", "n")) == [("d1", "a", 1), ("d2", "a", 9), ("d2", "b", 3), ("d3", "c", 4)]
    assert untouched <= set(spark.table(name).inputFiles())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError):
        tables.replace_keys_in_partitions(frame(spark), name, ["sku"], "day")


def test_replace_keys_and_copy(spark, name):
    tables.swap_in(frame(spark, ("d1", "a", 1), ("d1", "b", 2)), name)
    tables.replace_keys(frame(spark, ("d1", "a", 7)), name, ["day", "sku"])
    assert rows(spark.table(name)) == [("d1", "a", 7), ("d1", "b", 2)]
    tables.copy_table(spark, name, f"{name}_copy")
    assert spark.table(f"{name}_copy").count() == 2
    tables.drop_table(spark, f"{name}_copy")


def test_exports(spark, folder):
    df = frame(spark, ("d1", "a", 1)).withColumn("at", F.lit("2025-06-01 10:00:00").cast("timestamp_ntz"))
    tables.export_csv(df, f"{folder}/csv")
    tables.export_json(df, f"{folder}/json")
    assert spark.read.csv(f"{folder}/csv", header=True).columns == ["day", "sku", "n", "at"]
    assert spark.read.json(f"{folder}/json").first()["at"] == "2025-06-01 10:00:00"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abcd",), (None,)], "x string")
    assert measured_bytes(df) == 2 * 24 + 4
    assert measured_bytes(df.limit(0)) == 0


def test_partitioned_tables_are_rewritten_whole(spark, name):
    data = [("d1", "a", 1), ("d2", "a", 1), ("d2", "b", 2), ("it's", "c", 3), (None, "d", 4)]
    frame(spark, *data).write.partitionBy("day").saveAsTable(name)
    tables.replace_table(frame(spark, ("d2", "x", 9), (None, "y", 8)), name)
    assert rows(spark.table(name).select("day", "sku", "n")) == sorted([("d2", "x", 9), (None, "y", 8)], key=repr)
    tables.append_rows(frame(spark, ("d2", "x", 9)), name)
    tables.dedup_table(spark, name)
    assert rows(spark.table(name).select("day", "sku", "n")) == sorted([("d2", "x", 9), (None, "y", 8)], key=repr)


def test_two_threads_replace_partitions_of_two_tables(spark, name):
    from concurrent.futures import ThreadPoolExecutor

    names = [f"{name}_{k}" for k in range(2)]
    for n in names:
        frame(spark, ("d1", "a", 1), ("d2", "b", 2)).write.partitionBy("day").saveAsTable(n)
    with ThreadPoolExecutor(2) as pool:
        for _ in range(3):
            list(pool.map(lambda n: tables.replace_partitions(frame(spark, ("d2", "c", 3)), n), names))
    for n in names:
        assert rows(spark.table(n).select("day", "sku", "n")) == [("d1", "a", 1), ("d2", "c", 3)]
        tables.drop_table(spark, n)


def test_append_content(spark, name):
    load = lambda *data: spark.createDataFrame(list(data), "sku string, date string")
    load(("a", "2025-06-02")).write.saveAsTable(name)
    files = set(spark.table(name).inputFiles())
    tables.append_content(load(("a", "2025-06-03"), ("b", "2025-06-03"), ("b", "2025-06-04")), name)
    assert rows(spark.table(name)) == [("a", "2025-06-02"), ("b", "2025-06-03")] and files <= set(spark.table(name).inputFiles())
    tables.append_content(load(("a", "2025-06-01")), name)
    assert rows(spark.table(name)) == [("a", "2025-06-01"), ("b", "2025-06-03")]
