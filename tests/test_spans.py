import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from marketflow.plans.rendered import array_files, small_splits
from marketflow.session import broadcast_if_small, stage
from marketflow.sources import delimited, spans


@pytest.fixture
def tiny(spark):
    """Splits of some hundred bytes."""
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    with small_splits(spark, "300"):
        yield
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def drawn_cells(seed, count):
    draw = random.Random(seed)
    pieces = ["a", " ", ",", '"', "\n", '""', "é", "x,y", "\n\n", '"\n"']
    return [["".join(draw.choice(pieces) for _ in range(draw.randrange(9))) or "-" for _ in range(2)] for _ in range(count)]


@pytest.mark.parametrize("seed", range(2))
def test_quoted_line_breaks_across_splits(spark, land, folder, tiny, seed):
    want = []
    for k in range(2):
        cells = drawn_cells(10 * seed + k, 60)
        out = io.StringIO()
        csv.writer(out, lineterminator="\r\n" if k == 1 else "\n").writerows([["n", "a", "b"], *([f"{k}.{i}", *c] for i, c in enumerate(cells))])
        land(f"f{k}.csv", ('odd " quote\n' * (2 * k) + "p\n" * (7 - 2 * k) + out.getvalue()).encode("cp1252"))
        want += [(f"{k}.{i}", *c) for i, c in enumerate(cells)]
    got = delimited.read_delimited(spark, folder, skip_rows=7, multi_line=True, encoding="auto")
    assert rows(got) == sorted(want, key=repr)


def test_line_breaks_in_the_header_and_mid_field_quotes(spark, land):
    path = land("a.csv", 'p\n\n"x\ny",z\n"two\r\nlines",5" pipe\n3"4",5\n"a"" ""b\n",\n')
    got = delimited.read_delimited(spark, path, skip_rows=1, multi_line=True)
    assert got.columns == ["x\ny", "z"]
    assert rows(got) == sorted([("two\r\nlines", '5" pipe'), ('3"4"', "5"), ('a" "b\n', None)], key=repr)


def test_an_open_quote_is_an_error(spark, land):
    path = land("a.csv", 'x,y\n1,"2\n3,4\n')
    with pytest.raises(spans.BrokenDocument, match="a.csv"):
        delimited.read_delimited(spark, path, multi_line=True)


def test_records_that_go_on_are_noticed(spark, land, folder):
    land("a.csv", 'x,y\n"two\nlines",1\n')
    land("b.csv", "x,y\n3,4\n")
    assert rows(delimited.read_delimited(spark, folder)) == [("3", "4"), ("two\nlines", "1")]
    as_lines = delimited.read_delimited(spark, folder, multi_line=False)
    assert as_lines.count() == 3


def test_files_without_quotes_and_empty_ones(spark, land, folder):
    land("a.csv", "x,y\n1,2\n")
    land("b.csv", "x,y\n")
    assert rows(delimited.read_delimited(spark, folder, multi_line=True)) == [("1", "2")]
    land("empty/c.csv", "")
    with pytest.raises(delimited.EmptyReport):
        delimited.read_delimited(spark, folder + "/empty", multi_line=True)


def drawn_member(draw, depth=0):
    kind = draw.randrange(6 if depth < 3 else 4)
    if kind < 3:
        return draw.choice(["", "{", "}]", '"', "\\", "a\\\"b", "é", "\n", "[{}]", "x" * 50])
    if kind == 3:
        return draw.choice([1, -2.5, True, None])
    if kind == 4:
        return [drawn_member(draw, depth + 1) for _ in range(draw.randrange(4))]
    return {draw.choice("pqr{}\""): drawn_member(draw, depth + 1) for _ in range(draw.randrange(4))}


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.VariantType())])


@pytest.mark.parametrize("seed", range(2))
def test_array_files_across_splits(spark, land, folder, tiny, seed):
    draw = random.Random(seed)
    want = []
    for n in range(4):
        members = [{"k": 1000 * n + i, "v": drawn_member(draw)} for i in range(25)]
        indent = draw.choice([None, 1])
        land(f"f{n}.json", ["", "\ufeff", "  \n", ""][n] + json.dumps(members, indent=indent, ensure_ascii=n % 2 == 0) + ["", "\n", " ", ""][n])
        want += [(m["k"], json.dumps(m["v"], sort_keys=True)) for m in members]
    land("empty.json", " [ ] ")
    got = spans.array_members(spark, folder, SCHEMA).select("k", F.to_json("v").alias("v"))
    found = [(r["k"], json.dumps(json.loads(r["v"]) if r["v"] is not None else None, sort_keys=True)) for r in got.collect()]
    assert sorted(found) == sorted(want)


def test_members_that_are_no_objects_and_broken_files(spark, land):
    path = land("a.json", '[{"k": 1}, 5, "x}", {"k": 2, "v": {"a": {}}}, [1], {"k": 3}, 7]')
    got = rows(spans.array_members(spark, path, SCHEMA).select("k"))
    assert got == [(1,), (2,), (3,)]
    for broken in ('[{"k": 1}', '[{"k": "1}]', '[{"k": {"a": 1}]'):
        with pytest.raises(spans.BrokenDocument):
            spans.array_members(spark, land("b.json", broken), SCHEMA).collect()


def test_one_line_array_is_read_by_many_tasks(spark, land):
    path = land("a.json", json.dumps([{"k": i, "w": "x" * 40} for i in range(5000)]))
    with small_splits(spark, "20k"):
        got = spans.array_members(spark, path, SCHEMA)
        tasks = got.select(F.spark_partition_id().alias("p"), "k").groupBy("p").count().count()
    assert tasks > 1 and got.agg(F.sum("k"), F.count("*")).first()[:] == (12497500, 5000)


def test_splits_of_large_files_do_not_stay_small(spark, land):
    path = land("a.csv", "x" * 99 + "\n" * 1 + ("y" * 99 + "\n") * 160_000)
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    with small_splits(spark):
        assert 50 < spark.read.text(path).rdd.getNumPartitions() <= 70
    assert spark.conf.get(key, None) == before


def test_a_task_writes_one_array_in_pieces(spark):
    numbers = spark.range(0, 25_000, 1, 1)
    path = array_files(numbers, F.to_json(F.struct(F.col("id").alias("k"))), "pieces")
    assert len(spark.read.text(path).inputFiles()) == 1
    with small_splits(spark):
        got = spans.array_members(spark, path, T.StructType([T.StructField("k", T.LongType())]))
        assert got.agg(F.sum("k"), F.count("*"), F.count_distinct("k")).first()[:] == (312487500, 25000, 25000)


def test_frames_over_the_limit_are_not_broadcast_for_their_small_files(spark, land, monkeypatch):
    many = stage(spark.range(5000).select(F.lit("p" * 100).alias("path"), "id"), "many")
    joined = spark.range(10_000_000).join(broadcast_if_small(many, 100_000), "id", "left")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    # Of an array's own frames only those with a row per file or split stay under this limit.
    monkeypatch.setattr(spans, "broadcast_if_small", lambda df: broadcast_if_small(df, 2000))
    path = land("a.json", json.dumps([{"k": i, "v": {"a": {}}} for i in range(500)]))
    with small_splits(spark, "20k"):
        got = spans.array_members(spark, path, SCHEMA)
        assert got._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2
        assert got.agg(F.sum("k"), F.count("*")).first()[:] == (124750, 500)
