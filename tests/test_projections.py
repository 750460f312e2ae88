import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from marketflow.operators import projections
from marketflow.operators.projections import Field


def test_kind_of():
    kinds = {"bigint": "long", "int8": "long", "Float64": "double", "decimal(3,1)": "double", "bool": "boolean", "datetime64[ns]": "timestamp", "object": "string", "varchar": "string"}
    assert {k: projections.kind_of(k) for k in kinds} == kinds


def test_stamp_precedence(spark):
    df = spark.range(1).toDF("x")
    assert projections.stamp(df, ref_date="2025-06-01").first()[:] == ("2025-06-01", 0)
    assert projections.stamp(df, period="p", custom_date="2025-01-01", sku="s").columns == ["period", "x"]
    assert projections.stamp(df, custom_date="2025-01-01", sku="s").columns == ["date", "x"]
    assert projections.stamp(df, sku="s").first()[:] == ("s", 0)


def test_stamps_do_not_replace_columns(spark):
    df = spark.createDataFrame([("own", 1)], "date string, x int")
    assert projections.stamp_all(df, add_date="2025-06-01", custom_date="2025-06-02", period="p").columns == ["period", "date", "x"]
    assert projections.stamp(df, ref_date="2025-06-01").first()["date"] == "own"


def test_conform(spark):
    df = spark.createDataFrame(
        [("7", "$1,200.50", "5%", "True", "2025-06-01", "nan", "x"), ("7.5", "bad", "$3", "maybe", "soon", "ok", "y")],
        "n string, price string, share string, flag string, at string, note string, extra string",
    )
    contract = (
        Field("n", "long"), Field("price", "double"), Field("share", "double"), Field("flag", "boolean"),
        Field("at", "timestamp"), Field("note"), Field("gone", "double"),
    )
    got = projections.conform(df, contract)
    assert got.dtypes == [
        ("n", "bigint"), ("price", "double"), ("share", "double"), ("flag", "boolean"), ("at", "timestamp_ntz"),
        ("note", "string"), ("gone", "double"),
    ]
    assert got.collect()[0][:] == (7, 1200.5, 5.0, True, dt.datetime(2025, 6, 1), None, None)
    assert got.collect()[1][:] == (None, None, None, None, None, "ok", None)
    assert projections.dropped_columns(df, contract) == ["extra"]


def test_percent_is_decided_for_the_whole_batch(spark):
    """One percent value in any partition makes it a percent column everywhere."""
    texts = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, "5%").otherwise("$2").alias("c"))
    got = projections.conform(texts, (Field("c", "double"),))
    assert got.where("c is not null").collect()[0][0] == 5.0
    assert got.where("c is null").count() == 999


def test_typed_columns_pass_untouched(spark):
    df = spark.createDataFrame([(1.25, 3)], "d double, n bigint")
    plan = projections.conform(df, projections.contract(d="double", n="long"))._jdf.queryExecution().toString()
    assert "rlike" not in plan.lower()


def test_infer_contract(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", "2025-06-01", "x", None, "7"), ("2", "2", "False", None, "3", None, "nan")],
        "n string, d string, b string, at string, s string, empty string, gaps string",
    )
    kinds = {f.name: f.kind for f in projections.infer_contract(df)}
    assert kinds == {"n": "long", "d": "double", "b": "boolean", "at": "timestamp", "s": "string", "empty": "string", "gaps": "long"}


def test_cloud_types(spark):
    df = spark.createDataFrame([("7", "true")], ["Sessions _ Browser", "IsPrime"])
    assert projections.cloud_types(df, "sales_traffic_daily").first()[:] == (7, True)
    assert projections.cloud_types(df, "other").first()[:] == ("7", True)


def test_contract_of(spark):
    assert rows(spark.createDataFrame([(f.name, f.kind) for f in projections.contract_of(spark.range(1))], ["n", "k"])) == [("id", "long")]
