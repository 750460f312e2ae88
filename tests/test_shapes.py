import pytest

from conftest import rows
from marketflow.operators import shapes
from marketflow.sources import documents


def cells(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, cell string")


def test_leaves_of_undeclared_records(spark):
    df = cells(
        spark, '{"a": 1, "in": {"b": "x", "in": {"c": true}}}', "{'a': 2.5, 'price': {'amount': 3, 'currencyCode': 'USD'}, 'l': [1, 2]}",
        "{'a': None, 's': 'it\\'s \"quoted\"'}", "no record", None,
    )
    got = shapes.flatten_unknown(df, ["cell"])
    assert got.dtypes == [
        ("id", "int"), ("a", "double"), ("b", "string"), ("c", "boolean"), ("l", "array<bigint>"), ("price", "bigint"), ("s", "string"),
    ]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (0, 1.0, "x", True, None, None, None), (1, 2.5, None, None, [1, 2], 3, None), (2, None, None, None, None, None, 'it\'s "quoted"'),
        (3, None, None, None, None, None, None), (4, None, None, None, None, None, None),
    ]


def test_members_of_mixed_kinds(spark):
    df = cells(spark, '{"m": {"x": 1, "y": {"z": 2}}}', '{"m": "text"}', '{"m": {"x": "one", "y": 7}}', '{"m": [1, "a"]}', '{"m": null}')
    got = shapes.flatten_unknown(df, ["cell"])
    found = {r["id"]: r.asDict() for r in got.collect()}
    assert {k: found[0][k] for k in ("x", "z")} == {"x": "1", "z": 2}
    assert found[1]["m"] == "text" and found[2]["x"] == "one" and found[2]["y"] == 7 and found[3]["m"] == '[1,"a"]' and found[4]["m"] is None


def test_equal_leaf_names_and_names_of_other_columns(spark):
    df = cells(spark, '{"a": {"v": 1}, "b": {"v": 2}}', '{"a": {"v": 3}}').withColumnRenamed("id", "v")
    got = shapes.flatten_unknown(df, ["cell"])
    assert got.columns == ["v"] and rows(got) == [(2,), (3,)]


def test_odd_names(spark):
    df = cells(spark, '{"a b": {"c.d": 1, "e`f": 2, "it\'s": 3, "x<y>": 4}}')
    assert shapes.flatten_unknown(df, ["cell"]).drop("id").first().asDict() == {"c.d": 1, "e`f": 2, "it's": 3, "x<y>": 4}


def test_documents_of_undeclared_shape(spark):
    df = spark.createDataFrame([('[{"k": 1, "d": {"n": "x"}}]',), ('{"note": 1, "rows": [{"k": 2}, {"k": 2.5}]}',), ('{"k": 4}',)], "document string")
    got = documents.discovered_records(df)
    assert rows(got.select("k", "n")) == sorted([(1.0, "x"), (2.0, None), (2.5, None), (4.0, None)], key=repr)


@pytest.mark.parametrize("texts", [(), (None,), ("[]",), ("{}",)])
def test_nothing_to_find(spark, texts):
    assert shapes.flatten_unknown(cells(spark, *texts), ["cell"]).columns == ["id"]
