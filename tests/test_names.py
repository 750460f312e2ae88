import string

import pytest
from hypothesis import given
from hypothesis import strategies as st

from marketflow.functions import names


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Date / Time", "date_time"),
        ("Sessions - Total", "sessions_total"),
        ("Unit Session Percentage", "unit_session_pct"),
        ("Share %", "share_percent"),
        ("7 Day Sales", "col_7_day_sales"),
        ("__x__", "x"),
        ("a" * 80, "a" * 63),
        ("%", "percent"),
        ("", ""),
    ],
)
def test_warehouse_name(raw, clean):
    assert names.warehouse_name(raw) == clean


@pytest.mark.parametrize(
    "raw, clean",
    [("campaignName14d", "campaign_name_14d"), ("ASINCount", "asincount"), ("7d", "7d"), ("aB1c", "a_b_1c"), ("adStatus14D", "ad_status_14d")],
)
def test_snake_case(raw, clean):
    assert names.snake_case(raw) == clean


def test_camel_then_clean():
    assert names.warehouse_name("salesByAsin (30d)", camel=True) == "sales_by_asin_30d"


def test_cloud_name_keeps_case_and_spaces():
    assert names.cloud_name("Sessions - Browser") == "Sessions _ Browser"
    assert names.cloud_name("x" * 200) == "x" * 128


def test_simple_and_share_names():
    assert names.simple_name("Choice Badge") == "choice_badge"
    assert names.share_name("A  B") == "a_b"
    assert names.share_name("A____B") == "a__b"


@given(st.text(string.printable, max_size=90))
def test_warehouse_names_are_identifiers(raw):
    name = names.warehouse_name(raw)
    assert len(name) <= 63
    assert "__" not in name
    assert not (set(name) & set(string.punctuation) - {"_"})
    assert name[:1] not in set(string.digits)


def test_collision_names_both_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a-b"])
    with pytest.raises(names.NameCollision, match="a b.*a-b"):
        names.clean_names(df)


def test_repeated_columns_keep_the_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"]).toDF("a", "b", "a")
    kept = names.keep_first_of_repeated(df)
    assert kept.columns == ["a", "b"] and kept.first()[:] == (1, 2)


def test_header_names():
    assert names.header_names(["a", "", "a", "a", None]) == ["a", "Unnamed: 1", "a.1", "a.2", "Unnamed: 4"]


def test_search_performance_map():
    assert len(names.SEARCH_PERFORMANCE_COLUMNS) == 33
    assert len(set(names.SEARCH_PERFORMANCE_COLUMNS.values())) == 33


def test_repeat_purchase(spark):
    assert names.rename_repeat_purchase(spark.range(1).toDF("amount")).columns == ["repeat_purchase_revenue"]
