"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
import check
from marketflow.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_month", "o_orderstatus", "orders", "revenue"] and df.count() > 0


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note
