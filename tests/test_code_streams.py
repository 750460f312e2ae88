import datetime as dt

import pytest

from conftest import rows
from marketflow.streaming import codes, ingest

REQUEST = "id long, phone string, at timestamp_ntz"
CODE = "phone string, otp_code string, made timestamp_ntz"


def at(minute, second=0, day=1):
    return dt.datetime(2025, 6, day, 12, minute, second)


@pytest.fixture
def run(spark, folder):
    schemas = {"asked": spark.createDataFrame([], REQUEST).schema, "made": spark.createDataFrame([], CODE).schema}

    def go(requests=(), found=()):
        for name, data in (("asked", requests), ("made", found)):
            spark.createDataFrame(list(data), schemas[name]).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        streams = [ingest.arrivals(spark, f"{folder}/{name}", schemas[name]) for name in ("asked", "made")]
        codes.answer_as_they_come(*streams, f"{folder}/store", f"{folder}/cp", "phone", "at", "made", late="5 minutes")
        return rows(codes.answered(spark, f"{folder}/store", schemas["asked"]).select("id", "latest_otp_code"))

    return go


def test_a_code_that_lands_after_its_request(run):
    assert run([(1, "a", at(10)), (2, "b", at(10))]) == []
    assert run(found=[("a", "11", at(9, 30)), ("a", "10", at(9, 20)), ("b", "old", at(8, 59))]) == [(1, "11")]
    # A newer code replaces the answer; one made after the request is none.
    assert run(found=[("a", "12", at(9, 50)), ("a", "13", at(10, 1))]) == [(1, "12")]


def test_requests_without_a_code_are_answered_when_none_can_come(run):
    run([(1, "a", at(10)), (2, None, at(10))], [("x", "0", at(10))])
    done = run([(3, "c", at(30))], [("x", "0", at(30))])
    assert done == [(1, None), (2, None)]
    # Behind the watermark, a code comes too late, and so does a request.
    assert run([(4, "a", at(10))], [("a", "1", at(9, 50))]) == done


def test_a_restart_goes_on_with_its_state(run):
    run([(1, "a", at(10))])
    run([(2, "b", at(11))])
    assert run(found=[("b", "2", at(10, 59)), ("a", "1", at(10))]) == [(1, "1"), (2, "2")]
