import time

import pytest
from conftest import rows
from support import prose

from marketflow.llm import chats

SCHEMA = "conv_id long, turn long, role string, text string, row string, thread string"
TALK = [
    (1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "assistant", "Fine thanks.\nAnd you?"), (1, 2, "user", "> How are you?\nI mean really."),
    (1, 3, "user", "Unrelated."), (1, 4, "assistant", "On Monday X wrote:\n> > how  are you?\n> I mean really.\n\nWell ok."),
    (1, 5, "user", ">> And   you?\nThird."), (1, 6, "user", "> nobody said this\nhm"), (2, 0, None, None), (None, 1, "u", "> a"), (None, 0, "u", "a"),
    (None, None, "u", "> a\n\nx"), (2, 1, "u", "5 > 3"), (2, 1, "u", "5 > 3"),
]
WANT = [
    (1, 0, "user", None, 0, 0, 0, 0, "Hello there.\nHow are you?"), (1, 2, "user", 0, 0, 1, 1, 1, "I mean really."),
    (1, 4, "assistant", 2, 0, 2, 2, 2, "Well ok."), (1, 1, "assistant", None, 1, 3, 0, 0, "Fine thanks.\nAnd you?"),
    (1, 5, "user", 1, 1, 4, 1, 1, "Third."), (1, 3, "user", None, 3, 5, 0, 0, "Unrelated."), (1, 6, "user", None, 6, 6, 1, 0, "hm"),
    (2, 0, None, None, 0, 0, 0, 0, ""), (2, 1, "u", None, 1, 1, 0, 0, "5 > 3"), (2, 1, "u", None, 1, 2, 0, 0, "5 > 3"),
    (None, 0, "u", None, 0, 0, 0, 0, "a"), (None, 1, "u", 0, 0, 1, 1, 1, ""), (None, None, "u", 0, 0, 2, 1, 1, "x"),
]


@pytest.mark.parametrize("span", [1024, 2])
def test_quotations_link_replies(spark, monkeypatch, span):
    monkeypatch.setattr(chats, "RANGE", span)
    frame = spark.createDataFrame([(*t, "x", "x") for t in TALK], SCHEMA)
    assert rows(chats.reply_ordered(frame)) == sorted(WANT, key=repr)


def test_long_threads_and_whole_passages(spark):
    talk = [(7, 0, "u", "line one\nline two")]
    talk += [(7, k, "u", "> " + (f"answer {k - 1}" if k > 1 else "line one line two") + f"\nanswer {k}") for k in range(1, 40)]
    found = chats.reply_ordered(spark.createDataFrame([(*t, "x", "x") for t in talk], SCHEMA)).orderBy("position").collect()
    assert [r["reply_to"] for r in found] == [None, *range(39)] and {r["thread"] for r in found} == {0}
    assert [r["position"] for r in found] == list(range(40))


def test_empty_and_plain(spark):
    plan = chats.reply_ordered(spark.createDataFrame([], SCHEMA))
    assert plan.count() == 0 and "Python" not in plan._jdf.queryExecution().toString()


def test_parts_of_lines_and_wrapped_quotations_link(spark):
    long = "We should move the nightly load to the second cluster because the first one is full. Nobody objects so far, I think. Shall we?"
    talk = [
        (1, 0, "u", "Hello there. How are you?"), (1, 1, "a", "> How are you?\nFine."), (1, 2, "u", long), (1, 3, "a", "the second cluster because of cost"),
        (1, 4, "u", "> load to the second cluster because\n> the first one is full. Nobody\n> objects so\n\nYes."), (1, 5, "a", "> Nobody\n> objects so far, I think.\n\nI do."),
        (1, 6, "u", "> second cluster, because the moon shines\nno"), (1, 7, "u", "> there\nWhere?"), (1, 8, "u", "> Shall we? Fine.\nok"),
    ]
    found = {r["turn"]: r for r in chats.reply_ordered(spark.createDataFrame([(*t, "x", "x") for t in talk], SCHEMA)).collect()}
    assert [found[k]["reply_to"] for k in range(9)] == [None, 0, None, None, 2, 2, None, 0, 2]
    assert found[4]["message"] == "Yes." and found[5]["thread"] == 2


def test_the_original_covers_most(spark):
    words = [f"w{k}" for k in range(20)]
    talk = [(1, 0, "u", "so " + " ".join(words) + " end"), (1, 1, "a", " ".join(words[:13])), (1, 2, "a", " ".join(words[7:]))]
    talk.append((1, 3, "u", "> " + " ".join(words[:9]) + "\n> " + " ".join(words[9:]) + "\nyes"))
    found = {r["turn"]: r["reply_to"] for r in chats.reply_ordered(spark.createDataFrame([(*t, "x", "x") for t in talk], SCHEMA)).collect()}
    assert found[3] == 0


def test_null_conversations_are_none_of_the_named_ones(spark):
    talk = [(None, 1, "u", "said by nobody in particular"), ("none", 2, "u", "> said by nobody in particular\nreply")]
    got = chats.reply_ordered(spark.createDataFrame(talk, "conv_id string, turn long, role string, text string")).collect()
    assert {(r["conv_id"], r["reply_to"], r["n_linked"]) for r in got} == {(None, None, 0), ("none", None, 0)}


def test_a_long_quotation_is_linked_in_time(spark):
    body = prose(7, 20_000)
    talk = [(1, 0, "u", body), (1, 1, "u", "other words"), (1, 2, "u", "> " + body + "\nagreed")]
    start = time.monotonic()
    got = chats.reply_ordered(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()
    assert {(r["turn"], r["reply_to"], r["message"]) for r in got if r["turn"]} == {(1, None, "other words"), (2, 0, "agreed")}
    assert time.monotonic() - start < 60
