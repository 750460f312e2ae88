import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketflow.llm import language

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["stra", "tung", "ber"], "cc": ["ée", "oux", "gne"], "dd": ["zy", "krz", "sz"], "ee": ["th", "ing", "ow"],
             "ff": ["uu", "kk", "öi"], "gg": ["nya", "ong", "ra"]}
SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def prose(lang, seed, words=30):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randrange(1, 4))) for _ in range(words))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    codes = language.fit(docs, ~language.held_out())
    got = language.predict(docs, codes).join(docs.select("doc_id", "lang"), "doc_id").withColumn("h", language.held_out()).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["h"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


@pytest.mark.parametrize("count", [2, 3, 5, 7])
def test_languages_are_told_apart(spark, count):
    langs = list(SYLLABLES)[:count]
    rows = [(k, prose(lang, k), lang) for k, lang in enumerate(langs * 40)]
    docs = frame(spark, rows)
    codes = language.fit(docs, F.col("doc_id") < 20 * count)
    got = {r["doc_id"]: r for r in language.predict(docs, codes).collect()}
    assert sum(got[k]["lang_pred"] == lang for k, _, lang in rows[20 * count :]) >= 0.97 * 20 * count


def test_only_learned_rows_count_and_repeats_stay(spark):
    rows = [(k, prose(lang, k), lang) for k, lang in enumerate(("aa", "bb") * 20)]
    learned = F.col("doc_id") < 30
    a = language.fit(frame(spark, rows), learned)
    b = language.fit(frame(spark, rows[:30] + [(k, t, "cc") for k, t, _ in rows[30:]]), learned)
    assert a.languages == b.languages == ["aa", "bb"] and np.array_equal(a.odds, b.odds)
    assert language.predict(frame(spark, rows[:1] * 3), a).count() == 3


def test_defined_cases(spark):
    rows = [(1, prose("aa", 1), "aa"), (2, prose("bb", 2), "bb"), (3, None, "aa"), (4, "", "bb"), (5, "12 -- ?", "aa"), (None, prose("aa", 3), "aa"),
            (6, prose("aa", 4), None), (7, "a", "aa"), (8, prose("bb", 5, 30_000), "bb"), (9, "\U0001f600 中文", None)]
    docs = frame(spark, rows)
    got = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs, F.lit(True))).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5))
    assert got[8]["lang_pred"] == "bb" and got[6]["lang_pred"] == "aa" and got[7]["lang_pred"] != "und"
    none = language.fit(docs, F.lit(False))
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    one = language.fit(docs, F.col("doc_id") == 1)
    assert {(r["lang_pred"], r["score"]) for r in language.predict(docs, one).collect()} == {("aa", 1.0), ("und", 0.0)}
    assert language.predict(frame(spark, []), none).collect() == []


def test_codewords_differ():
    assert language.codewords(4).shape == (4, 7)
    for count in (2, 3, 5, 9, 40):
        words = language.codewords(count).astype(int)
        apart = (words[:, None] != words[None]).sum(axis=2) + np.eye(count, dtype=int) * 99
        assert apart.min() >= max(1, words.shape[1] // 4)


def test_weighted_decoding_corrects_a_wrong_bit():
    codes = language.fit_counts(list("abcd"), np.ones((4, language.BINS)))
    margins = codes.words[2].astype(float) * language.CLIP
    margins[0] *= -1
    assert codes.decode(margins[None])[0][0] == 2


def test_a_foreign_passage_is_outvoted_and_flagged(spark):
    rows = [(k, prose(lang, k, 200), lang) for k, lang in enumerate(("aa", "bb", "cc") * 30)]
    codes = language.fit(frame(spark, rows), F.lit(True))
    mixed = frame(spark, [(1, prose("aa", 1, 600) + " " + prose("bb", 2, 300), None), (2, prose("aa", 3, 900), None)])
    got = {r["doc_id"]: r for r in language.predict(mixed, codes).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "aa"
    assert got[1]["score"] < got[2]["score"] and got[1]["ambiguous"]
