import numpy as np
import pytest
from conftest import rows

from support import docs, prose  # noqa: F401
from marketflow.llm import quality


def brute(text):
    found = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    twice = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(twice)


TEXTS = [
    None, "", "  \n\t ", "one", "a b c d e f g h " * 3, "x\n\nx\ny\nx \n", "é#ü|<> 日本 *$%&", prose(1, 50) + "\n" + prose(1, 50),
    "a " * 40, " nbsp  stays", "\x1cno blank\x1d",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_equal_brute_force(text):
    assert quality.rule_counts(text)[:5] == brute(text)


def test_paths_set_outliers_apart():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (1000, 5)), rng.normal(9, 1, (50, 5))])
    good = np.r_[np.ones(1000, bool), np.zeros(50, bool)]
    forest = quality.fit_arrays(x, good, np.ones(len(x), bool))
    rejected = forest.scores(x) > forest.limit
    assert rejected[1000:].mean() > 0.95 and rejected[:1000].mean() <= 0.003
    assert (forest.scores(x) == forest.scores(x.copy())).all()


def test_without_labels_only_the_base_rules_reject(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    frame = docs([(1, None), (2, prose(2, 30)), (None, prose(2, 30)), (3, "a " * 40)])
    forest = quality.fit(frame, labels)
    judged = quality.judge(frame, forest)
    got = {(r["doc_id"], r["base_failed"], r["kept"]) for r in judged.collect()}
    assert got == {(1, True, False), (2, False, True), (None, False, True), (3, True, False)}
    kept = quality.keep_good(frame, forest)
    assert kept.columns == frame.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2]
    assert quality.judge(frame.limit(0), forest).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    train, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").select("doc_id", "quality")
    judged = quality.judge(docs.join(held, "doc_id", "left_semi"), quality.fit(docs, train)).where("not base_failed")
    found = rows(judged.join(held, "doc_id").groupBy("quality", "kept").count())
    counts = {(q, k): n for q, k, n in found}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.1 * counts[0, False]
