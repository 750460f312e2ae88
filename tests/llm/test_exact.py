import numpy as np
import pytest
from pyspark.sql import functions as F

from support import docs  # noqa: F401

from marketflow.llm import exact, fuse

PAIRS = [
    (5, "a b"), (3, "ab"), (9, "a  b"), (4, None), (2, ""), (8, " \n"), (1, "other"), (None, "ab"), (7, "ab c"), (7, "ab c"),
    (6, "é x"), (10, "éx "), (11, "a\x0bb  "), (12, "x" * 100_000),
]


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((i, t or ""))
    out = []
    for members in groups.values():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        done = False
        for i, t in members:
            kept = (i, t) == best and not done
            done |= kept
            out.append((i, best[0], len(members), kept))
    return sorted(out, key=repr)


def verdicts(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_equals_brute_force(docs, monkeypatch, weak):
    if weak:  # digests that stand for several texts
        monkeypatch.setattr(exact, "digest", lambda text: F.sha2(F.substring(exact.normalised(text), 1, 1), 256))
    assert verdicts(exact.duplicates(docs(PAIRS))) == brute(PAIRS)
    kept = exact.keep_first(docs(PAIRS))
    want = sorted([i for i, _, _, k in brute(PAIRS) if k], key=repr)
    assert kept.columns == docs([]).columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


@pytest.mark.parametrize("weak", [False, True])
def test_rows_of_one_id_that_differ_in_blanks(docs, monkeypatch, weak):
    if weak:
        monkeypatch.setattr(exact, "digest", lambda text: F.sha2(F.substring(exact.normalised(text), 1, 1), 256))
    pairs = [(1, "a b"), (1, "ab "), (None, "c d"), (None, "cd "), (2, "ax"), (3, "a x")]
    kept = exact.keep_first(docs(pairs)).collect()
    assert sorted((r["text"].replace(" ", "") for r in kept)) == ["ab", "ax", "cd"]
    assert [r["doc_id"] for r in kept if "x" in r["text"]] == [3]


def test_a_named_snapshot_and_empty_tables(docs):
    assert verdicts(exact.duplicates(docs(PAIRS), arrives=F.col("id") > 5)) == brute(PAIRS)
    assert exact.duplicates(docs([])).count() == 0 and exact.keep_first(docs([])).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 17, 1000, 50_000])
def test_filters_hold_their_keys(size):
    rng = np.random.default_rng(size)
    keys = rng.integers(0, 1 << 63, size).astype(np.uint64)
    built = fuse.build(np.r_[keys, keys])
    assert fuse.probe(built, keys).all()
    strangers = rng.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)
    assert fuse.probe(built, strangers).mean() < 0.006
