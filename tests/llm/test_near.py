import random
from collections import defaultdict

import numpy as np
import pytest

from support import docs, prose  # noqa: F401
from marketflow.llm import near


def shingle_set(text):
    found = (text or "").split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def brute(pairs):
    members = defaultdict(list)
    for i, t in pairs:
        members[shingle_set(t)].append(i)
    sets = list(members)
    linked = {s: [o for o in sets if o is not s and s and o and 5 * len(s & o) >= 4 * len(s | o)] for s in sets}
    out, seen = {}, set()
    for s in sets:
        if s in seen:
            continue
        reached, todo = {s}, [s]
        while todo:
            for o in linked[todo.pop()]:
                if o not in reached:
                    reached.add(o)
                    todo.append(o)
        seen |= reached
        least = min((i for o in reached for i in members[o] if i is not None), default=None)
        for o in reached:
            for i in members[o]:
                out.setdefault(i, []).append((least, len(linked[o]), len(members[o])))
    return out


def edited(text, changes, seed):
    found, draw = text.split(), random.Random(seed)
    for _ in range(changes):
        found[draw.randrange(len(found))] = f"n{draw.randrange(10**6)}"
    return " ".join(found)


def corpus():
    base = prose(5, 150)
    pairs = [(100 + k, edited(base, k % 6, k)) for k in range(60)]
    pairs += [(k, prose(k, 20 + k)) for k in range(30)]
    pairs += [(300, prose(3, 23)), (301, prose(3, 23) + "  "), (302, "a b"), (303, "a b"), (304, "a"), (305, None), (306, ""), (None, "c d"), (None, prose(4, 24))]
    pairs += [(310, "z " * 3000), (311, "z " * 2000), (312, prose(9, 6000)), (313, edited(prose(9, 6000), 40, 1))]
    return pairs


@pytest.mark.parametrize("block", [1024, 16])
def test_equals_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    pairs = corpus()
    got = defaultdict(list)
    for r in near.linked(docs(pairs)).collect():
        got[r["doc_id"]].append((r["class_id"], r["n_links"], r["n_copies"]))
    want = brute(pairs)
    assert {i: sorted(v, key=repr) for i, v in got.items()} == {i: sorted(v, key=repr) for i, v in want.items()}


def test_one_of_each_class_stays(docs):
    pairs = corpus() + [(300, prose(3, 23))]
    kept = near.keep_one(docs(pairs))
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # Texts without a word are one class; texts of rows without an id are classes of their own.
    classes = {v[0][0] for i, v in brute(pairs).items() if i is not None}
    assert [i for i in ids if i is not None] == sorted(classes, key=repr)
    assert kept.columns == docs([]).columns and ids.count(None) == 1
    assert near.keep_one(docs([])).count() == 0 and near.linked(docs([])).count() == 0


def test_pruning_rarely_drops_what_reaches_the_threshold():
    rng = np.random.default_rng(0)
    agree = rng.random((20_000, near.VALUES)) < 0.8
    steps = agree.reshape(len(agree), -1, near.SLICE).sum(axis=2).cumsum(axis=1)
    assert ((steps < near.least_matches()).any(axis=1)).mean() < 1e-3
    assert ((rng.random((20_000, near.SLICE)) < 0.2).sum(axis=1) < near.least_matches()[0]).mean() > 0.9


def test_signatures_estimate_similarity():
    a = near.shingles(prose(1, 2000))
    b = np.unique(np.r_[a[:1600], near.shingles(prose(2, 380))])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near.signature(a) == near.signature(b)).mean() - true) < 0.12
