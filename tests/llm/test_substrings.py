import hashlib

import pytest

from support import docs, prose  # noqa: F401
from marketflow.llm import substrings

SHARED, LONG = prose(90, 120), prose(91, 400)
PAIRS = [
    (1, prose(1, 30) + " " + SHARED + "\n" + prose(2, 40)), (2, SHARED), (3, prose(3, 60) + "  " + SHARED + " " + SHARED), (4, LONG),
    (5, LONG), (6, LONG.replace(" w1", " changed1")), (7, " ".join(LONG.split()[100:149])), (8, " ".join(LONG.split()[100:150])),
    (9, "a " * 300), (10, "a " * 49), (11, "a " * 50 + "b"), (12, None), (13, ""), (None, LONG), (15, LONG), (15, LONG + " tail"),
    (16, " ".join(LONG.split()[:70] + SHARED.split()[:70])), (-5, prose(2, 40)), (17, prose(7, 3000) + " " + prose(90, 49)),
]


def brute(pairs, width=50):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in pairs]
    for i, found in split:
        for k in range(len(found) - width + 1) if i is not None else ():
            window = tuple(found[k : k + width])
            first[window] = min(i, first.get(window, i))
    out = []
    for i, found in split:
        gone = set()
        for k in range(len(found) - width + 1) if i is not None else ():
            if first[tuple(found[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = [w for k, w in enumerate(found) if k not in gone]
        out.append((i, len(found), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force(docs):
    got = sorted((tuple(r) for r in substrings.removals(docs(PAIRS)).collect()), key=repr)
    assert got == brute(PAIRS)
    assert sum(n for _, _, n, _ in got) > 1000


def test_cut_texts(docs):
    cut = substrings.without_repeats(docs(PAIRS))
    assert cut.columns == docs([]).columns
    left = sorted(((r["doc_id"], hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest()) for r in cut.collect()), key=repr)
    assert left == sorted([(i, h) for i, _, _, h in brute(PAIRS)], key=repr)
    untouched = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert untouched[1] == PAIRS[0][1] and untouched[12] is None
    assert substrings.removals(docs([])).count() == 0 and substrings.without_repeats(docs([])).count() == 0


@pytest.mark.parametrize("width", [1, 2, 5, 43, 64])
def test_sliding_min(width):
    import numpy as np

    values = np.random.default_rng(width).integers(0, 1 << 60, 200).astype(np.uint64)
    want = [values[k : k + width].min() for k in range(200 - width + 1)]
    assert substrings.sliding_min(values, width).tolist() == want
