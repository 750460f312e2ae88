import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from support import docs  # noqa: F401

from marketflow.llm import spelling


def brute(pairs):
    """The words by sets of texts with one letter taken out."""
    counts = Counter()
    for doc_id, text in pairs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for p in range(len(w)):
            rest = w[:p] + w[p + 1 :]
            holes[p, rest].add(w)
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n), key=repr)


def found(frame, **sizes):
    got = spelling.variants(frame, **sizes)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def drawn(seed, words=2_000, alphabet="abeéÿ"):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice(alphabet) for _ in range(draw.choice((4, 5, 6, 6, 7)))) for _ in range(600)]
    return [(k, " ".join(draw.choice(vocabulary[: draw.randrange(1, 600)]) for _ in range(words))) for k in range(12)]


@pytest.mark.parametrize("shard_words", [spelling.SHARD_WORDS, 10, 1])
def test_words_equal_brute_force(spark, docs, shard_words):  # noqa: F811
    pairs = drawn(3)
    assert found(docs(pairs), shard_words=shard_words) == brute(pairs)


def test_small_blocks_change_nothing(spark, docs, monkeypatch):  # noqa: F811
    pairs = drawn(5, 800)
    want = brute(pairs)
    for name in ("COUNTED_WORDS", "VISITORS", "LEAF_WORDS"):
        monkeypatch.setattr(spelling, name, 3)
    monkeypatch.setattr(spelling, "COMPARED", 50)
    assert found(docs(pairs), shard_words=20) == want


def test_defined_cases(spark, docs):  # noqa: F811
    long = "q" * 30_000
    pairs = [
        (None, "Colour colour COLOUR color color color color color color"), (1, None), (2, ""), (2, "Étude étude étude"),
        (3, f"{long} {long} {long} {long}x {long}x {long}x"), (4, "×÷×÷× " * 5), (4, "×÷×÷× " * 5),
        (5, "abcde abcde abcde abcdf abcdf abcdf abcdg " + "abcdg " * 6 + "abcdh " * 7),
    ]
    assert found(docs(pairs)) == brute(pairs)
    assert found(docs([])) == []
    assert found(docs([(1, "tiny words only")])) == []


def test_long_chains_of_forms(spark, docs):  # noqa: F811
    # Each word is one letter from the next, which is twice as frequent.
    pairs = [(0, " ".join(("a" * (5 + k) + " ") * (3 << k) for k in range(9)))]
    got = found(docs(pairs))
    assert got == brute(pairs)
    assert {r[2] for r in got if r[1]} != {r[1] for r in got if r[1]}


def test_search_spends_one_surplus_and_one_deficit():
    words = [b"abcde", b"abcdf", b"abced", b"zzzzz", b"aacde"]
    trie = spelling.FrequencyTrie(words)
    asked = spelling.letters([b"abcde"], 5)
    _, places = trie.near(asked, 5, spelling.vectors(asked, np.array([5])))
    assert {trie.codes[p].tobytes() for p in places} == {b"abcdf", b"aacde"}
    shorter = spelling.letters([b"abde"], 4)
    _, places = trie.near(shorter, 4, spelling.vectors(shorter, np.array([4])))
    assert {trie.codes[p].tobytes() for p in places} == {b"abcde"}
