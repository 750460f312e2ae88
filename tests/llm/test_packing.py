import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from support import docs, prose  # noqa: F401
from marketflow.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
STRANGE = ["  x  y\n\n z　q\xa0 r \x1c a\x85b", "it's I'LL  's<|endoftext|>  ", "\r\n\t x\x0b\x0c y ", "日本語 ünï 1234ab", " ", "\n", " x\n", "a b"]


def test_ids_equal_the_tokenizer():
    slow = Tokenizer.from_file(PATH)
    fast = tokens.TextEncoder(PATH, public_tokenizers.PATTERN)
    assert fast.ranked
    for text in [*STRANGE, prose(1, 300)]:
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids
    assert fast.encode(None) == fast.encode("") == b""


def test_long_runs_of_blanks():
    """The pattern would try every end of such a run, and give up; the library that applies the file does not."""
    slow, fast = Tokenizer.from_file(PATH), tokens.TextEncoder(PATH, public_tokenizers.PATTERN)
    for run in (" " * 12_000, "\t" * 10_000 + " ", "\n \u3000" * 5_000):
        for text in (run, f"a{run}b", f"{run}'s{run}{run[:50]}x <|endoftext|>{run}"):
            assert np.frombuffer(fast.encode(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids
    assert len(fast.encode("x" + " " * 5_000_000 + "y")) > 0


def test_every_id_is_packed_once(docs):
    pairs = [(k, prose(k, 13 * k % 700)) for k in range(150)] + [(k, t) for k, t in enumerate(STRANGE, 200)]
    pairs += [(300, None), (301, ""), (None, "x y"), (302, "same"), (302, "same"), (303, prose(3, 6000))]
    packed = packing.pack(docs(pairs), PATH, public_tokenizers.PATTERN, keep_ids=True)
    found = packed.collect()
    slow = Tokenizer.from_file(PATH)
    want = Counter((i, tuple([*(slow.encode(t, add_special_tokens=False).ids if t else []), 1])) for i, t in pairs)
    whole, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        whole[r["doc_id"]].append((r["start"], r["doc_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for (i, ids), times in want.items():
        starts = sorted(p for p in whole[i] if p[1] == len(ids))
        pieces = [p for start in sorted({p[0] for p in starts}) for p in starts if p[0] == start][:: times if len({p[0] for p in starts}) > 1 else 1]
        assert sum(len(p[2]) for p in starts) == times * len(ids)
        if times == 1:
            assert [x for p in pieces for x in p[2]] == list(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    joined = packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * (r["tokens"] if r["tokens"] & (r["tokens"] - 1) == 0 else 2048) for r in joined)
    assert packing.pack(docs([]), PATH, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plans_are_tight_and_whole(seed):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(draw.lognormal(5.5, 1.2, 20_000).astype(int) + 1, 2047)
    histogram = dict(Counter(lengths.tolist()))
    plan = packing.plan(histogram)
    fill = Counter()
    for kind, group in pd_groups(lengths):
        for sequence, length in zip(plan.assign(np.full(len(group), kind), np.arange(len(group))).tolist(), group, strict=True):
            fill[sequence] += length
    assert sum(fill.values()) == lengths.sum() and max(fill.values()) <= 2048 and max(fill) < plan.sequences
    assert 1 - lengths.sum() / 2048 / plan.sequences < 0.02


def pd_groups(lengths):
    kinds = -(-lengths // packing.CLASS_WIDTH)
    for kind in np.unique(kinds):
        yield kind, np.sort(lengths[kinds == kind]).tolist()


def test_column_generation_reaches_the_known_optimum():
    # 44 of size 3, 3 of size 7, 48 of size 9 into 100, as in standard examples: bounded below by volume.
    sizes, demand = np.array([3, 7, 9]), np.array([44.0, 3.0, 48.0])
    patterns, used, bound = packing.column_generation(sizes, demand, 20, 0.0)
    assert used.sum() >= bound - 1e-6 >= (sizes @ demand) / 20 - 1e-6
    assert used.sum() - bound <= 0.5
    assert (patterns @ sizes <= 20).all()


def test_small_plans():
    assert packing.plan({}).sequences == 0
    assert packing.plan({5: 1}).sequences == 1
    assert packing.best_fit([2047, 1, 1, 2046, 2], 2048) == [0, 0, 2, 1, 1]
