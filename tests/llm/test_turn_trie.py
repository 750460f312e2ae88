import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from marketflow.llm import turn_trie

SCHEMA = "conv_id long, turn long, role string, text string, code string, base string, seq string"


def brute(talk):
    """The nodes by dictionaries of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in talk:
        if conv is not None:
            role, text = role or "", text or ""
            code = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, code, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    members, children, built = defaultdict(list), defaultdict(set), {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = s = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in children[s]) if children[s] else 1
        saved[s] = (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0) + sum(saved[k] for k in children[s])
        ends = ",".join(str(c) for c in sorted(members[s]) if len(built[c]) == len(s))
        above = min(members[s[:-1]]) if s else None
        out.append((min(members[s]), len(s), above, len(members[s]), len(children[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, talk, **sizes):
    frame = spark.createDataFrame([(*t, "x", "x", "x") for t in talk], SCHEMA)
    got = turn_trie.nodes(frame, **sizes)
    assert got.columns == turn_trie.NODE
    return sorted((tuple(r) for r in got.collect()), key=repr)


def drawn(seed, convs=80, deepest=14):
    draw = random.Random(seed)
    return [(c, t, draw.choice("ua"), draw.choice(["", "é", "ab", "long text"])) for c in range(convs) for t in range(draw.randrange(1, deepest))]


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 9, "shard_conversations": 3}, {"shard_turns": 1}])
def test_nodes_equal_brute_force(spark, sizes):
    talk = drawn(1)
    assert found(spark, talk, **sizes) == brute(talk)


def test_copies_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "BLOCK_IDS", 2)
    talk = [(c, t, "u", f"turn {t}") for c in range(-40, 60) for t in range(30)]
    assert found(spark, talk, shard_turns=50, shard_conversations=7) == brute(talk)


def test_defined_cases(spark):
    odd = [
        (None, 0, "u", "nobody's"), (5, None, "u", "first"), (5, 0, None, None), (5, 0, None, None), (6, 3, "u", "x"), (6, 3, "u", "y"),
        (12, 0, "u", "no base"), (-3, 1, "u", "below zero"), (-5, 1, "u", "base"), (15, 0, "u1", "a"), (20, 0, "u", "1a"), (25, 0, "u", "w" * 100_000),
    ]
    assert found(spark, odd) == brute(odd)
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "u", "x")]) == []


def test_medians_come_first_and_keep_siblings_balanced():
    assert sorted(turn_trie.medians_first(100)) == list(range(100)) and next(turn_trie.medians_first(100)) == 50
    tree = turn_trie.TernaryTree()
    for k in turn_trie.medians_first(1023):
        tree.insert([k], [k])

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.down[0]) == 10
