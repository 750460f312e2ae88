"""The prefix trie of rebuilt conversations, by ternary search trees over range shards.

Every turn is encoded as 128 bits of the SHA-256 of its role and text, so texts never travel. A conversation
becomes one row, its sequence of turn codes. The sequences, with their conversation ids, are range-partitioned
and sorted; a shard is a bounded run of them. A shard numbers its distinct turns in order (its dictionary),
inserts its distinct sequences into a ternary search tree, the median first, so that the siblings of every
node lie in a balanced tree, and walks the nodes once from the last to the first, adding members, leaves and
savings to their parents. Nodes off the paths of the shard's first and last sequence have all their members in the
shard and are final. Those on the two paths are partial: they are merged by the hash of their prefix, and their
subtree sums are made by doubling, the logarithm of the depth in rounds.

Copies of one conversation, however many, are told apart by id in the range partitioning, and so spread over
shards. The ids that end at one merged node are hashed as a sorted stream of blocks.

Defined cases: rows without a conv_id belong to no conversation; a null role or text is empty; a null turn
comes first; turns of one number are ordered by their code, so that repeated rows are turns of their own; the
conversation that lends its turns to c is the largest multiple of five not above c, also below zero; an empty
table gives an empty result; other columns, whatever their names, are ignored. The codes of one
conversation (24 bytes a turn) are held by one task, as the text of one document is elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketflow.llm.batches import bound
from marketflow.session import broadcast_if_small, stage

# Turns, and conversations, after which a shard ends.
SHARD_TURNS = 100_000
SHARD_CONVERSATIONS = 50_000
# Ids in one block of those that end at a merged node.
BLOCK_IDS = 2_000
# Conversations that share their opening, and the turns that may be lent.
FAMILY = 5
LENT = 9

CODE = 16
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _code(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of role and text, in hex; the length of the role keeps the two apart."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * CODE)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, sizes): the codes of the rebuilt conversation's turns end to end, and the bytes of their texts."""
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - F.pmod(conv, F.lit(FAMILY))).alias("base"), conv.alias("conv_id"), F.col("turn").isNotNull().alias("numbered"),
        F.col("turn").cast("long").alias("turn"), _code(F.col("role"), F.col("text")).alias("code"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("size"),
    )
    # One shuffle: grouping by conversation and looking at the family's first both keep to ``base``.
    grouped = turns.repartition("base").groupBy("base", "conv_id")
    own = grouped.agg(F.array_sort(F.collect_list(F.struct("numbered", "turn", "code", "size"))).alias("own"))
    opening = F.slice("own", 1, LENT - 1)
    first = own.where("conv_id = base").select("base", opening.alias("lent"))
    lent = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(LENT)).cast("int")
    rest = F.slice("own", lent + 1, F.greatest(F.size("own") - lent, F.lit(0)))
    turns = F.concat(F.slice(F.coalesce("lent", F.slice("own", 1, 0)), 1, lent), rest)
    built = own.join(first, "base", "left").select("conv_id", turns.alias("turns"))
    return built.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["code"]), "")).alias("seq"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


def medians_first(count: int) -> Iterator[int]:
    """The numbers below ``count``: the median, then the medians of both halves, and so on."""
    waiting = [(0, count)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(low, middle), (middle + 1, high)]


class TernaryTree:
    """A trie whose siblings are binary search trees; node 0 is the root, and parents come before their children."""

    def __init__(self):
        self.token, self.low, self.high, self.down = [-1], [-1], [-1], [-1]
        self.parent, self.depth = [-1], [0]
        self.members, self.least, self.ends = [0], [None], {}

    def _made(self, token: int, parent: int) -> int:
        self.token.append(token)
        self.low.append(-1)
        self.high.append(-1)
        self.down.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.members.append(0)
        self.least.append(None)
        return len(self.token) - 1

    def child(self, node: int, token: int) -> int:
        """The child of ``node`` with this token, made if it is not there."""
        at = self.down[node]
        if at < 0:
            self.down[node] = made = self._made(token, node)
            return made
        while self.token[at] != token:
            side = self.low if token < self.token[at] else self.high
            if side[at] < 0:
                side[at] = made = self._made(token, node)
                return made
            at = side[at]
        return at

    def insert(self, tokens: list[int], ids: list[int]) -> list[int]:
        """Add a sequence with the ids that have it, in ascending order; returns the nodes on its path."""
        path, node = [0], 0
        for token in tokens:
            node = self.child(node, token)
            path.append(node)
        for at in path:
            self.members[at] += len(ids)
            if self.least[at] is None or ids[0] < self.least[at]:
                self.least[at] = ids[0]
        self.ends[node] = ids
        return path


def hashed_ids(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# What a shard gives: kind 0 is a final node, 1 a final node below a partial one, 2 a partial node, 3 a block of ids
# that end at a partial node. ``key`` names the partial node by its prefix: its own for 2 and 3, its parent's for 1.
_PART = (
    "kind int, shard long, key binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, size long, ends_sha256 string, ids string"
)


def shard_parts(shard: int, seqs: list[bytes], ids: list[list[int]], sizes: list) -> list[tuple]:
    """Rows of one shard: distinct sequences in order, the ids of each in order, and the sizes of their turns."""
    codes = np.frombuffer(b"".join(seqs), f"S{CODE}") if any(seqs) else np.empty(0, f"S{CODE}")
    # Fixed-length byte strings drop trailing zeros when read, so the dictionary is made over pairs of integers.
    pairs = np.frombuffer(codes.tobytes(), ">u8").reshape(-1, 2)
    words, first, tokens = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
    tokens = tokens.reshape(-1)
    weight = np.concatenate([np.asarray(s, np.int64) for s in sizes])[first].tolist() if len(pairs) else []
    code = [w.astype(">u8").tobytes() for w in words]
    ends = np.cumsum([len(s) // CODE for s in seqs]).tolist()
    starts = [0, *ends[:-1]]
    tree, paths = TernaryTree(), {}
    for k in medians_first(len(seqs)):
        path = tree.insert(tokens[starts[k] : ends[k]].tolist(), ids[k])
        if k in (0, len(seqs) - 1):
            paths[k] = path
    count = len(tree.token)
    own_size = [0] + [weight[t] for t in tree.token[1:]]
    keys: dict[int, bytes] = {}
    for path in paths.values():
        key = b""
        for node in path:
            key = keys[node] = hashlib.blake2b(key + (code[tree.token[node]] if node else b""), digest_size=CODE).digest()
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    inner = [0] * count
    out = []
    for node in range(count - 1, -1, -1):
        members, parent = tree.members[node], tree.parent[node]
        partial = node in keys
        if not partial:
            leaves[node] += not children[node]
            saved[node] += (members - 1) * own_size[node]
        if parent >= 0:
            children[parent] += 1
            if not partial:
                # Partial nodes hand nothing upward here: their sums are made after merging.
                inner[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
        ended = tree.ends.get(node)
        row = (tree.least[node], tree.depth[node], tree.least[parent] if parent >= 0 else None, members)
        if partial:
            above = keys[parent] if parent >= 0 else None
            out.append((2, shard, keys[node], above, *row, inner[node], leaves[node], saved[node], own_size[node], None, None))
            if ended:
                for at in range(0, len(ended), BLOCK_IDS):
                    block = ended[at : at + BLOCK_IDS]
                    out.append((3, shard, keys[node], None, block[0], *(None,) * 8, ",".join(map(str, block))))
        else:
            done = (children[node], leaves[node], saved[node], own_size[node], hashed_ids(ended) if ended else NO_ENDS, None)
            below = parent in keys
            out.append((int(below), shard, keys[parent] if below else None, None, *row, *done))
    return out


def _sharded(sorted_seqs: DataFrame, shard_turns: int, shard_convs: int) -> DataFrame:
    arrow = to_arrow_schema(T.StructType.fromDDL(_PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        seqs, ids, sizes, turns, convs = [], [], [], 0, 0

        def made() -> Iterator[pa.RecordBatch]:
            rows = shard_parts(shard, seqs, ids, sizes)
            for at in range(0, len(rows), 10_000):
                some = list(zip(*rows[at : at + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(some, arrow, strict=True)], names=arrow.names)

        for batch in batches:
            for conv, seq, size in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "seq", "sizes")), strict=True):
                if convs and (turns >= shard_turns or convs >= shard_convs):
                    yield from made()
                    shard += 1
                    seqs, ids, sizes, turns, convs = [], [], [], 0, 0
                convs += 1
                if seqs and seqs[-1] == seq:
                    ids[-1].append(conv)
                else:
                    seqs.append(seq)
                    ids.append([conv])
                    sizes.append(size)
                    turns += len(size)
        if convs:
            yield from made()

    return sorted_seqs.mapInArrow(run, _PART)


def _stream_hashed(blocks: DataFrame) -> DataFrame:
    """(key, ends_sha256) of blocks (key, conv_id, ids), the ids of a key hashed in order of their first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if state is None or key != last:
                    if state is not None:
                        yield made()
                    last, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state is not None:
            yield made()

    return blocks.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, ends_sha256 string")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) with the sums over each node's subtree, by doubling.

    After round k every node has the sum over descendants fewer than 2^k steps below, and knows its ancestor 2^k
    steps up.
    """
    sums = nodes.select("key", "above", "n_leaves", "saved_tokens")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        added = sums.where("above is not null").groupBy(F.col("above").alias("key"))
        added = added.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        jump = sums.select(F.col("key").alias("above"), F.col("above").alias("higher"))
        sums = (
            sums.join(added, "key", "left").join(jump, "above", "left")
            .select("key", F.col("higher").alias("above"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                    (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"))
        )
        sums = stage(sums, "trie-sums")
        step *= 2
    return sums.select("key", "n_leaves", "saved_tokens")


def nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS, shard_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations, named by its smallest member and its depth."""
    bound(conversations.sparkSession)
    # Staged, as range partitioning reads its input twice.
    seqs = stage(sequences(conversations), "trie-sequences")
    ranged = seqs.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = stage(_sharded(ranged, shard_turns, shard_conversations), "trie-parts")

    partial = parts.where("kind = 2")
    merged = partial.groupBy("key").agg(
        F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("size").alias("size"),
        *(F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    merged = stage(merged, "trie-merged")
    below = merged.where("above is not null").groupBy(F.col("above").alias("key")).agg(F.count(F.lit(1)).alias("partial_children"))
    parents = merged.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    ends = _stream_hashed(parts.where("kind = 3").select("key", "conv_id", "ids"))
    children = F.col("n_children") + F.coalesce("partial_children", F.lit(0))
    merged = (
        merged.join(below, "key", "left").join(parents, "above", "left").join(ends, "key", "left")
        .select("key", "above", "conv_id", "depth", "parent_conv_id", "n_convs", children.alias("n_children"),
                (F.col("n_leaves") + (children == 0).cast("long")).alias("n_leaves"),
                (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    )
    merged = stage(merged, "trie-merged")
    done = merged.drop("n_leaves", "saved_tokens").join(_subtree_sums(merged), "key").select(*NODE)

    # Nodes below a partial one ask for its merged least member by (shard, key), so that the root's many children stay spread.
    dealt = partial.select("shard", "key").join(merged.select("key", F.col("conv_id").alias("merged_parent")), "key")
    edge = parts.where("kind = 1").join(broadcast_if_small(dealt.select("shard", "key", "merged_parent")), ["shard", "key"])
    edge = edge.withColumn("parent_conv_id", F.col("merged_parent"))
    return parts.where("kind = 0").select(*NODE).unionByName(edge.select(*NODE)).unionByName(done)
