"""Spelling variants: words that differ by one code point, found by a trie over letter-frequency vectors.

A word is arranged by how often it has each group of letters. One inserted, deleted or replaced code point
changes that vector by a surplus of at most one in one group and a deficit of at most one in another. The trie
holds the words by their successive counts; a depth-first search carries the words that ask along, each with the
surplus and deficit it may still spend, and drops those that have spent it. What reaches a leaf together is
verified code point by code point.

The upper levels of the trie deal the words to shards: a path is split while a bounded sample of the words says
that it holds more than a shard should. A word lies in one shard, and visits the later ones (by length, then by path) that it
may reach, so every pair of words meets once; both sides take note of it. Pairs are never emitted: a shard
gives each word its number of near words there and the best of them.

Counting combines in the tasks before the shuffle, so frequent words do not pile up. Forms lead to words at
least twice as frequent, so chains are short; roots are found by pointer jumping.

Defined cases: a null or empty text has no words; a null id is the empty text in the hash; of forms that tie, the
smallest in code-point order; repeated rows count again; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.batches import bound
from marketflow.session import stage

LEAST_LETTERS = 5
LEAST_COUNT = 3
DROP_ONE_OF = 97
# A form is at least so many times as frequent as its variant.
FORM_FACTOR = 2

# Words a task counts before it hands them on.
COUNTED_WORDS = 200_000
# Words a shard should hold, or this share of all words if that is more, and the words sampled to see where they are.
SHARD_WORDS = 8_000
SHARD_SHARE = 4_096
SAMPLE_WORDS = 100_000
# Words below a node of a shard's trie that are not told apart further.
LEAF_WORDS = 24
# Visitors searched for at once, and letters compared at once.
VISITORS = 20_000
COMPARED = 4_000_000

# Words are Latin-1, so a code point is a byte. Every letter from a to z is a group, most telling first; the others share six.
_ORDER = "etaoinshrdlucmfwypvbgkjqxz"
LEVELS = len(_ORDER) + 6
_GROUP = np.zeros(256, np.int64)
_GROUP[[ord(c) for c in _ORDER]] = np.arange(len(_ORDER))
_GROUP[0xC0:] = len(_ORDER) + np.arange(0x40) % 6

_RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def words_of(doc_id: object, text: str | None) -> Counter:
    """The words of one document and how often it has them."""
    if not text:
        return Counter()
    # Lower-casing bytes changes A to Z alone.
    found = Counter(_RUNS.findall(text.encode().lower()))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, times in found.items():
        code = zlib.crc32(run, start)
        if code % DROP_ONE_OF == 0:
            letters = run.decode()
            at = code % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        out[run] += times
    return out


def word_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    bound(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def made() -> Iterator[pa.RecordBatch]:
            held = [(w.decode(), n) for w, n in total.items() if len(w) >= LEAST_LETTERS]
            for at in range(0, len(held), 20_000):
                found, counts = zip(*held[at : at + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in words_of(doc_id, body.as_py()).items():
                    total[word] += n
                if len(total) >= COUNTED_WORDS:
                    yield from made()
                    total.clear()
        yield from made()

    plain = docs.select(F.col(id_column).cast("string"), F.col(text).cast("string"))
    counted = plain.mapInArrow(run, "word string, n long").where(F.char_length("word") >= LEAST_LETTERS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[bytes], width: int) -> np.ndarray:
    """Latin-1 words as rows of code points, zeros behind the end."""
    return np.array(words, f"S{max(width, 1)}").view(np.uint8).reshape(len(words), max(width, 1))


def vectors(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How often each word has each group of letters."""
    rows, places = np.nonzero(np.arange(codes.shape[1])[None, :] < lengths[:, None])
    flat = np.bincount(rows * LEVELS + _GROUP[codes[rows, places]], minlength=len(codes) * LEVELS)
    return flat.reshape(len(codes), LEVELS).astype(np.int32)


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is each row of ``b`` the row of ``a`` with one more code point?"""
    width = a.shape[1]
    differs, behind = a != b[:, :width], a != b[:, 1:]
    head = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    tail = np.where(behind.any(axis=1), behind[:, ::-1].argmax(axis=1), width)
    return head + tail >= width


class FrequencyTrie:
    """Words of one length, in the order of their vectors; the nodes of the trie are ranges of that order."""

    def __init__(self, words: list[bytes]):
        self.length = len(words[0])
        codes = letters(words, self.length)
        counts = vectors(codes, np.full(len(words), self.length))
        self.order = np.lexsort(counts.T[::-1])
        self.codes, self.counts = codes[self.order], counts[self.order]

    def near(self, codes: np.ndarray, length: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (asking row, word place) that differ by one code point; the asking words have this length, or one letter less."""
        same = length == self.length
        asked, found = [], []
        start = (0, len(self.codes), 0, np.arange(len(codes)), np.ones(len(codes), np.int8), np.full(len(codes), int(same), np.int8))
        waiting = [start]
        while waiting:
            low, high, level, rows, surplus, deficit = waiting.pop()
            if not len(rows):
                continue
            if level == LEVELS or high - low <= LEAF_WORDS:
                self._verify(low, high, level, rows, surplus, deficit, codes, counts, same, asked, found)
                continue
            column = self.counts[low:high, level]
            edges = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
            mine = counts[rows, level]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                more = int(column[a]) - mine
                left, lacking = surplus - np.maximum(more, 0), deficit - np.maximum(-more, 0)
                on = (left >= 0) & (lacking >= 0)
                waiting.append((low + a, low + b, level + 1, rows[on], left[on].astype(np.int8), lacking[on].astype(np.int8)))
        if not asked:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(asked), np.concatenate(found)

    def _verify(self, low, high, level, rows, surplus, deficit, codes, counts, same, asked, found) -> None:
        size = max(1, COMPARED // max(1, (high - low) * max(LEVELS, self.length)))
        for at in range(0, len(rows), size):
            some = rows[at : at + size]
            if level < LEVELS:
                more = self.counts[None, low:high, level:] - counts[some, None, level:]
                up = np.maximum(more, 0).sum(axis=2)
                alive = (up <= surplus[at : at + size, None]) & (up - more.sum(axis=2) <= deficit[at : at + size, None])
            else:
                alive = np.ones((len(some), high - low), bool)
            row, place = np.nonzero(alive)
            row, place = some[row], place + low
            step = max(1, COMPARED // self.length)
            for k in range(0, len(row), step):
                r, p = row[k : k + step], place[k : k + step]
                good = (_one_replaced if same else _one_inserted)(codes[r], self.codes[p])
                asked.append(r[good])
                found.append(p[good])


def _latin(word: str) -> bytes:
    return word.encode("latin-1")


class _Notes:
    """The number of near words of each word, and the best: the most frequent, then the smallest."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n
        self.near = np.zeros(len(words), np.int64)
        self.best: list = [None] * len(words)

    def add(self, mine: np.ndarray, others: list[bytes], their_n: np.ndarray, theirs: np.ndarray) -> None:
        """Word ``mine[k]`` is near ``others[theirs[k]]``."""
        if not len(mine):
            return
        self.near += np.bincount(mine, minlength=len(self.words))
        # Ranks over the others that were met: the smallest rank of each word is its best.
        met = np.unique(theirs)
        ranked = sorted(met.tolist(), key=lambda k: (-int(their_n[k]), others[k]))
        rank = np.empty(len(others), np.int64)
        rank[ranked] = np.arange(len(ranked))
        order = np.lexsort((rank[theirs], mine))
        first = np.unique(mine[order], return_index=True)
        for word, k in zip(first[0].tolist(), order[first[1]].tolist(), strict=True):
            other = int(theirs[k])
            offer = (-int(their_n[other]), others[other])
            if self.best[word] is None or offer < self.best[word]:
                self.best[word] = offer

    def batch(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.near).tolist()
        columns = [
            pa.array([self.words[k].decode("latin-1") for k in some], pa.string()), pa.array(self.near[some], pa.int64()),
            pa.array([-self.best[k][0] for k in some], pa.int64()), pa.array([self.best[k][1].decode("latin-1") for k in some], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "form_n", "form"])


def split_paths(sample: np.ndarray, lengths: np.ndarray, limit: float) -> set[tuple]:
    """The paths (length, counts of the first groups) that more than ``limit`` of the sampled words share."""
    out: set[tuple] = set()
    waiting = [((int(n),), np.flatnonzero(lengths == n)) for n in np.unique(lengths)]
    while waiting:
        path, rows = waiting.pop()
        if len(rows) <= limit or len(path) > LEVELS:
            continue
        out.add(path)
        column = sample[rows, len(path) - 1]
        waiting += [((*path, int(c)), rows[column == c]) for c in np.unique(column)]
    return out


def shards_of(counts: list[int], length: int, split: set[tuple]) -> tuple[tuple, list[tuple]]:
    """The shard a word lies in, and the later ones it visits."""
    own: tuple = (length,)
    while own in split:
        own = (*own, counts[len(own) - 1])
    visited = []
    waiting = [((length,), 1, 1), ((length + 1,), 1, 0)]
    while waiting:
        path, surplus, deficit = waiting.pop()
        if path not in split:
            if path > own:
                visited.append(path)
            continue
        count = counts[len(path) - 1]
        waiting.append(((*path, count), surplus, deficit))
        if surplus:
            waiting.append(((*path, count + 1), surplus - 1, deficit))
        if deficit and count:
            waiting.append(((*path, count - 1), surplus, deficit - 1))
    return own, visited


def _dealt(words: DataFrame, split: set[tuple]) -> DataFrame:
    """(shard, visits, word, n): every word once in its shard, and once in each shard that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            plain = [_latin(w) for w in found]
            sizes = np.array([len(w) for w in plain], np.int64)
            # Words of very different lengths are not laid out at one width.
            counts = [np.bincount(_GROUP[np.frombuffer(w, np.uint8)], minlength=LEVELS).tolist() for w in plain]
            shard, visits, at = [], [], []
            for k, (count, size) in enumerate(zip(counts, sizes.tolist(), strict=True)):
                own, others = shards_of(count, size, split)
                shard += [",".join(map(str, p)) for p in (own, *others)]
                visits += [False] + [True] * len(others)
                at += [k] * (1 + len(others))
            for k in range(0, len(at), 10_000):
                rows = pa.array(at[k : k + 10_000], pa.int64())
                columns = [
                    pa.array(shard[k : k + 10_000], pa.string()), pa.array(visits[k : k + 10_000], pa.bool_()),
                    batch.column("word").take(rows), batch.column("n").take(rows),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "visits", "word", "n"])

    return words.mapInArrow(run, "shard string, visits boolean, word string, n long")


def _searched(dealt: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, words, counts, trie, notes = None, [], [], None, None
        visitors: list[bytes] = []
        their_n: list[int] = []

        def built() -> None:
            nonlocal trie, notes, words
            trie = FrequencyTrie(words)
            words = [words[k] for k in trie.order.tolist()]
            notes = _Notes(words, np.array(counts, np.int64)[trie.order])
            for at in range(0, len(words), VISITORS):
                # Every word asks, so a pair is met from both sides; it is noted once.
                some = slice(at, at + VISITORS)
                asked, found = trie.near(trie.codes[some], trie.length, trie.counts[some])
                asked = asked + at
                once = asked < found
                a, b = asked[once], found[once]
                notes.add(a, words, notes.n, b)
                notes.add(b, words, notes.n, a)

        def visited() -> Iterator[pa.RecordBatch]:
            guests, n = visitors.copy(), np.array(their_n, np.int64)
            visitors.clear()
            their_n.clear()
            sizes = np.array([len(w) for w in guests], np.int64)
            for size in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == size)
                plain = [guests[k] for k in some.tolist()]
                codes = letters(plain, size)
                asked, found = trie.near(codes, size, vectors(codes, sizes[some]))
                mine = _Notes(plain, n[some])
                mine.add(asked, words, notes.n, found)
                notes.add(found, plain, n[some], asked)
                yield mine.batch()

        def ended() -> Iterator[pa.RecordBatch]:
            if words and trie is None:
                built()
            if visitors:
                yield from visited()
            if notes is not None:
                yield notes.batch()

        for batch in batches:
            for name, visits, word, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "visits", "word", "n")), strict=True):
                if name != shard:
                    yield from ended()
                    shard, words, counts, trie, notes = name, [], [], None, None
                if not visits:
                    words.append(_latin(word))
                    counts.append(n)
                elif words:
                    # A shard without words of its own has nothing to find.
                    if trie is None:
                        built()
                    visitors.append(_latin(word))
                    their_n.append(n)
                    if len(visitors) >= VISITORS:
                        yield from visited()
        yield from ended()

    # Words come before visitors within a shard.
    sent = dealt.repartition("shard").sortWithinPartitions("shard", "visits")
    return sent.mapInArrow(run, "word string, n_near long, form_n long, form string")


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, sample: int = SAMPLE_WORDS) -> DataFrame:
    """(word, n_near, form_n, form): the number of near words, and the best of them; words without any are left out."""
    bound(words.sparkSession)
    total = words.count()
    # The hash picks about ``sample`` words, so what comes to the driver is bounded; it only says where shards end.
    share = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < min(1 << 30, (sample << 30) // max(total, 1))
    plain = [_latin(r["word"]) for r in words.where(share & (F.char_length("word") < 256)).select("word").collect()]
    sizes = np.array([len(w) for w in plain], np.int64)
    counts = vectors(letters(plain, int(sizes.max(initial=1))), sizes)
    limit = max(shard_words, total / SHARD_SHARE) * len(plain) / max(total, 1)
    split = split_paths(counts, sizes, limit)
    found = _searched(_dealt(words, split))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), forms followed to the last by pointer jumping."""
    at = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moves"))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moves"))
        at = stage(at, "spelling-roots")
        if not at.where("moves").limit(1).count():
            return at.select("word", "root")


def variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    counted = stage(word_counts(docs, id_column, text), "spelling-words")
    near = near_words(counted, shard_words)
    held = F.col("form_n") >= FORM_FACTOR * F.col("n")
    judged = counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(held, F.col("form")).alias("form"), F.when(held, F.col("form_n")).alias("form_n")
    )
    judged = stage(judged, "spelling-forms")
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
