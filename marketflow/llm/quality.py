"""Quality rules: an isolation forest over rule statistics, with a cut-off calibrated from labelled rows.

The rules of a document are counts over its words. A forest of random splits is grown on a bounded sample
of labelled documents without looking at the labels; a document that few splits set apart has a short
path and a high anomaly score. The labels then calibrate the score above which a document is rejected.

Defined cases: a null or empty text has no words and fails the base rules; equal statistics get equal
scores; without labelled rows nothing but the base rules rejects; an empty table gives an empty result;
other columns, whatever their
names, are carried along by ``keep_good`` and ignored by the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm import batches, words

# Labelled rows the forest and its cut-off are fitted on, at most; taken by the hash of the id.
LABELLED_ROWS = 20_000
TREES = 100
TREE_ROWS = 256
DEPTH = 8
# Share of good labelled documents that the cut-off may reject.
GOOD_LOSS = 0.001

# Base rules.
LEAST_WORDS = 20
WINDOW = 8
REPEATED_PERCENT = 30

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_MARKS = b"!\"'(),-./:;?@[\\]^_`{}~+="

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbol_ratio", "word_length", "upper_ratio", "mark_ratio", "top_word_share"]


def _count(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def rule_counts(text: str | None) -> tuple:
    """The five counts and the five ratios of one text."""
    raw = words.encoded(text)
    found = words.split_words(raw)
    n = len(found)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(RATIOS)
    chars = len(text) - _count(raw, words.BLANKS)
    symbols = _count(raw, _SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip(words.BLANKS)]
    codes = words.codes(found)
    repeated = 0
    windows = words.window_hashes(codes, WINDOW)
    if len(windows):
        _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[place] > 1)
        if len(starts):
            repeated = int(words.covered(starts, WINDOW, n).sum())
    upper = _count(raw, _UPPER)
    top = int(np.unique(codes, return_counts=True)[1].max())
    ratios = (symbols / chars, chars / n, upper / max(1, upper + _count(raw, _LOWER)), _count(raw, _MARKS) / chars, top / n)
    return (n, chars, symbols, len(lines) - len(set(lines)), repeated, *ratios)


def _matrix(rows: list[tuple]) -> np.ndarray:
    return np.array([r[len(COUNTS) :] for r in rows], np.float64).reshape(len(rows), len(RATIOS))


def _base_failed(row: tuple) -> bool:
    return row[0] < LEAST_WORDS or 100 * row[4] > REPEATED_PERCENT * row[0]


def expected_path(size: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of ``size`` points."""
    n = np.maximum(np.asarray(size, np.float64), 2)
    path = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(np.asarray(size) <= 1, 0.0, np.where(np.asarray(size) == 2, 1.0, path))


@dataclass
class Forest:
    """Trees as arrays over heap positions: the column a node splits (-1: a leaf), its cut, and its rows."""

    column: np.ndarray
    cut: np.ndarray
    rows: np.ndarray
    tree_rows: int
    limit: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row of ``x``, between 0 and 1."""
        if not len(self.column) or not len(x):
            return np.zeros(len(x))
        each = np.arange(len(x))
        total = np.zeros(len(x))
        for column, cut, rows in zip(self.column, self.cut, self.rows, strict=True):
            node, depth = np.ones(len(x), np.int64), np.zeros(len(x))
            for _ in range(DEPTH):
                split = column[node]
                inner = split >= 0
                right = x[each, np.maximum(split, 0)] >= cut[node]
                node = np.where(inner, 2 * node + right, node)
                depth += inner
            total += depth + expected_path(rows[node])
        return 2.0 ** (-total / len(self.column) / max(float(expected_path(self.tree_rows)), 1.0))


def _grow(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    places = 1 << (DEPTH + 1)
    column, cut, rows = np.full(places, -1), np.zeros(places), np.zeros(places, np.int64)
    waiting = [(1, np.arange(len(x)))]
    while waiting:
        node, members = waiting.pop()
        rows[node] = len(members)
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        spread = np.flatnonzero(high > low)
        if 2 * node >= places or len(members) < 2 or not len(spread):
            continue
        chosen = rng.choice(spread)
        at = rng.uniform(low[chosen], high[chosen])
        left = x[members, chosen] < at
        if not left.any():
            continue
        column[node], cut[node] = chosen, at
        waiting += [(2 * node, members[left]), (2 * node + 1, members[~left])]
    return column, cut, rows


def fit_arrays(x: np.ndarray, good: np.ndarray, passed: np.ndarray, seed: int = 7) -> Forest:
    """A forest over the rows of ``x``; the cut-off is a high quantile of the scores of good rows that passed the base rules."""
    empty = np.empty((0, 1 << (DEPTH + 1)))
    if not len(x) or not (good & passed).any():
        return Forest(empty, empty, empty, TREE_ROWS, float("inf"))
    rng = np.random.default_rng(seed)
    size = min(TREE_ROWS, len(x))
    trees = [_grow(x[rng.choice(len(x), size, replace=False)], rng) for _ in range(TREES)]
    forest = Forest(*(np.array(part) for part in zip(*trees, strict=True)), size, 0.0)
    forest.limit = float(np.quantile(forest.scores(x[good & passed]), 1 - GOOD_LOSS))
    return forest


def fit(docs: DataFrame, labels: DataFrame, sample: int = LABELLED_ROWS, id_column: str = "doc_id", text: str = "text") -> Forest:
    """Fit on at most ``sample`` labelled documents. ``labels`` has the id and ``quality`` (1 good, 0 bad)."""
    chosen = (
        labels.where(F.col(id_column).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    # The labelled ids are bounded by the sample, so they are broadcast; the rows that come back are bounded too.
    texts = docs.join(F.broadcast(chosen.select(F.col("id").alias(id_column))), id_column, "left_semi")
    found = measure(texts, id_column, text).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    measured = found.orderBy(F.xxhash64("id", *COUNTS, *RATIOS), "id").limit(sample).toPandas()
    if not len(measured):
        return fit_arrays(np.empty((0, len(RATIOS))), np.empty(0, bool), np.empty(0, bool))
    x = measured[RATIOS].to_numpy(np.float64)
    passed = ~measured["base_failed"].to_numpy(bool)
    return fit_arrays(x[measured["n_words"] > 0], *(v[measured["n_words"] > 0] for v in (measured["quality"].to_numpy() == 1, passed)))


_STATISTICS = [(n, "long") for n in COUNTS] + [(n, "double") for n in RATIOS] + [("base_failed", "boolean")]


def _plain(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))


def measure(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the rule statistics of each row."""

    def make(texts: list) -> list[list]:
        found = [rule_counts(t) for t in texts]
        return [list(v) for v in zip(*found, strict=True)] + [[_base_failed(r) for r in found]]

    return batches.with_columns(_plain(docs, id_column, text), "text", _STATISTICS, make).drop("text")


def judge(docs: DataFrame, forest: Forest, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the rule statistics, the anomaly score and the verdict ``kept`` of each row."""

    def make(texts: list) -> list[list]:
        found = [rule_counts(t) for t in texts]
        failed = [_base_failed(r) for r in found]
        scores = forest.scores(_matrix(found)).tolist()
        kept = [not f and s <= forest.limit for f, s in zip(failed, scores, strict=True)]
        return [list(v) for v in zip(*found, strict=True)] + [failed, scores, kept]

    added = [*_STATISTICS, ("anomaly", "double"), ("kept", "boolean")]
    return batches.with_columns(_plain(docs, id_column, text), "text", added, make).drop("text")


def keep_good(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    verdict = batches.fresh(docs, "verdict")

    def make(texts: list) -> list[list]:
        found = [rule_counts(t) for t in texts]
        scores = forest.scores(_matrix(found))
        return [[not _base_failed(r) and s <= forest.limit for r, s in zip(found, scores, strict=True)]]

    return batches.with_columns(docs, text, [(verdict, "boolean")], make).where(F.col(verdict)).drop(verdict)
