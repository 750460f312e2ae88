"""Language identification by error-correcting output codes.

Every learned language gets a codeword of bits. One binary classifier a bit, over hashed n-grams of one to three
letters, tells the languages whose codewords have a one there from those that have a zero: a sum of log-odds per
n-gram, centred and scaled, to which every segment of a text adds a bounded vote. Decoding compares the margins of a text with every codeword by exponential loss; the loss
of a bit is weighted by how often its classifier is right for texts of that language. The codeword with the
least loss is chosen, and a text whose least two losses are close is flagged as ambiguous.

The fit counts n-grams of a bounded sample of labelled documents per language in Spark; what reaches the driver
is one count per language and hash bin. The rest of the sample centres the classifiers, weighs the bits and sets
the flag.

Defined cases: a null text or one without a letter is ``und`` with score 0; without any learned language so is
every text; with a single one there are no bits, and every other text is of that language with score 1; rows
without id or language are not learned from; repeated rows count each; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm import batches

UNKNOWN = "und"
# Labelled documents of each language that are learned from, about; chosen by the hash of the id.
ROWS_PER_LANGUAGE = 2_000
# One in so many of them calibrates instead of being counted.
CALIBRATE_ONE_OF = 4
BINS = 1 << 16
ORDERS = (1, 2, 3)
# Up to so many languages have every split of them as a bit; more have random ones, so many for each doubling.
ALL_SPLITS = 5
BITS_PER_DOUBLING = 15
# Letters that vote together, how far a vote may go, and letters scored at once (a multiple of the first).
SEGMENT = 256
CLIP = 0.5
# How steeply a language's score falls with its loss.
STEEPNESS = 8.0
PIECE = 1 << 16
# Share of the right calibration texts that may be flagged as ambiguous.
FLAGGED_RIGHT = 0.01

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Letters:
    """Which code points are letters, worked out once in a process."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls.table


def letters(text: str | None) -> np.ndarray:
    """The lower-cased code points of a text, anything between words one blank; none without letters."""
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _Letters.get()[points]
    if not letter.any():
        return np.empty(0, np.uint64)
    points = np.where(letter, points, 0x20).astype(np.uint64)
    # A blank stays where a letter comes before it, and one is put in front.
    return np.concatenate([[np.uint64(0x20)], points[letter | np.concatenate([[False], letter[:-1]])]])


def grams(points: np.ndarray) -> list[np.ndarray]:
    """The hash bins of the n-grams, one array an order, by the place where they begin."""
    out = []
    code = np.zeros(len(points), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        count = max(0, len(points) - order + 1)
        code = code[:count] * np.uint64(0x110000) + points[order - 1 : order - 1 + count]
        if order in ORDERS:
            out.append(((code + np.uint64(order)) * _MULTIPLIER >> np.uint64(48)).astype(np.int64) % BINS)
    return out


def codewords(count: int, seed: int = 11) -> np.ndarray:
    """One row of -1 and 1 per language; every bit splits the languages, no two bits alike or opposite."""
    if count < 2:
        return np.empty((count, 0), np.int8)
    if count <= ALL_SPLITS:
        # The first language has a one in every bit, which leaves each split once.
        bits = [(1, *rest) for rest in itertools.product((1, -1), repeat=count - 1) if -1 in rest]
        return np.array(bits, np.int8).T
    rng = np.random.default_rng(seed)
    wanted = int(np.ceil(BITS_PER_DOUBLING * np.log2(count)))
    best, distance = None, -1
    for _ in range(32):
        bits = rng.permuted(np.where(np.arange(count) % 2, 1, -1)[None, :].repeat(wanted, 0), axis=1).T.astype(np.int8)
        apart = (wanted - (bits.astype(int) @ bits.T.astype(int))) // 2 + wanted * np.eye(count, dtype=int)
        if apart.min() > distance:
            best, distance = bits, apart.min()
    return best


@dataclass
class Codes:
    """Languages, their codewords, and the bit classifiers: log-odds by bin, centre and scale by bit, weights by language."""

    languages: list[str]
    words: np.ndarray
    odds: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    gap: float = 0.0

    def raw(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-odds of the n-grams of each segment, one number a bit, and the letters in it."""
        means, sizes = [], []
        ahead = max(ORDERS) - 1
        for at in range(0, len(points), PIECE):
            some = points[at : at + PIECE + ahead]
            here = min(PIECE, len(points) - at)
            starts = np.arange(0, here, SEGMENT)
            total, count = np.zeros((len(starts), self.odds.shape[1])), np.zeros(len(starts))
            for found in grams(some):
                found = found[:here]
                held = starts[starts < len(found)]
                if len(held):
                    total[: len(held)] += np.add.reduceat(self.odds[found], held, axis=0)
                    count[: len(held)] += np.diff(held, append=len(found))
            means.append(total / np.maximum(count, 1)[:, None])
            sizes.append(np.diff(starts, append=here))
        return np.concatenate(means), np.concatenate(sizes)

    def margins(self, points: np.ndarray) -> np.ndarray:
        """The classifiers' margins: segments vote, each with a bounded margin, so that a foreign passage has only its share."""
        raw, sizes = self.raw(points)
        return np.average(np.clip((raw - self.centre) / self.scale, -CLIP, CLIP), axis=0, weights=sizes)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted exponential loss of every row of margins against every language."""
        return (self.weight[None] * np.exp(-self.words[None] * margins[:, None, :])).sum(axis=2)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The language's place, its score and the gap to the second, relative to it, of every row."""
        if len(self.languages) == 1:
            return np.zeros(len(margins), int), np.ones(len(margins)), np.ones(len(margins))
        losses = self.losses(margins)
        best = losses.argmin(axis=1)
        least = np.sort(losses, axis=1)
        gap = 1 - least[:, 0] / np.maximum(least[:, 1], 1e-12)
        likely = np.exp(STEEPNESS * (least[:, :1] - losses))
        return best, 1 / likely.sum(axis=1), gap


def fit_counts(languages: list[str], counts: np.ndarray) -> Codes:
    """Bit classifiers of n-gram counts, one row of bins per language; every language weighs the same."""
    words = codewords(len(languages))
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BINS)
    odds = np.empty((BINS, words.shape[1]))
    for bit, side in enumerate(words.T):
        odds[:, bit] = np.log(share[side > 0].mean(axis=0)) - np.log(share[side < 0].mean(axis=0))
    bits = words.shape[1]
    return Codes(languages, words, odds.astype(np.float32), np.zeros(bits), np.ones(bits), np.ones(words.shape) / max(1, bits))


def centred(codes: Codes, raw: np.ndarray, place: np.ndarray) -> None:
    """Centre every classifier between the medians of its two sides, and scale it to half their distance."""
    for bit in range(codes.words.shape[1]):
        value, side = raw[:, bit], codes.words[place, bit]
        if (side > 0).any() and (side < 0).any():
            high, low = np.median(value[side > 0]), np.median(value[side < 0])
            codes.centre[bit] = (high + low) / 2
            codes.scale[bit] = max(abs(high - low) / 2, 1e-6)


def weighed(codes: Codes, margins: np.ndarray, place: np.ndarray) -> None:
    """Weigh every bit of a language by how often its classifier is right for it, and set the gap of the flag."""
    right = np.sign(margins) == codes.words[place]
    for k in range(len(codes.languages)):
        some = place == k
        if some.any():
            share = right[some].mean(axis=0) + 1e-3
            codes.weight[k] = share / share.sum()
    best, _, gap = codes.decode(margins)
    if (best == place).any():
        codes.gap = float(np.quantile(gap[best == place], FLAGGED_RIGHT))


def _bounded(docs: DataFrame, learned: Column, id_column: str, text: str, language: str, rows: int) -> tuple[DataFrame, list[str]]:
    """About ``rows`` labelled documents of each language, as (lang, calibrates, text), and the languages."""
    lang = F.col(language).cast("string")
    can = docs.where(learned & F.col(id_column).isNotNull() & lang.isNotNull())
    counted = sorted((r["lang"], r["n"]) for r in can.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect())
    if not counted:
        return can.select(lang.alias("lang"), F.lit(False).alias("calibrates"), F.col(text).cast("string").alias("text")), []
    # Thousandths of a millionth of the hash's range, by language.
    whole = 1_000_000_000
    least = F.create_map(*(F.lit(v) for name, n in counted for v in (name, min(whole, rows * whole // n + 1))))
    drawn = F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(whole))
    calibrates = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("calibrate")), F.lit(CALIBRATE_ONE_OF)) == 0
    picked = can.where(drawn < F.element_at(least, lang))
    return picked.select(lang.alias("lang"), calibrates.alias("calibrates"), F.col(text).cast("string").alias("text")), [k for k, _ in counted]


def _bin_counts(sample: DataFrame) -> DataFrame:
    """(lang, bins): the n-gram counts of a language, in one row per task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part in parts:
            for lang, body in zip(part.column("lang").to_pylist(), part.column("text"), strict=True):
                points = letters(body.as_py())
                for at in range(0, len(points), PIECE):
                    for found in grams(points[at : at + PIECE]):
                        total[lang] = total.get(lang, 0) + np.bincount(found, minlength=BINS)
        for lang, counts in total.items():
            some = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bin", "n"])

    return sample.select("lang", "text").mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def _measured(sample: DataFrame, codes: Codes, places: dict[str, int], centre: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per calibration text with letters its mean log-odds (to centre by) or its margins, and its language's place."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, values = [], []
            for lang, body in zip(part.column("lang").to_pylist(), part.column("text"), strict=True):
                points = letters(body.as_py())
                if len(points):
                    langs.append(lang)
                    raw, sizes = codes.raw(points) if centre else (None, None)
                    values.append((np.average(raw, axis=0, weights=sizes) if centre else codes.margins(points)).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(values, pa.list_(pa.float64()))], names=["lang", "v"])

    held = sample.select("lang", "text").mapInArrow(run, "lang string, v array<double>").collect()
    values = np.array([r["v"] for r in held], float).reshape(len(held), codes.words.shape[1])
    return values, np.array([places[r["lang"]] for r in held], int)


def fit(docs: DataFrame, learned: Column, id_column: str = "doc_id", text: str = "text", language: str = "lang", rows: int = ROWS_PER_LANGUAGE) -> Codes:
    """Codes learned from the rows where ``learned`` holds, about ``rows`` of each language."""
    batches.bound(docs.sparkSession)
    sample, languages = _bounded(docs, learned, id_column, text, language, rows)
    counts = np.zeros((len(languages), BINS))
    place = {name: k for k, name in enumerate(languages)}
    if languages:
        found = _bin_counts(sample.where("not calibrates")).toPandas()
        counts[found["lang"].map(place).to_numpy(int), found["bin"].to_numpy(int)] = found["n"].to_numpy(float)
    codes = fit_counts(languages, counts)
    if len(languages) < 2:
        return codes
    held = sample.where("calibrates")
    centred(codes, *_measured(held, codes, place, True))
    values, places = _measured(held, codes, place, False)
    if len(places):
        weighed(codes, values, places)
    return codes


def predict(docs: DataFrame, codes: Codes, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every row; nothing but the text is looked at."""

    def make(texts: list) -> list[list]:
        found = [letters(t) for t in texts]
        some = [k for k, f in enumerate(found) if len(f)] if codes.languages else []
        named, score, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if some:
            best, scores, gap = codes.decode(np.array([codes.margins(found[k]) for k in some]))
            for k, b, s, g in zip(some, best.tolist(), scores.tolist(), gap.tolist(), strict=True):
                named[k], score[k], unsure[k] = codes.languages[b], s, g < codes.gap
        return [named, score, unsure]

    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return batches.with_columns(plain, "text", [("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean")], make).drop("text")


def held_out(id_column: str = "doc_id") -> Column:
    """Is a row kept apart from learning? By the CRC-32 of its id as text; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), F.lit(3)) == 1
