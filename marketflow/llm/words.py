"""Words of a text as hash codes, and hashes of word windows, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# Deleted from a text, these leave the code points of its words.
BLANKS = b" \t\n\x0b\x0c\r"

# Odd multiplier of the window polynomial.
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

# Entries a task keeps in its word table; a full table is emptied and filled anew, so results do not depend on it.
TABLE_ENTRIES = 1 << 16


class _WordTable(dict):
    """Stable 64-bit codes of words, each computed when it is first met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_TABLE = _WordTable()


def encoded(text: str | None) -> bytes:
    """The UTF-8 bytes of a text; null is empty."""
    return text.encode() if text else b""


def split_words(raw: bytes) -> list[bytes]:
    """Maximal runs of anything but space and the control characters 9 to 13."""
    return raw.split()


def codes(words: list[bytes]) -> np.ndarray:
    """One 64-bit code per word, equal in every task."""
    return np.fromiter(map(_TABLE.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, one to one."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(word_codes: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of ``width`` consecutive words, by its first word; none if there are fewer words."""
    count = len(word_codes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    # Binary powers: a window of 2k words is two windows of k words.
    total, done, power, span = None, 0, word_codes, 1
    rest = width
    while rest:
        if rest & 1:
            part = power[done : done + count]
            total = part.copy() if total is None else total * np.uint64(pow(_BASE, span, 1 << 64)) + part
            done += span
        rest >>= 1
        if rest:
            power = power[: len(power) - span] * np.uint64(pow(_BASE, span, 1 << 64)) + power[span:]
            span *= 2
    return mixed(total)


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window that begins at one of ``starts``."""
    edges = np.zeros(size + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.subtract.at(edges, np.minimum(starts + width, size), 1)
    return np.cumsum(edges[:size]) > 0
