"""Binary-fuse filters: static sets of 64-bit keys with 8-bit fingerprints, built and probed with numpy.

A key has three slots in consecutive segments; the exclusive or of the three equals its fingerprint. A
member always answers yes; a stranger does with probability 1/256. About nine bits a key.
"""

from __future__ import annotations

import struct

import numpy as np

from marketflow.llm.words import mixed

_HEAD = struct.Struct("<QQQ")


def _shape(keys: int) -> tuple[int, int]:
    """Slots of a segment and number of segments a first slot may lie in, by the filter's published sizing rule."""
    if keys <= 1:
        return 4, 1
    segment = min(1 << int(np.floor(np.log(keys) / np.log(3.33) + 2.25)), 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * np.log(1_000_000) / np.log(keys))
    return segment, max(1, int(np.ceil(keys * factor / segment)) - 2)


def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(keys ^ np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segments * segment) >> np.uint64(32)).astype(np.int64)
    mask = np.uint64(segment - 1)
    second = (first + segment) ^ ((h >> np.uint64(18)) & mask).astype(np.int64)
    third = (first + 2 * segment) ^ (h & mask).astype(np.int64)
    return np.stack([first, second, third]), ((h ^ (h >> np.uint64(40))) >> np.uint64(8)).astype(np.uint8)


def _peel(slots: np.ndarray, size: int) -> tuple[list, bool]:
    """Rounds of (keys, the slot each alone held); whether all keys were taken."""
    n = slots.shape[1]
    held = np.bincount(slots.ravel(), minlength=size)
    owner = np.zeros(size, np.int64)
    for row in slots:
        np.bitwise_xor.at(owner, row, np.arange(n))
    rounds, left = [], n
    lone = np.flatnonzero(held == 1)
    while len(lone):
        taken, first = np.unique(owner[lone], return_index=True)
        rounds.append((taken, lone[first]))
        left -= len(taken)
        for row in slots[:, taken]:
            np.subtract.at(held, row, 1)
            np.bitwise_xor.at(owner, row, taken)
        near = np.unique(slots[:, taken])
        lone = near[held[near] == 1]
    return rounds, left == 0


def build(keys: np.ndarray) -> bytes:
    """The filter of these keys; equal keys count once."""
    keys = np.unique(keys.astype(np.uint64))
    segment, segments = _shape(len(keys))
    seed = 0
    while True:
        size = (segments + 2) * segment
        slots, prints = _slots(keys, seed, segment, segments)
        rounds, done = _peel(slots, size)
        if done:
            break
        seed += 1
        if seed % 8 == 0:  # small sets can need more room
            segments += 1
    table = np.zeros(size, np.uint8)
    for taken, slot in reversed(rounds):
        # The slot itself is still zero, so all three may be combined.
        a, b, c = slots[:, taken]
        table[slot] = prints[taken] ^ table[a] ^ table[b] ^ table[c]
    return _HEAD.pack(seed, segment, segments) + table.tobytes()


def probe(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys may be members."""
    seed, segment, segments = _HEAD.unpack_from(filter_bytes)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEAD.size)
    (a, b, c), prints = _slots(keys.astype(np.uint64), seed, segment, segments)
    return (table[a] ^ table[b] ^ table[c]) == prints
