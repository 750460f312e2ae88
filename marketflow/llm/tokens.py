"""Byte-level BPE ids of whole texts inside a task."""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: Unicode white space, as the pre-token pattern sees it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# The look-ahead of the pre-token pattern only matters where white space meets white space.
_DOUBLE = re.compile(f"[{SPACE}]{{2}}")
_LOOK_AHEAD = r"\s+(?!\S)|\s+"
# Runs of white space from this length on are cut out before the pattern is applied, which would try every end of the run.
LONG_RUN = 10_000
_LONG = re.compile(f"[{SPACE}]{{{LONG_RUN},}}")


def byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TextEncoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library, as little-endian unsigned 32-bit integers.

    A vocabulary numbered in the order of its merges, which is checked when the file is loaded, is applied as
    ranks, which is several times faster and gives the same ids; any other vocabulary is applied as it is.
    A text that spells an added token, such as ``<|endoftext|>``, has that token's id there, as with the library.
    """

    def __init__(self, path: str, pattern: str):
        self.slow = Tokenizer.from_file(path)
        letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        added = self.slow.get_added_tokens_decoder()
        special = {t.content for t in added.values()}
        # Of tokens that begin at one place the longest counts, as the library finds them.
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        listed = "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True))
        self.find_added = re.compile(f"({listed})") if listed else None
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special and all(c in letters for c in t)}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        singles = max(ranks[bytes([b])] for b in range(256))
        self.ranked = len(ranks) == 256 + len(set(made)) and singles < min(made, default=256) and made == sorted(made)
        self.ranked = self.ranked and not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        self.cuts = pattern.endswith(_LOOK_AHEAD)
        plain = pattern.replace(_LOOK_AHEAD, r"\s") if pattern.endswith(_LOOK_AHEAD) else pattern
        self.whole, self.plain = (
            tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={}) if self.ranked else None for p in (pattern, plain)
        )
        if self.ranked:
            self.slow = None

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.ranked:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.find_added and self.find_added.search(text):
            return b"".join(self.added.get(part) or self._ordinary(part) for part in self.find_added.split(text) if part)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if not self.cuts or len(text) < LONG_RUN:
            return self._matched(text)
        out, at = [], 0
        for run in _LONG.finditer(text):
            # The pattern takes the run as one piece, but for its last character if a word follows.
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += [self._matched(text[at : run.start()]), _piece(self.whole, text[run.start() : end].encode())]
            at = end
        return b"".join([*out, self._matched(text[at:])])

    def _matched(self, text: str) -> bytes:
        core = self.whole if _DOUBLE.search(text) else self.plain
        return core.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def _piece(core: tiktoken.Encoding, piece: bytes) -> bytes:
    """The ids of one pre-token, to which the pattern is not applied."""
    return np.array(core._encode_single_piece(piece), "<u4").tobytes()


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, pattern: str) -> TextEncoder:
    """The encoder of this process; loaded once."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = TextEncoder(path, pattern)
    return _ENCODERS[path, pattern]
