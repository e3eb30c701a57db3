"""Hashed words of many texts at once.

Texts are read as UTF-8 bytes, ASCII and Latin-1 capitals folded without
changing lengths. A word is a run of ASCII letters, digits and bytes above
127. Hashes come from one running sum over a whole chunk of texts: with H the
running sum of byte * P^i (mod 2^64), the hash of bytes s to e is
(H[e] - H[s]) * P^-s, the same wherever the bytes stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BITS = 18                    # hashed features: 2^18
CHUNK = 1 << 19              # bytes of text worked on at once; one text is never cut
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 63]] = True   # a sentence ends at a line feed, "!", "." or "?"


@dataclass
class Chunk:
    docs: range              # positions of the texts in the batch
    first: np.ndarray        # where each text starts in ``data``
    raw: np.ndarray          # bytes as they are
    data: np.ndarray         # folded bytes
    starts: np.ndarray       # of words
    ends: np.ndarray


class Hasher:
    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.power) < n:
            for name, p in (("power", _P), ("inverse", _P_INV)):
                steps = np.full(n, p, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def chunks(self, texts: list[str | None]) -> Iterator[Chunk]:
        begin, size, held = 0, 0, []
        for k, t in enumerate(texts):
            held.append((t or "").encode("utf-8", "replace"))
            size += len(held[-1])
            if size >= CHUNK or k + 1 == len(texts):
                yield self._chunk(range(begin, k + 1), held)
                begin, size, held = k + 1, 0, []

    def _chunk(self, docs: range, held: list[bytes]) -> Chunk:
        raw = np.frombuffer(b"\n" + b"\n".join(held) + b"\n", np.uint8)
        data = _FOLD[raw]
        capital = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        data[1:][capital] += 0x20
        word = _WORD[raw]
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        first = np.cumsum([1] + [len(b) + 1 for b in held[:-1]])
        return Chunk(docs, first, raw, data, edges[::2], edges[1::2])

    def running(self, data: np.ndarray) -> np.ndarray:
        """H, one longer than ``data``: H[i] sums the bytes before i."""
        self._reach(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:len(data)], out=out[1:])
        return out

    def spans(self, running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (running[ends] - running[starts]) * self.inverse[starts]


def cells(hashes: np.ndarray, salt: int, bits: int = BITS) -> np.ndarray:
    mixed = (hashes + np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
