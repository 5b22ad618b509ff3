"""Vectorised tokens of many texts at once: runs of word and of other bytes, their hashes and shapes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_SPACE, _OTHER, _WORD = 0, 1, 2
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_b] = _WORD
_KIND[95] = _WORD
_PRIME = 0x100000001B3
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser, so that all bits of a 64-bit hash depend on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    up, down = np.full(n, np.uint64(_BASE)), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, by prefix sums of a polynomial, so that no loop is needed."""
    size = 1 << max(12, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


class Tokens:
    """Runs of word bytes and of other signs of texts, in order; white space only parts them."""

    def __init__(self, texts: list[str], only_words: bool = False):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        bounds = np.cumsum([len(r) + 1 for r in raw])
        kind = _KIND[data]
        if only_words:
            kind = np.where(kind == _WORD, kind, _SPACE)
        edge = np.flatnonzero(np.diff(kind, prepend=_SPACE)).astype(np.int64)
        starts = edge[kind[edge] != _SPACE]
        ends = np.append(edge, len(data))[np.searchsorted(edge, starts, side="right")]
        self.data, self.starts, self.ends = data, starts, ends
        self.is_word = kind[starts] == _WORD
        self.doc = np.searchsorted(bounds, starts, side="right").astype(np.int32)
        self.lower_hash = run_hashes(np.frombuffer(b" ".join(map(self._lower, texts, raw)) + b" ", np.uint8), starts, ends)

    @staticmethod
    def _lower(text: str, raw: bytes) -> bytes:
        low = text.lower().encode()
        return low if len(low) == len(raw) else raw.lower()  # where a lower case has another length: ASCII only

    def shapes(self) -> np.ndarray:
        """A key for each token: words by case, digits and repetition, other runs by their bytes."""
        upper = np.concatenate([[0], np.cumsum((self.data >= 65) & (self.data < 91))])
        digit = np.concatenate([[0], np.cumsum((self.data >= 48) & (self.data < 58))])
        size = self.ends - self.starts
        caps = upper[self.ends] - upper[self.starts]
        first = upper[self.starts + 1] - upper[self.starts]
        case = np.where(caps == 0, 0, np.where((caps * 2 >= size) & (size > 1), 2, np.where(first == 1, 1, 3)))
        key = case + 4 * (digit[self.ends] > digit[self.starts])
        words = np.flatnonzero(self.is_word)
        again = np.zeros(len(size), dtype=np.int64)
        if len(words) > 1:
            same = (self.lower_hash[words[1:]] == self.lower_hash[words[:-1]]) & (self.doc[words[1:]] == self.doc[words[:-1]])
            again[words[1:]] = same
        return np.where(self.is_word, (key + 8 * again + 1).astype(np.uint64), self.lower_hash)


def text_runs(column: pa.Array, chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about so many characters with the place of their first, so that memory is bounded."""
    run, size, first = [], 0, 0
    for n, t in enumerate(column):
        text = t.as_py() or ""
        run.append(text)
        size += len(text)
        if size >= chars:
            yield first, run
            run, size, first = [], 0, n + 1
    if run:
        yield first, run
