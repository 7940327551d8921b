"""Whole-batch word and k-gram hashing over UTF-8 bytes.

A word is a maximal run of ``0-9 a-z`` (``A-Z`` lower-cased) and any code
point above U+007F. Every UTF-8 byte of such a code point is >= 0x80, so bytes
can be classified by a table and a whole Arrow batch is hashed by a handful of
numpy passes, without a Python object per word.

Word hash: sum of T[byte] * B**i over the word's bytes, mod 2**64, mixed with
the length; T and B are fixed and odd multipliers are invertible, so a prefix
sum gives every word's hash at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 32
_CODE = (np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: Words are hashed in blocks of about so many bytes, cut between words, so that no array grows with a text.
BLOCK = 1 << 18
#: Powers kept from call to call; longer runs (a single word of more bytes) are computed each time.
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = max(n, 1 << 12)
        held = np.full(size, np.uint64(base))
        held[0] = 1
        held = np.multiply.accumulate(held)
        if size <= 2 * BLOCK:
            _powers[base] = held
    return held[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins; null is empty."""
    a = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(column: pa.Array, limit: int = 1 << 20):
    """Row ranges (begin, end) of about ``limit`` bytes of text; one row at least."""
    a = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    i, n = 0, len(a)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text where its words begin."""
    n = len(data)
    hashes, starts, i = [], [], 0
    while i < n:
        j = min(n, i + BLOCK)
        while j < n:  # the next place where no word goes on: a byte that isn't a word's, or the head of a text
            step = np.flatnonzero(~_WORD[data[j : j + BLOCK]])
            stop = j + int(step[0]) if len(step) else min(n, j + BLOCK)
            head = int(np.searchsorted(off, j))
            found = len(step) > 0
            if head < len(off) and off[head] <= stop:
                stop, found = int(off[head]), True
            j = stop
            if found:
                break
        h, start = _block_hashes(data[i:j], off[np.searchsorted(off, i) : np.searchsorted(off, j)] - i)
        hashes.append(h)
        starts.append(start + i)
        i = j
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), off)


def _block_hashes(data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words of one block; ``heads``: where texts begin in it."""
    mask = _WORD[data]
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    begin[heads] |= mask[heads]
    start = np.flatnonzero(begin)
    last = mask.copy()
    last[:-1] &= ~mask[1:] | begin[1:]
    end = np.flatnonzero(last)
    total = np.cumsum(_CODE[data] * _power(_BASE, len(data)))
    h = total[end]
    h[start > 0] -= total[start[start > 0] - 1]
    h = h * _power(_INVERSE, len(data))[start]
    return mix(h + (end - start).astype(np.uint64)), start


def kgrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; those that cross texts are for the caller to leave out."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[j : j + len(out)]
    return mix(out + np.uint64(k))


class Chunks:
    """Encoded chunks of text, of at most ``limit`` bytes from call to call."""

    #: About what an entry takes beside its characters and ids.
    ENTRY = 200

    def __init__(self, limit: int):
        self.held: dict[str, bytes] = {}
        self.limit, self.size = limit, 0

    def _bytes(self, some: dict[str, bytes]) -> int:
        return sum(map(len, some)) + sum(map(len, some.values())) + self.ENTRY * len(some)

    def encode(self, cut: list[list[str]], encode) -> list[bytes]:
        """The joined bytes of each list of chunks: those held, or by ``encode`` for chunks not met yet.

        Where the new ones don't fit, only those of this call stay, and none if they are too many by
        themselves. Chunks are looked up without a Python step for each.
        """
        met = set().union(*cut)
        fresh = encode(list(met.difference(self.held)))
        self.size += self._bytes(fresh)
        if self.size > self.limit:
            self.held = {c: self.held[c] for c in met.difference(fresh)}
            self.size = self._bytes(self.held) + self._bytes(fresh)
        self.held.update(fresh)
        get = self.held.__getitem__
        out = [b"".join(map(get, x)) for x in cut]
        if self.size > self.limit:
            self.held, self.size = {}, 0
        return out
