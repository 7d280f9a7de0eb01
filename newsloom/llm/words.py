"""Words of many texts as numpy arrays: no Python object per word.

A word is a run of bytes outside the separators; the hash of a word, of a run of words or of such a
run without one word comes from running sums of a polynomial modulo 2**64, so each costs a
constant number of array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from newsloom.session import stage  # noqa: F401  re-exported for the operators

WHITE_SPACE = b" \t\n\x0b\x0c\r"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Texts are looked at in pieces of about so many bytes; one text is never cut.
PIECE_BYTES = 1 << 20
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def inverse(base: int) -> int:
    return pow(base, -1, _MASK + 1)


class Words(NamedTuple):
    start: np.ndarray  # first byte of every word
    end: np.ndarray  # behind its last byte
    bounds: np.ndarray  # words bounds[i] ... bounds[i+1]-1 belong to segment i
    hash: np.ndarray  # 64 bits of every word
    prefix: np.ndarray | None = None  # and of its first bytes, where asked for


class Splitter:
    """Splits buffers into words. `separators`: bytes between words; `lower`: A-Z count as a-z; `prefix`: bytes of a prefix."""

    def __init__(self, separators: bytes = WHITE_SPACE, lower: bool = False, prefix: int = 0):
        self.prefix = prefix
        self.is_separator = np.zeros(256, dtype=bool)
        self.is_separator[list(separators)] = True
        byte = np.arange(256)
        if lower:
            byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        self.value = mix(byte.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
        self.up, self.down = powers(_BASE, 1), powers(inverse(_BASE), 1)

    def split(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        """Words of the segments data[offsets[i]:offsets[i+1]]; a word never spans segments."""
        n = len(data)
        if n > len(self.up):
            size = max(n, 2 * PIECE_BYTES)
            self.up, self.down = powers(_BASE, size), powers(inverse(_BASE), size)
        inside = ~self.is_separator[data]
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        opens = inside & first[:n]
        opens[:1] |= inside[:1]
        opens[1:] |= inside[1:] & ~inside[:-1]
        closes = inside & first[1:]
        closes[-1:] |= inside[-1:]
        closes[:-1] |= inside[:-1] & ~inside[1:]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.value[data] * self.up[:n], out=sums[1:])
        hashed = mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
        front = None
        if self.prefix:
            front = mix((sums[np.minimum(start + self.prefix, end)] - sums[start]) * self.down[start])
        return Words(start, end, np.searchsorted(start, offsets), hashed, front)


class Runs:
    """Hashes of runs of words, from running sums over the hashes of all words of a piece."""

    def __init__(self, word_hash: np.ndarray):
        n = len(word_hash)
        up = powers(_WORD_BASE, n)
        self.down = powers(inverse(_WORD_BASE), n + 2)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(word_hash * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words start ... end-1."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def without(self, start: np.ndarray, end: np.ndarray, left_out: np.ndarray) -> np.ndarray:
        """Hash of words start ... end-1 without the word `left_out`."""
        before = (self.sums[left_out] - self.sums[start]) * self.down[start]
        return before + (self.sums[end] - self.sums[left_out + 1]) * self.down[start + 1]


def pieces(texts: pa.Array | pa.ChunkedArray, limit: int = PIECE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, offsets) of runs of whole texts; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, where, what = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def counted(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segments with bounds[i] ... bounds[i+1]: each member's segment, and its place there."""
    sizes = np.diff(bounds)
    segment = np.repeat(np.arange(len(sizes)), sizes)
    return segment, np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], sizes)
