"""Numpy views of a batch of texts.

A :class:`Texts` holds the UTF-8 bytes of several texts in one buffer, with
line feeds between them so that no word, line or n-gram context crosses
from one text into the next.  Words are maximal runs of bytes outside a
separator class; their hashes are polynomial sums taken from one cumulative
sum over the buffer, so no Python code runs per word.

Null texts count as empty.  Chunks are cut by bytes, never inside a text: a
text longer than the chunk size is a chunk of its own and is read whole.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BYTES = np.arange(256)
#: ``[\x20\x09-\x0D]``, the separators of all word contracts here.
SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
#: Everything but ASCII letters, digits and bytes of non-ASCII characters.
NOT_ALNUM = ~(((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) | (_BYTES >= 128))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

U64 = np.uint64
_PRIME = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python process: what one task
    has prepared, the next one of the same worker finds."""
    return vars(sys).setdefault("_equiscope_llm_cache", {})


_STEP = 1 << 11


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**(i * _STEP)`` and ``base**i`` for i < _STEP, modulo 2**64."""
    small = np.concatenate([[U64(1)], np.cumprod(np.full(_STEP - 1, base, U64))])
    jump = pow(base, _STEP, 1 << 64)
    return np.concatenate([[U64(1)], np.cumprod(np.full(n // _STEP, jump, U64))]), small


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i < n; ``base`` is odd."""
    large, small = _power_tables(base, n)
    return (large[:, None] * small[None, :]).ravel()[:n]


def inverse_powers(base: int, at: np.ndarray, n: int) -> np.ndarray:
    """``base**-i`` for the given i < n; no table of length n is kept."""
    large, small = _power_tables(pow(base, -1, 1 << 64), n)
    return large[at // _STEP] * small[at % _STEP]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _PRIME) -> np.ndarray:
    """Hash of ``values[s:e]`` for every span; equal spans have equal hashes
    wherever they stand.  ``values`` are 64-bit and already mixed."""
    if not len(starts):
        return np.empty(0, U64)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse_powers(base, starts, len(values) + 1))


class Texts:
    """Byte buffer, text bounds and word bounds of a chunk of texts."""

    def __init__(self, texts: list[bytes | None], pad: int = 1, separators: np.ndarray = SPACE, fold=None):
        gap = b"\n" * pad
        self.buf = np.frombuffer(gap + b"".join([x for t in texts for x in (t or b"", gap)]), np.uint8)
        if fold is not None:
            self.buf = fold[self.buf]
        sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
        self.text_ends = pad + np.cumsum(sizes + pad) - pad
        self.text_starts = self.text_ends - sizes
        self.n = len(texts)
        sep = separators[self.buf]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        self.starts, self.ends = edge[0::2], edge[1::2]
        #: First word of each text, and one past the last text's last word.
        self.bounds = np.searchsorted(self.starts, np.append(self.text_starts, len(self.buf)))
        self.counts = np.diff(self.bounds)

    @property
    def word_text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(self.n), self.counts)

    def word_hashes(self, salt: int = 0, longest: int | None = None) -> np.ndarray:
        """Hash of every word, or of its first ``longest`` bytes."""
        table = mix(np.arange(256, dtype=U64) + U64((salt * 0xD1342543DE82EF95 + 257) & _MASK))
        ends = self.ends if longest is None else np.minimum(self.ends, self.starts + longest)
        return spans_hash(table[self.buf], self.starts, ends, (_PRIME + 2 * salt) | 1)

    def windows(self, n: int) -> np.ndarray:
        """Index of every word that starts a run of n words of one text."""
        if len(self.starts) < n:
            return np.empty(0, np.int64)
        left = np.repeat(self.bounds[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= n)

    def window_hashes(self, hashes: np.ndarray, at: np.ndarray, n: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
        return spans_hash(hashes, at, at + n, base)


def per_text_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return np.diff(sums[bounds])


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).to_pylist()
