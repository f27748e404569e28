"""Text columns as flat byte arrays, and vectorised words, hashes and row batches over them.

Everything here runs inside tasks on one Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PAD = 64
U = np.uint64
MIX_A, MIX_B, GOLDEN = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53), U(0x9E3779B97F4A7C15)
# Bits of the first n bytes of a little-endian word.
KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], dtype=U)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the input."""
    h = (h ^ (h >> U(33))) * MIX_A
    h = (h ^ (h >> U(33))) * MIX_B
    return h ^ (h >> U(33))


def words_at(buf: np.ndarray) -> np.ndarray:
    """Little-endian 64-bit loads at every byte of a buffer that ends with `PAD` spare bytes."""
    return np.lib.stride_tricks.as_strided(buf[:8].view(U), shape=(len(buf) - 8,), strides=(1,))


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, any length."""
    loads, length = words_at(buf), end - start
    h = mix(length.astype(U) * GOLDEN)
    open_, at = np.arange(len(start)), start
    while len(open_):
        left = end[open_] - at
        h[open_] = mix(h[open_] ^ (loads[at] & KEEP[np.minimum(left, 8)]))
        more = left > 8
        open_, at = open_[more], at[more] + 8
    return h


def hash_grams(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` >= 8 bytes at each position."""
    loads, h = words_at(buf), np.full(len(at), length, U)
    for step in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        h = (h ^ loads[at + step]) * MIX_A
        h ^= h >> U(32)
    return mix(h)


@dataclass
class Texts:
    """Texts end to end: `buf[start[i]:start[i + 1]]` is text i."""

    buf: np.ndarray
    start: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.start)


def flat_texts(column: pa.Array) -> Texts:
    """A string or binary column as one buffer; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    start = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8)[start[0] : start[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(np.concatenate([bytes_, np.zeros(PAD, np.uint8)]), start - start[0])


@dataclass
class Words:
    """Words end to end: word i is `buf[start[i]:end[i]]`; text t has words `of[t]:of[t + 1]`."""

    start: np.ndarray
    end: np.ndarray
    of: np.ndarray


def split_words(texts: Texts, separators: np.ndarray = SPACES) -> Words:
    """Maximal runs of bytes that are no separators; a word never crosses texts."""
    n = int(texts.start[-1])
    inside = ~separators[texts.buf[:n]]
    first = np.zeros(n + 1, bool)
    first[texts.start] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, texts.start))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `size` bytes of text, one row at least."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
