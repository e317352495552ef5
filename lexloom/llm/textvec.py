"""Vectorised word, line and shingle arithmetic over Arrow text columns.

A :class:`Texts` holds the UTF-8 bytes of a run of documents in one numpy
array.  Words are the maximal runs of bytes other than ``0x20`` and
``0x09-0x0D`` (the pattern ``[^\\x20\\x09-\\x0D]+``), and never cross a
document's end.  Strings are identified by 64-bit hashes: a polynomial over
random byte values, read off at word or line borders and then mixed.  Work is
done in pieces of a fixed number of bytes, so memory follows the size of one
chunk of documents and not the size of a partition.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 19
_PIECE = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
WORD_COEF = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, _PIECE)
_INV = _powers(pow(_BASE, -1, 1 << 64), _PIECE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer row stands alone."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task's function that gives freed memory back to the system at its end.

    Workers live on from task to task, and their allocators keep what numpy and
    Arrow have freed; several idle workers would hold an executor's memory.
    """

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass

    return tidied


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a run of texts (null: empty) behind each other, and the cuts between texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of ``data``; both bounds ascend.

    A range is hashed by the pieces of fixed length that it crosses, each
    relative to the range's start, so that equal strings hash alike
    wherever they stand.
    """
    acc = np.zeros(len(starts), np.uint64)
    n = len(data)
    for at in range(0, n, _PIECE):
        end = min(n, at + _PIECE)
        a, b = np.searchsorted(ends, at, side="right"), np.searchsorted(starts, end)
        if a >= b:
            continue
        s, e = starts[a:b], ends[a:b]
        run = np.zeros(end - at + 1, np.uint64)
        np.cumsum(_BYTE[data[at:end]] * _POW[: end - at], out=run[1:])
        lo, hi = np.maximum(s, at) - at, np.minimum(e, end) - at
        part = run[hi] - run[lo]
        before = np.searchsorted(s, at)
        part[before:] *= _INV[lo[before:]]
        for j in range(before):
            part[j : j + 1] *= U64(pow(_BASE, at - int(s[j]), 1 << 64))
        acc[a:b] += part
    return mix(acc ^ mix((ends - starts).astype(np.uint64)))


class Texts:
    """The bytes of some documents, with their words, lines and hashes."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.raw, self.offsets = raw(column)
        self.n = len(column)
        self.data = _LOWER[self.raw] if lower else self.raw
        space = _SPACE[self.data]
        self.solid = ~space
        first, last = self.solid.copy(), self.solid.copy()
        first[1:] &= space[:-1]
        last[:-1] &= space[1:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < self.offsets[-1])]
        first[cuts] = self.solid[cuts]
        last[cuts - 1] = self.solid[cuts - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = self.owner(self.starts)
        self.word_cuts = np.searchsorted(self.starts, self.offsets)
        self.n_words = np.diff(self.word_cuts)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The document that each byte position lies in."""
        return np.searchsorted(self.offsets, at, side="right") - 1

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per document, the number of bytes whose flag is set."""
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[self.offsets])

    def table_sums(self, table: np.ndarray) -> np.ndarray:
        """Per document, the number of bytes that a 256-entry table marks."""
        return self.sums(table[self.raw])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; both bounds ascend."""
        return hashes(self.data, starts, ends)

    @property
    def words(self) -> np.ndarray:
        if not hasattr(self, "_words"):
            self._words = self.hashes(self.starts, self.ends)
        return self._words

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``k`` words inside a document, and its first word."""
        words, m = self.words, len(self.words) - k + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:m] == self.doc[k - 1 :])
        acc = np.zeros(len(at), np.uint64)
        for j in range(k):
            acc += words[at + j] * WORD_COEF[j]
        return mix(acc), at

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document of every ``\\n``-split line that has a word."""
        feeds = np.flatnonzero(self.data == 10)
        starts = np.union1d(self.offsets[:-1], feeds + 1)
        starts = starts[starts < len(self.data)]
        ends = np.concatenate((starts[1:], [len(self.data)]))[: len(starts)]
        ends = ends - (self.data[ends - 1] == 10)
        held = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        starts, ends = starts[held], ends[held]
        return self.hashes(starts, ends), self.owner(starts)

    def n_dup_lines(self) -> np.ndarray:
        """Per document, the lines with a word that equal an earlier line."""
        h, doc = self.lines()
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        return np.bincount(doc[1:][same], minlength=self.n)

    def n_repeat_words(self, k: int = 8) -> np.ndarray:
        """Per document, the words that lie in a window of ``k`` found twice or more."""
        h, at = self.windows(k)
        doc = self.doc[at]
        again = np.zeros(len(at), bool)
        cuts = np.searchsorted(doc, np.arange(self.n + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                s = np.sort(h[a:b])
                twice = s[1:][s[1:] == s[:-1]]
                if len(twice):
                    again[a:b] = np.isin(h[a:b], twice)
        step = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(step, at[again], 1)
        np.add.at(step, at[again] + k, -1)
        covered = np.cumsum(step[:-1]) > 0
        return np.bincount(self.doc[covered], minlength=self.n)

    def shingle_sets(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes, ascending in each document, and the cuts between documents.

        A document of fewer than ``k`` words has its whole sequence as one
        shingle; one without words has none.
        """
        h, at = self.windows(k)
        doc = self.doc[at]
        cuts = np.searchsorted(doc, np.arange(self.n + 1))
        parts, sizes = [], np.zeros(self.n, np.int64)
        for i in range(self.n):
            a, b, m = cuts[i], cuts[i + 1], self.n_words[i]
            if m >= k:
                s = np.sort(h[a:b])
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif m:
                w = self.words[self.word_cuts[i] : self.word_cuts[i + 1]]
                s = mix((w * WORD_COEF[: len(w)]).sum(dtype=np.uint64, keepdims=True) ^ U64(m))
            else:
                continue
            parts.append(s)
            sizes[i] = len(s)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return flat, np.concatenate(([0], np.cumsum(sizes)))
