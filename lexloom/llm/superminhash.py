"""SuperMinHash signatures of shingle sets, for many documents at once.

Every element deals its values over the ``m`` places of a signature along a
random permutation: at level ``l`` it offers ``l + r`` (``r`` uniform in
[0, 1)) to one place.  A place keeps the least offer.  The ranks of one element
are thus correlated, which lowers the variance against ``m`` independent hash
functions.  A document is finished at level ``l`` once all of its places hold
values below ``l + 1``, since later levels only offer more; with many shingles
that is after one or two levels.
"""

from __future__ import annotations

import numpy as np

from .textvec import U64, mix

_UNSET = np.uint32(0xFFFFFFFF)
_LEVEL = mix(np.arange(256, dtype=np.uint64) * U64(0xD1B54A32D192ED03))


def _draw(h: np.ndarray, level: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Value and chosen index of each element at a level."""
    z = mix(h ^ _LEVEL[level])
    value = (z & U64(0xFFFFFF)).astype(np.uint32) | np.uint32(level << 24)
    return value, (level + (((z >> U64(32)) * U64(m - level)) >> U64(32)).astype(np.int64))


def signatures(flat: np.ndarray, cuts: np.ndarray, m: int) -> np.ndarray:
    """Signatures (documents x ``m``, uint32) of the sets ``flat[cuts[i]:cuts[i+1]]``.

    An empty set's signature is all ones bits.  ``m`` is at most 255.
    """
    n = len(cuts) - 1
    sig = np.full(n * m, _UNSET, np.uint32)
    doc = np.repeat(np.arange(n), np.diff(cuts))
    h, first, perm = flat, None, None
    for level in range(m):
        if not len(h):
            break
        value, k = _draw(h, level, m)
        if level == 0:
            first = place = k
        elif level == 1:
            place = np.where(k == first, 0, k)
        else:
            if perm is None:
                rows = np.arange(len(h))
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(h), 1))
                perm[rows, first] = 0
                perm[rows, 0] = first
                one = _draw(h, 1, m)[1]
                perm[rows, one], perm[rows, 1] = perm[rows, 1], perm[rows, one]
            rows = np.arange(len(h))
            place = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, level]
        np.minimum.at(sig, doc * m + place, value)
        done = sig.reshape(n, m).max(1) < ((level + 1) << 24)
        left = ~done[doc]
        if not left.all():
            h, doc, first = h[left], doc[left], first[left]
            perm = perm[left] if perm is not None else None
    return sig.reshape(n, m)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` adjacent places (documents x bands, int64)."""
    n, m = sig.shape
    parts = sig.reshape(n, m // rows, rows).astype(np.uint64)
    acc = np.zeros((n, m // rows), np.uint64)
    for j in range(rows):
        acc = mix(acc ^ parts[:, :, j])
    return acc.view(np.int64)
