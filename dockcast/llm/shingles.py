"""Word shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z
lower-cased. A word's hash is a difference of prefix sums of a polynomial over the bytes.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
#: byte -> its lower-case form, or 0 where words end
FOLD = np.zeros(256, np.uint8)
for _c in range(256):
    if 48 <= _c <= 57 or 97 <= _c <= 122 or _c >= 128:
        FOLD[_c] = _c
    elif 65 <= _c <= 90:
        FOLD[_c] = _c + 32

_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def slices(texts: list[str | None]):
    """(first, last) of runs of texts of about ``SLICE_BYTES``; a longer text is a run of its own."""
    first = size = 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > SLICE_BYTES:
            yield first, k
            first, size = k, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. A text of fewer words than a shingle has, but
    not none, is one shingle; one without words has none."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    folded = FOLD[data]
    inside = np.empty(len(folded) + 1, bool)
    inside[0], inside[1:] = False, folded > 0
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return [np.empty(0, np.uint64) for _ in texts]
    power, inverse = powers(len(folded) + 1)
    total = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(folded.astype(np.uint64) * power[:len(folded)], out=total[1:])
    word = mixed((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64))
    bounds = np.searchsorted(start, np.concatenate(([0], ends)))
    n = len(word)
    rolled = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * _U(_BASE) + word[k:n - SHINGLE + 1 + k] if n >= SHINGLE else rolled
    rolled = mixed(rolled)
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= SHINGLE:
            out.append(np.unique(rolled[low:high - SHINGLE + 1]))
        elif high > low:
            h = _U(high - low)
            with np.errstate(over="ignore"):
                for w in word[low:high]:
                    h = h * _U(_BASE) + w
            out.append(mixed(np.array([h], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
