"""Words and shingles of whole texts as 64-bit hashes, by numpy in Python workers."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

WIDTH = 5
#: Texts are cut into pieces of about this many bytes (at white space) before they are split.
PIECE = 1 << 22
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S1, _S2 = np.uint64(29), np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S2)) * _K1
    x = (x ^ (x >> _S1)) * _K2
    return x ^ (x >> _S2)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words (runs of other than ASCII white space), A-Z lowered."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(data) <= PIECE:
        found = data.split()
        return np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        found = data[at:end].split()
        out.append(np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found)))
        at = end
    return np.concatenate(out)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, an empty one none."""
    h = word_hashes(text)
    if not len(h):
        return h
    if len(h) < width:
        # the length takes part, so that a short text never equals a shingle
        acc = np.full(1, len(h), np.uint64)
        for x in mix(h):
            acc = mix(acc * _K1 + x)
        return acc
    n = len(h) - width + 1
    acc = mix(h[:n])
    for j in range(1, width):
        acc = mix(acc * _K1 + h[j : j + n])
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]
