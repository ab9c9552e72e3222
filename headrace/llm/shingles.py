"""Word shingles of whole texts as sorted sets of 64-bit fingerprints."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 4
_LONGEST = 4096  # bytes of a word that have multipliers of their own
_DRAW = np.random.Generator(np.random.PCG64(17))
_PLACES = _DRAW.integers(0, 2**63, _LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct fingerprints of each text's word ``n``-grams, A-Z in lower case.

    Words are parted by ASCII white space. A text of fewer words, but not none, has its whole
    sequence as the only shingle; without words the set is empty. Texts are read together.
    """
    coded = [(t or "").encode("utf-8", "replace").translate(_LOWER) for t in texts]
    raw = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(np.append(True, blank[:-1]) & ~blank)
    ends = np.flatnonzero(np.append(~blank[:-1] & blank[1:], False)) + 1
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    sizes = ends - starts
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters = raw[np.repeat(starts, sizes) + inside].astype(np.uint64) + np.uint64(1)
    letters *= _PLACES[inside & (_LONGEST - 1)]
    prints = np.add.reduceat(letters, np.cumsum(sizes) - sizes, dtype=np.uint64)
    for i in np.flatnonzero(sizes > _LONGEST):
        word = raw[starts[i] : ends[i]].tobytes()
        prints[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    prints = mixed(prints)
    bounds = np.searchsorted(starts, np.cumsum([len(c) + 1 for c in coded]))

    def joined(words: np.ndarray, width: int) -> np.ndarray:
        out = np.full(max(0, len(words) - width + 1), width, np.uint64)
        for i in range(width):
            out = mixed(out * _STEP + words[i : len(words) - width + 1 + i])
        return out

    grams, first, sets = joined(prints, n), 0, []
    for last in bounds:
        words = int(last - first)
        own = grams[first : last - n + 1] if words >= n else joined(prints[first:last], words) if words else grams[:0]
        own = np.sort(own)
        sets.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
        first = last
    return sets
