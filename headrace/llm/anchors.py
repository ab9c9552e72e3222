"""Anchors of byte windows: equal windows have equal anchors at equal places."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

GRAM = 16
JOINED = 1 << 16  # bytes of short texts that are worked on together
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0x7FFFFFFF)  # texts are shorter than 2 GB


def gram_prints(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A fingerprint of every ``gram`` consecutive bytes; ``gram`` is a power of two."""
    h = raw.astype(np.uint64)
    h += np.uint64(1)
    step = 1
    while step < gram:
        h = h[:-step] * _ODD + (h[step:] ^ (h[step:] >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        step *= 2
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _running_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Anchors(NamedTuple):
    """Per anchor: its text, print, place, and the first and last window it stands for."""

    owner: np.ndarray
    prints: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    sides: np.ndarray


def _sides(grams: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Two bytes each of a print of the gram and the one before, and of it and the one after it.

    Windows hold one or the other whole, if a window is at least three grams long, less a byte.
    """
    out = np.zeros((len(place), 2), np.uint16)
    for side, step in enumerate((-GRAM, GRAM)):
        there = place + step
        good = (there >= begin) & (there + GRAM <= end)
        mixed = grams[place[good]] * np.uint64(3) + grams[there[good]]
        out[good, side] = (mixed * _ODD >> np.uint64(48)).astype(np.uint16)
        out[~good, side] = np.arange(int((~good).sum())) & 0xFFFF  # no such gram: meets by chance only
    return out


def _joined(raws: list[np.ndarray], window: int) -> Anchors:
    """Anchors of texts laid end to end; windows across an end are left out."""
    sizes = np.array([len(r) for r in raws], np.int64)
    ends = np.cumsum(sizes)
    text = np.concatenate(raws) if len(raws) > 1 else raws[0]
    grams = gram_prints(text)
    # the place breaks ties, so the smallest value is unique in its window and names its place
    keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    low = _running_minimum(keyed, window - GRAM + 1)
    own = np.repeat(np.arange(len(raws)), sizes)[: len(low)]
    inside = np.arange(window, len(low) + window) <= ends[own]
    new = inside & np.append(True, (low[1:] != low[:-1]) | ~inside[:-1])
    first = np.flatnonzero(new)
    owner = own[first]
    last = np.minimum(np.append(first[1:], len(text)) - 1, ends[owner] - window)
    place = (low[first] & _PLACE).astype(np.int64)
    begin = ends[owner] - sizes[owner]
    sides = _sides(grams, place, begin, ends[owner])
    return Anchors(owner, grams[place], place - begin, first - begin, last - begin, sides)


def anchors(raws: list[np.ndarray], window: int) -> Anchors:
    """Anchors of all windows of all texts, by text and place.

    A window's anchor is the leftmost of its grams with the smallest fingerprint (by its upper bits).
    Every window has one and windows of one anchor are consecutive; a text shorter than a window has
    none. Fingerprints of anchors are small numbers: mix them before dealing rows out by them.
    """
    long = [i for i, r in enumerate(raws) if len(r) >= window]
    cuts = np.cumsum([len(raws[i]) for i in long]) // JOINED
    found = []
    for block in np.unique(cuts):
        a, b = np.searchsorted(cuts, [block, block + 1])
        part = _joined([raws[i] for i in long[a:b]], window)
        found.append(part._replace(owner=np.array(long[a:b], np.int64)[part.owner]))
    if not found:
        none = np.zeros(0, np.int64)
        return Anchors(none, none.astype(np.uint64), none, none, none, np.zeros((0, 2), np.uint16))
    return Anchors(*map(np.concatenate, zip(*found, strict=True)))
