"""Suffix order by recursive induction with disk-backed queues.

Suffixes are sorted as deep as a caller needs, by bytes:

1. *Samples.* A suffix is of type S if it is smaller than the next one, else L; the leftmost S
   suffixes (and further ones wherever these are over ``STEP`` bytes apart) are samples. A sample's
   name is the rank of its next eight bytes and of its distance to the next sample.
2. *Recursion.* Names in text order are a shorter text, whose suffixes have the samples' order. It is
   sorted by itself in rounds that each double the common prefix every rank stands for; samples that
   tie carry that prefix's length and drop out once it reaches the depth asked for.
3. *Induction.* Keyed by first byte, a priority queue takes each L suffix when its successor leaves it,
   from the smallest byte up; a second one takes the S suffixes from the largest byte down. Keys only
   ever move one way, so the queue is one append-only list for each key. Lists over ``HELD`` entries
   in total move to a scratch file of the task, as a sort's spill does.
"""

from __future__ import annotations

import tempfile

import numpy as np

STEP = 6
HELD = 1 << 24


class Queue:
    """First in, first out for each of 256 keys; entries beyond ``held`` wait on disk."""

    def __init__(self, held: int = HELD):
        self._lists: list[list] = [[] for _ in range(256)]
        self._limit, self._held, self._file = held, 0, None

    def push(self, key: int, entries: np.ndarray) -> None:
        if self._held + len(entries) > self._limit:
            self._spill()
        self._lists[key].append(entries)
        self._held += len(entries)

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        self._file.seek(0, 2)
        for own in self._lists:
            for i, entries in enumerate(own):
                if isinstance(entries, np.ndarray):
                    own[i] = (self._file.tell(), len(entries))
                    self._file.write(entries.tobytes())
        self._held = 0

    def pop(self, key: int) -> np.ndarray:
        own, self._lists[key] = self._lists[key], []
        parts = []
        for entries in own:
            if isinstance(entries, tuple):
                self._file.seek(entries[0])
                entries = np.frombuffer(self._file.read(4 * entries[1]), np.int32)
            else:
                self._held -= len(entries)
            parts.append(entries)
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, first byte highest; zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(7, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out <<= np.uint64(8)
        out |= padded[i : i + len(text)]
    return out


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last is not."""
    n = len(text)
    if n == 0:
        return np.zeros(0, bool)
    differs = np.append(text[1:] != text[:-1], True)
    # the last place of each run of equal bytes decides for the run
    ends = np.flatnonzero(differs)
    rises = np.append(text[ends[:-1] + 1] > text[ends[:-1]], False)
    return np.repeat(rises, np.diff(np.append(-1, ends)))


def _samples(kind: np.ndarray) -> np.ndarray:
    lms = np.flatnonzero(np.append(False, kind[1:] & ~kind[:-1]))
    bounds = np.concatenate([[0], lms, [len(kind)]])
    gaps = np.diff(bounds)
    more = (gaps - 1) // STEP  # samples in between, where two are far apart
    at = np.repeat(bounds[:-1], more)
    place = np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
    chosen = np.zeros(len(kind), bool)
    chosen[lms] = chosen[at + (place + 1) * STEP] = True
    return np.flatnonzero(chosen)


def _ranked(key: np.ndarray) -> np.ndarray:
    """Dense ranks."""
    order = np.argsort(key)
    key = key[order]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.append(False, key[1:] != key[:-1])[: len(key)])
    return out


def _sample_ranks(word: np.ndarray, samples: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the samples' suffixes; ties have a common prefix of ``depth`` or more bytes."""
    n = len(samples)
    following = np.append(samples[1:], len(word) + STEP)
    rank = _ranked(_ranked(word[samples]) * (STEP + 2) - np.minimum(following - samples, STEP + 1))
    reach = 1  # samples that a rank stands for
    while n:
        # common-prefix values: what equal ranks are sure to share, in bytes
        shared = np.append(samples, np.full(reach, len(word) + depth))[reach : reach + n] - samples
        tied = np.bincount(rank)[rank] > 1
        open_ = tied & (shared < depth)
        if not open_.any():
            return rank
        later = np.append(rank + 1, np.zeros(reach, np.int64))[reach : reach + n]
        rank = _ranked(rank * (n + 1) + np.where(open_, later, 0))
        reach *= 2
    return rank


def _push(queue: Queue, text: np.ndarray, entries: np.ndarray, own: int) -> np.ndarray:
    """Queue entries by first byte, in order; those whose byte is ``own`` are returned instead."""
    if not len(entries):
        return entries
    first = text[entries]
    order = np.argsort(first, kind="stable")
    entries, first = entries[order], first[order]
    cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    again = entries[:0]
    for at, end in zip(cuts, np.append(cuts[1:], len(first)), strict=True):
        if first[at] == own:
            again = entries[at:end]
        else:
            queue.push(int(first[at]), entries[at:end])
    return again


def suffix_order(text: np.ndarray, depth: int, held: int = HELD) -> np.ndarray:
    """All suffixes in order; those with ``depth`` or more bytes in common may stand in any order."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int32)
    kind = suffix_types(text)
    samples = _samples(kind)
    ranks = _sample_ranks(words(text), samples, depth)
    chosen = samples[np.argsort(ranks)]
    is_lms = kind[chosen] & (chosen > 0)
    is_lms[is_lms] &= ~kind[chosen[is_lms] - 1]
    lms = chosen[is_lms].astype(np.int32)
    by_first = np.split(lms, np.searchsorted(text[lms], np.arange(1, 256)))

    queue, large = Queue(held), []
    _push(queue, text, np.array([n - 1], np.int32), -1)
    for c in range(256):
        bucket = []
        now = queue.pop(c)
        while len(now):
            bucket.append(now)
            before = now[now > 0] - np.int32(1)
            now = _push(queue, text, before[text[before] >= c], c)
        large.append(np.concatenate(bucket) if bucket else lms[:0])
        before = by_first[c] - np.int32(1)
        _push(queue, text, before[text[before] > c], -1)
    queue.close()

    queue, out = Queue(held), []
    for c in range(255, -1, -1):
        now = queue.pop(c)
        while len(now):
            out.append(now)
            before = now[now > 0] - np.int32(1)
            before = before[kind[before]]
            now = _push(queue, text, before[text[before] <= c], c)
        falling = large[c][::-1]
        out.append(falling)
        before = falling[falling > 0] - np.int32(1)
        _push(queue, text, before[kind[before] & (text[before] < c)], -1)
    queue.close()
    return np.concatenate(out)[::-1]


def equal_windows(text: np.ndarray, starts: np.ndarray, window: int, held: int = HELD) -> np.ndarray:
    """A number for each start's ``window`` bytes, the same exactly for equal ones; starts ascend."""
    if not len(starts):
        return np.zeros(0, np.int64)
    place = np.full(len(text), -1, np.int32)
    place[starts] = np.arange(len(starts), dtype=np.int32)
    order = place[suffix_order(text, window, held)]
    order = order[order >= 0]
    word, at = words(text), starts[order]
    # neighbours in the order: eight bytes at a time, the last eight overlapping
    same = np.ones(len(at) - 1, bool)
    for i in [*range(0, window - 8, 8), window - 8]:
        left = np.flatnonzero(same)
        same[left] = word[at[left] + i] == word[at[left + 1] + i]
    out = np.empty(len(starts), np.int64)
    out[order] = np.cumsum(np.append(0, ~same))
    return out
