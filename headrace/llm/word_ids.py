"""Token ids of whole texts by way of their distinct words.

Libraries spend most of their time on words they have seen before. Where a tokenizer never merges
across a space, a text's ids are those of its words one after the other, so each worker encodes a
word once and looks it up afterwards. The memory of words is bounded; it starts anew when full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

WORDS_KEPT = 300_000


class WordIds:
    """Ids of words, kept in one flat array; ``encode`` gives the ids of a list of words."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], kept: int = WORDS_KEPT):
        self._encode, self._kept = encode, kept
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._lengths, self._starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.uint32)

    def _learn(self, words: Iterable[str]) -> None:
        new = list(set(words).difference(self._index))
        if not new:
            return
        ids = self._encode(new)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = len(self._flat) + np.cumsum(lengths) - lengths
        self._index.update(zip(new, range(len(self._lengths), len(self._lengths) + len(new)), strict=True))
        self._lengths = np.concatenate([self._lengths, lengths])
        self._starts = np.concatenate([self._starts, starts])
        self._flat = np.concatenate(
            [self._flat, np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))]
        )

    def learn(self, texts: list[list[str]]) -> None:
        """Encode what is new in these word lists; afterwards they can be looked up."""
        if len(self._index) > self._kept:
            self._clear()
        self._learn(w for words in texts for w in words)

    def _rows(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))

    def ids(self, words: list[str]) -> np.ndarray:
        rows = self._rows(words)
        lengths = self._lengths[rows]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._starts[rows] - ends + lengths, lengths)
        return self._flat[shift + np.arange(len(shift))]

    def count(self, words: list[str]) -> int:
        return int(self._lengths[self._rows(words)].sum())
