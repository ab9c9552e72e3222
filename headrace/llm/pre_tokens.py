"""Token ids of whole texts by way of their distinct pre-tokens.

A byte-pair tokenizer cuts a text into pre-tokens and merges inside each of them alone, so a text's ids
are its pre-tokens' ids, and a worker needs to encode each only once. For Latin texts they are found
here by the file's own pattern, after its lower-casing; new ones are encoded together, a whole list in
one call. Every other text, and any that holds one of the file's added tokens, is cut at blanks only, and its
words are encoded by the library one by one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np

KEPT = 600_000
# Up to U+017F composition changes nothing and lower-casing maps one letter to one, but for U+0130.
_OTHER = re.compile("[^\x00-ſ]|İ")
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
# The pattern of the tokenizer file and its normalizers, which this class stands in for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")


class PreTokenIds:
    """Ids of texts by one tokenizer file, no special tokens added; what was encoded is kept.

    When ``kept`` pre-tokens are known, those not seen since the last time are given up.
    """

    def __init__(self, path: str, kept: int = KEPT):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._kept = kept
        self._index: dict[str, int] = {}
        self._flat = np.zeros(1 << 16, np.uint32)
        self._starts, self._lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._seen = np.zeros(1 << 14, bool)
        self._used = 0
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        steps = [n.get("type") for n in (plan["normalizer"] or {}).get("normalizers", [])]
        patterns = [p.get("pattern", {}).get("Regex") for p in (plan["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self._known_plan = steps == NORMALIZERS and PATTERN in patterns
        self._added = [t["content"] for t in plan["added_tokens"]]

    def parted(self, text: str) -> list[str]:
        """The pre-tokens of a Latin text; the words of another one."""
        if not self._known_plan or _OTHER.search(text) or any(t in text for t in self._added):
            return [w for w in text.replace("\n", " ").split(" ") if w]
        return _LATIN.findall(text.lower())

    def _encoded(self, new: list[str], latin: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all, one after another, and how many each has; in one call if each is one pre-token."""
        if latin:
            whole = self._tokenizer.encode(" ".join(new), add_special_tokens=False)
            owner = np.array(whole.word_ids, np.int64)
            lengths = np.bincount(owner, minlength=len(new))
            if len(lengths) == len(new) and lengths.all():
                return np.array(whole.ids, np.uint32), lengths
        found = [x.ids for x in self._tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _grown(self, array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])

    def _evict(self) -> None:
        """Keep what was seen since the last time, in the same order."""
        n = len(self._index)
        rows = np.flatnonzero(self._seen[:n])
        lengths, starts = self._lengths[rows], self._starts[rows]
        ends = np.cumsum(lengths)
        flat = self._flat[np.repeat(starts - ends + lengths, lengths) + np.arange(lengths.sum())]
        kept = self._seen[:n].tolist()
        self._index = {p: i for i, p in enumerate(p for p, stays in zip(self._index, kept, strict=True) if stays)}
        self._used = len(flat)
        self._flat[: self._used] = flat
        self._lengths[: len(rows)], self._starts[: len(rows)] = lengths, ends - lengths
        self._seen[:] = False

    def _learn(self, new: list[str]) -> None:
        latin = [p for p in new if _LATIN.fullmatch(p) and not _OTHER.search(p)]
        known = set(latin)
        for some, simple in ((latin, True), ([p for p in new if p not in known], False)):
            if not some:
                continue
            ids, lengths = self._encoded(some, simple)
            n, last, end = len(self._index), len(self._index) + len(some), self._used + len(ids)
            self._flat = self._grown(self._flat, end)
            self._flat[self._used : end] = ids
            self._lengths, self._starts = self._grown(self._lengths, last), self._grown(self._starts, last)
            self._seen = self._grown(self._seen, last)
            self._lengths[n:last] = lengths
            self._starts[n:last] = self._used + np.cumsum(lengths) - lengths
            self._used = end
            self._index.update(zip(some, range(n, last), strict=True))

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; texts are looked up together, each pre-token once."""
        if len(self._index) >= self._kept:
            self._evict()
        parted = [self.parted(t) for t in texts]
        sizes = [len(p) for p in parted]
        every = list(chain.from_iterable(parted))
        rows = np.fromiter(map(self._index.get, every, repeat(-1)), np.int64, len(every))
        unknown = np.flatnonzero(rows < 0).tolist()
        if unknown:
            self._learn(list({every[i] for i in unknown}))
            rows[unknown] = [self._index[every[i]] for i in unknown]
        self._seen[rows] = True
        at = 0
        for size in sizes:
            own = rows[at : at + size]
            lengths = self._lengths[own]
            ends = np.cumsum(lengths)
            shift = np.repeat(self._starts[own] - ends + lengths, lengths)
            yield self._flat[shift + np.arange(len(shift))]
            at += size
