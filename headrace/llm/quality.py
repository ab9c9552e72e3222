"""Quality scores learned from preference pairs (Bradley-Terry), cut at a quantile of the scores.

The chance that document a is preferred to b is sigmoid(s(a) - s(b)) with s linear in the text's
features; the weights minimise the logistic loss over differences of preferred and rejected
documents' features. The threshold is the score quantile of the fitted documents that errs least by
their labels, and the scale that of a logistic curve through it, so that a document at the threshold
has the score ``CUT``.

Features look at the whole text: shares of kinds of characters, shares of words by their shape,
repetition of words and of neighbouring words, and the same over its worst stretches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.labelled import sample, scored

PER_CLASS = 1500  # the largest number of labelled rows of each class that are fitted
PAIRS = 16  # partners of each document in a round of fitting
ROUNDS = 600
RATE = 0.05
DECAY = 1e-4
CUT = 0.3
STRETCH = 512  # bytes

_KINDS = np.zeros(256, np.int64)  # other ASCII signs: 0
for _at, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,", b"!?;:'\"-()")
):
    _KINDS[np.frombuffer(_bytes, np.uint8)] = _at + 1
_KINDS[128:] = 8
KINDS = 9


def _shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1))


def features(text: str) -> np.ndarray:
    """Numbers that describe one whole text; all zero but for its length if it is empty."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = _KINDS[raw]
    overall = np.bincount(kinds, minlength=KINDS)
    stretches = -(-max(len(raw), 1) // STRETCH)
    cells = np.bincount(np.arange(len(raw)) // STRETCH * KINDS + kinds, minlength=stretches * KINDS)
    cells = _shares(cells.reshape(stretches, KINDS))
    words = text.split()
    n = max(len(words), 1)
    distinct, pairs = len(set(words)), len(set(zip(words, words[1:], strict=False)))
    lines = text.split("\n")
    shape = [
        np.log1p(len(words)),
        len(raw) / n / 10,
        distinct / n,
        distinct / np.sqrt(n) / 10,
        pairs / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(len(lines)) / np.log1p(n),
    ]
    return np.concatenate([_shares(overall), cells.max(axis=0), cells.min(axis=0), cells.mean(axis=0), shape])


@dataclass(frozen=True)
class Ranking:
    """A fitted linear ranking and the logistic curve that turns ranks into scores."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def rank(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.spread, -8, 8) @ self.weights

    def __call__(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        steps = self.slope * (self.rank(np.stack([features(t) for t in texts])) - self.threshold)
        return 1 / (1 + np.exp(-np.clip(steps + np.log(CUT / (1 - CUT)), -30, 30)))


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> Ranking:
    """Fit on documents of both classes; with one class only, every score is that class's constant."""
    if len(set(labels.tolist())) < 2:
        width = len(features(""))
        far = -1.0 if len(labels) == 0 or labels[0] == 1 else 1.0
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), far, 3.0)
    rows = np.stack([features(t) for t in texts])
    centre, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    x = np.clip((rows - centre) / spread, -8, 8)
    good, bad = x[labels == 1], x[labels == 0]
    draw = np.random.Generator(np.random.PCG64(seed))
    w, mean, square = np.zeros(x.shape[1]), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        better = good[draw.integers(0, len(good), PAIRS * 64)]
        difference = better - bad[draw.integers(0, len(bad), PAIRS * 64)]
        wrong = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
        grad = DECAY * w - wrong @ difference / len(wrong)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        step = (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        w = w - RATE * (1 - t / (ROUNDS + 1)) * step
    ranks = x @ w
    # the quantile at which both classes' shares of errors are smallest together
    grid = np.quantile(ranks, np.linspace(0, 1, 1001))
    errors = (ranks[labels == 1][:, None] < grid).mean(axis=0) + (ranks[labels == 0][:, None] >= grid).mean(axis=0)
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    cut = grid[best[len(best) // 2]]
    # any place between the ranks on both sides of that quantile errs alike: the middle
    threshold = float((ranks[ranks < cut].max(initial=cut - 1) + ranks[ranks >= cut].min(initial=cut + 1)) / 2)
    gap = ranks[labels == 1].mean() - ranks[labels == 0].mean()
    return Ranking(centre, spread, w, threshold, float(8 / max(gap, 1e-6)))


def quality(docs: DataFrame, fit_docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with ``score`` from 0 to 1 and ``predicted``, 1 where the score is at least ``CUT``.

    ``labels`` (doc_id, quality) are looked up in ``fit_docs``, at most ``per_class`` of each class.
    Texts alone decide: equal texts have equal scores. Null and empty texts are scored as empty.
    Without labels of both classes every document gets the score of the only class, and 1 without
    any. Repeated rows and further columns are kept; an empty table stays empty.
    Columns of these two names are replaced.
    """
    model = fit(*sample(fit_docs, labels, "quality", per_class))
    out = scored(docs, lambda: model)
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
