"""Toxicity from averaged subword embeddings and a linear softmax, trained together.

A word is its character n-grams, each with a vector of its own; a document is the mean of all its
n-grams' vectors, and a linear layer with softmax gives its class. Unseen spellings of a word share
most of its n-grams. Vectors and layer are trained together on a bounded sample.

As the layer is linear, a word adds a fixed amount to a document's logits. Workers compute that
amount once per word they meet and then look it up; all words of all texts count.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.labelled import sample, scored

PER_CLASS = 4000  # the largest number of labelled rows of each class that are fitted
CUT = 0.3
BUCKETS = 1 << 16
LENGTHS = (3, 4, 5)  # bytes
WIDTH = 8
EPOCHS = 12
CLEAN_BIAS = 2.5  # where training starts from: a text without any known n-gram is clean
BATCH = 256
CLIPPINGS = 2  # short stretches of each clean document that are fitted as further clean texts
RATE = 0.03
SCALE = 100.0  # logits per unit of the mean: a few words in a hundred decide
DECAY = 1e-4
WORDS_KEPT = 400_000
WORDS_AT_ONCE = 8192  # of the sample's words, whose n-grams are found together


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, and the word each belongs to."""
    coded = [b"<" + w.encode("utf-8", "replace") + b">" for w in words]
    raw = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(raw))  # bytes to the word's end
    found, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    mixed = raw.copy()
    for n in range(2, min(max(LENGTHS), len(raw)) + 1):
        mixed[: len(raw) - n + 1] = mixed[: len(raw) - n + 1] * np.uint32(0x01000193) + raw[n - 1 :]
        if n in LENGTHS:
            inside = np.flatnonzero(left >= n)
            h = (mixed[inside] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            found.append((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1))
            owners.append(owner[inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


@dataclass
class Subwords:
    """What each n-gram's vector adds to the logit, and the words seen so far."""

    weights: np.ndarray
    bias: float
    _index: dict[str, int] = field(default_factory=dict)
    _sums: np.ndarray = field(default_factory=lambda: np.zeros(0))
    _counts: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _learn(self, texts: list[list[str]]) -> None:
        if len(self._index) > WORDS_KEPT:
            self._index, self._sums, self._counts = {}, np.zeros(0), np.zeros(0)
        new = list({w for words in texts for w in words}.difference(self._index))
        if new:
            buckets, owners = grams(new)
            self._index.update(zip(new, range(len(self._sums), len(self._sums) + len(new)), strict=True))
            self._sums = np.append(self._sums, np.bincount(owners, self.weights[buckets], len(new)))
            self._counts = np.append(self._counts, np.bincount(owners, minlength=len(new)))

    def __call__(self, texts: list[str]) -> np.ndarray:
        split = [t.lower().split() for t in texts]
        self._learn(split)
        out = np.zeros(len(texts))
        for i, words in enumerate(split):
            rows = np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))
            out[i] = self._sums[rows].sum() / max(self._counts[rows].sum(), 1)
        return 1 / (1 + np.exp(-np.clip(SCALE * out + self.bias, -30, 30)))


def fit(texts: list[str], labels: np.ndarray, seed: int = 11) -> Subwords:
    """Train vectors and softmax layer together by Adam over shuffled batches of the sample."""
    if len(set(labels.tolist())) < 2:
        return Subwords(np.zeros(BUCKETS), 4.0 if len(labels) and labels[0] == 1 else -4.0)
    # the sample as a sparse matrix: share of each bucket among a document's n-grams
    draw = np.random.Generator(np.random.PCG64(seed))
    vocabulary: dict[str, int] = {}
    split = [
        np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t.lower().split()], np.int32) for t in texts
    ]
    clean = [words for words, y in zip(split, labels, strict=True) if y == 0 and len(words)]
    for words in clean * CLIPPINGS:  # short clean texts, in which a chance n-gram weighs most
        at, n = int(draw.integers(0, len(words))), int(draw.integers(1, 40))
        split.append(words[at : at + n])
    labels = np.append(labels, np.zeros(len(split) - len(labels), np.int64))
    # the matrix outgrows the sample many times: its arrays grow in place, with buckets of two bytes
    buckets, lengths, distinct = array("H"), [np.zeros(0, np.int64)], list(vocabulary)
    for i in range(0, len(distinct), WORDS_AT_ONCE):
        some = distinct[i : i + WORDS_AT_ONCE]
        found, owners = grams(some)
        buckets.frombytes(found[np.argsort(owners, kind="stable")].astype(np.uint16).tobytes())
        lengths.append(np.bincount(owners, minlength=len(some)))
    buckets, ends = np.frombuffer(buckets, np.uint16), np.cumsum(np.concatenate(lengths))
    del distinct, vocabulary
    cols, shares, sizes = array("H"), array("f"), [0]
    for words in split:
        ids, times = np.unique(words, return_counts=True)
        lengths = ends[ids] - np.where(ids > 0, ends[ids - 1], 0)
        at = np.repeat(ends[ids] - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
        counts = np.bincount(buckets[at], np.repeat(times, lengths), BUCKETS)
        held = np.flatnonzero(counts)
        cols.frombytes(held.astype(np.uint16).tobytes())
        shares.frombytes((counts[held] / max(counts.sum(), 1)).astype(np.float32).tobytes())
        sizes.append(len(held))
    first = np.cumsum(sizes)
    cols, shares = np.frombuffer(cols, np.uint16), np.frombuffer(shares, np.float32)

    vectors, layer = draw.normal(0, 0.05, (BUCKETS, WIDTH)), draw.normal(0, 0.3, (WIDTH, 2))
    bias = np.array([CLEAN_BIAS, -CLEAN_BIAS])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, layer, bias)]
    steps = EPOCHS * -(-len(split) // BATCH)
    queue = np.concatenate([draw.permutation(len(split)) for _ in range(EPOCHS + 1)])
    for t in range(1, steps + 1):
        batch = queue[(t - 1) * BATCH : t * BATCH]
        lengths = first[batch + 1] - first[batch]
        at = np.repeat(first[batch + 1] - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
        own, used, share = np.repeat(np.arange(len(batch)), lengths), cols[at], shares[at]
        # the layer is linear: averaging what the vectors add to each class equals adding the average
        toward = vectors @ layer
        logits = SCALE * np.stack(
            [np.bincount(own, share * toward[used, c], len(batch)) for c in (0, 1)], axis=1
        ) + bias
        shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
        wrong = (shifted / shifted.sum(axis=1, keepdims=True) - np.eye(2)[labels[batch]]) / len(batch)
        # two classes: their errors are opposite, so one sparse sum serves both and all widths
        per_bucket = SCALE * np.bincount(used, share * wrong[own, 1], BUCKETS)
        grads = (
            np.outer(per_bucket, layer[:, 1] - layer[:, 0]) + DECAY * vectors,
            np.outer(vectors.T @ per_bucket, [-1.0, 1.0]),
            wrong.sum(axis=0),
        )
        for p, g, s in zip((vectors, layer, bias), grads, state, strict=True):
            s[0] *= 0.9
            s[0] += 0.1 * g
            s[1] *= 0.99
            s[1] += 0.01 * g * g
            p -= RATE * (1 - t / (steps + 1)) * (s[0] / (1 - 0.9**t)) / (np.sqrt(s[1] / (1 - 0.99**t)) + 1e-8)
    return Subwords(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def toxicity(docs: DataFrame, fit_docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with ``score`` from 0 to 1 and ``predicted``, 1 where the score is at least ``CUT``.

    ``labels`` (doc_id, toxic) are looked up in ``fit_docs``, at most ``per_class`` of each class.
    Texts alone decide: equal texts have equal scores. Null and empty texts have no n-grams and get
    the score of the bias. Without labels of both classes every document gets the same score, high
    only if all labels are 1. Repeated rows and further columns are kept; an empty table stays empty.
    Columns of these two names are replaced.
    """
    model = fit(*sample(fit_docs, labels, "toxic", per_class))
    weights, bias = model.weights, model.bias
    out = scored(docs, lambda: Subwords(weights, bias))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
