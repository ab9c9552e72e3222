"""Main text of web pages by a recurrent block labeller.

A page is its sequence of leaf blocks. Each block is a vector: the hashed names on its tag path, its
hashed words, and a few measures. A bidirectional LSTM in numpy reads the whole sequence and labels
every block as main text or not, so a block is judged with the page before and after it in view.

There are no labels, so the network learns from pages that mark their parts: names on the path that
say what a part is for. In training, names that say so are put on some blocks at random and taken
off others, so that the network knows more names than the sample shows and reads words, measures and
neighbours where names are missing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.html_blocks import Block, blocks

FITTED_PAGES = 600  # the largest number of pages that are fitted
PATH_SLOTS, WORD_SLOTS, MEASURES = 256, 32, 6
WIDTH = PATH_SLOTS + WORD_SLOTS + MEASURES
UNITS = 12
EPOCHS = 10
BATCH = 24
RATE = 0.01
PAGES_AT_ONCE = 128

# Names of parts of a page that are not its main text, and of those that hold it.
ASIDE = (
    "nav menu header footer aside form button select textarea dialog noscript .nav .navbar .navigation .menu .header "
    ".footer .sidebar .aside .ad .ads .advert .advertisement .sponsor .sponsored .promo .banner .cookie .cookies "
    ".consent .notice .alert .popup .modal .newsletter .subscribe .signup .login .search .comment .comments .reply "
    ".discussion .disqus .share .social .related .recommended .breadcrumb .breadcrumbs .pagination .widget .copyright "
    ".toolbar .complementary .contentinfo"
).split()
MAIN = "article main .article .main .content .post .entry .story".split()
_ASIDE, _MAIN = frozenset(ASIDE), frozenset(MAIN)


# Odd multipliers for the bytes of a word by their place in it.
_PLACES = np.random.Generator(np.random.PCG64(3)).integers(1, 2**32, 64, dtype=np.uint32) | np.uint32(1)


@lru_cache(maxsize=10_000)
def _path_slots(path: tuple[str, ...]) -> tuple[int, ...]:
    return tuple(zlib.crc32(name.encode("utf-8", "replace")) % PATH_SLOTS for name in set(path))


def vectors(found: list[Block], paths: list[tuple[str, ...]]) -> np.ndarray:
    """One row per block: names on the path, shares of hashed words, measures."""
    out = np.zeros((len(found), WIDTH), np.float32)
    if not found:
        return out
    for i, path in enumerate(paths):
        out[i, _path_slots(path)] = 1
    coded = [b.text.encode("utf-8", "replace") + b" " for b in found]
    raw = np.frombuffer(b"".join(coded), np.uint8)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    ends = np.flatnonzero(raw == 32)  # single spaces part a block's words, one ends it
    starts = np.append(0, ends[:-1] + 1)
    place = np.arange(len(raw)) - np.repeat(starts, ends + 1 - starts)
    hashed = np.add.reduceat(raw.astype(np.uint32) * _PLACES[place & 63], starts, dtype=np.uint32)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    slots = (hashed * np.uint32(0x9E3779B1)) >> np.uint32(27)  # one of WORD_SLOTS
    n = np.bincount(owner, minlength=len(found))
    words = np.bincount(owner * WORD_SLOTS + slots.astype(np.int64), minlength=len(found) * WORD_SLOTS).reshape(-1, WORD_SLOTS)
    out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = words / n[:, None]
    out[:, -MEASURES:] = np.stack(
        [
            np.log1p(n) / 4,
            sizes / n / 10,
            np.array([b.text[-1] in ".!?…" for b in found]),
            np.array([b.linked for b in found]),
            np.array([b.text.count(",") for b in found]) / n,
            np.ones(len(found)),
        ],
        axis=1,
    )
    return out


def stated(path: tuple[str, ...]) -> float:
    """What the names on a path say: 1 main text, 0 not, 0.5 nothing."""
    if _ASIDE.intersection(path):
        return 0.0
    return 1.0 if _MAIN.intersection(path) else 0.5


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Direction:
    """One LSTM over time. Gates lie side by side: input, forget, output, candidate."""

    inputs: np.ndarray
    states: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, draw: np.random.Generator) -> Direction:
        bias = np.zeros(4 * UNITS, np.float32)
        bias[UNITS : 2 * UNITS] = 1
        small = lambda *shape: draw.normal(0, 0.15, shape).astype(np.float32)
        return cls(small(WIDTH, 4 * UNITS), small(UNITS, 4 * UNITS), bias)

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.bias]

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """Outputs (pages, time, units); padded steps leave the state as it is."""
        pages, steps, _ = x.shape
        drive = x.reshape(-1, WIDTH) @ self.inputs + self.bias
        drive = drive.reshape(pages, steps, -1)
        h, c = np.zeros((pages, UNITS), np.float32), np.zeros((pages, UNITS), np.float32)
        out, kept = np.zeros((pages, steps, UNITS), np.float32), []
        for t in range(steps):
            z = drive[:, t] + h @ self.states
            gates, g = _sigmoid(z[:, : 3 * UNITS]), np.tanh(z[:, 3 * UNITS :])
            i, f, o = gates[:, :UNITS], gates[:, UNITS : 2 * UNITS], gates[:, 2 * UNITS :]
            new_c = f * c + i * g
            squashed = np.tanh(new_c)
            m = mask[:, t : t + 1]
            kept.append((h, c, i, f, o, g, squashed, m))
            h, c = m * (o * squashed) + (1 - m) * h, m * new_c + (1 - m) * c
            out[:, t] = h
        return out, kept

    def backward(self, x: np.ndarray, kept: list, d_out: np.ndarray) -> list[np.ndarray]:
        pages, steps, _ = x.shape
        d_drive = np.zeros((pages, steps, 4 * UNITS), np.float32)
        d_states = np.zeros_like(self.states)
        dh, dc = np.zeros((pages, UNITS), np.float32), np.zeros((pages, UNITS), np.float32)
        for t in range(steps - 1, -1, -1):
            h, c, i, f, o, g, squashed, m = kept[t]
            dh = dh + d_out[:, t]
            dh_in, dc_in = m * dh, m * dc
            dc_new = dc_in + dh_in * o * (1 - squashed**2)
            dz = np.concatenate(
                [
                    dc_new * g * i * (1 - i),
                    dc_new * c * f * (1 - f),
                    dh_in * squashed * o * (1 - o),
                    dc_new * i * (1 - g**2),
                ],
                axis=1,
            )
            d_drive[:, t] = dz
            d_states += h.T @ dz
            dh = (1 - m) * dh + dz @ self.states.T
            dc = (1 - m) * dc + dc_new * f
        flat = d_drive.reshape(-1, 4 * UNITS)
        return [x.reshape(-1, WIDTH).T @ flat, d_states, flat.sum(axis=0)]


@dataclass
class Labeller:
    """Both directions and the layer that turns their outputs into a logit per block."""

    ahead: Direction
    back: Direction
    layer: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, seed: int) -> Labeller:
        draw = np.random.Generator(np.random.PCG64(seed))
        return cls(
            Direction.new(draw),
            Direction.new(draw),
            draw.normal(0, 0.3, 2 * UNITS).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.ahead.parameters(), *self.back.parameters(), self.layer, self.bias]

    def _run(self, x: np.ndarray, mask: np.ndarray):
        one, kept = self.ahead.forward(x, mask)
        turned = x[:, ::-1]
        two, kept_back = self.back.forward(turned, mask[:, ::-1])
        both = np.concatenate([one, two[:, ::-1]], axis=2)
        return both @ self.layer + self.bias, both, turned, kept, kept_back

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self._run(x, mask)[0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        logits, both, turned, kept, kept_back = self._run(x, mask)
        d = (weight * (_sigmoid(logits) - target) / max(weight.sum(), 1)).astype(np.float32)
        d_both = d[:, :, None] * self.layer
        return [
            *self.ahead.backward(x, kept, d_both[:, :, :UNITS]),
            *self.back.backward(turned, kept_back, d_both[:, ::-1, UNITS:]),
            np.einsum("pt,ptu->u", d, both),
            np.array([d.sum()], np.float32),
        ]

    def main_blocks(self, vectors: list[np.ndarray]) -> list[np.ndarray]:
        """Per page, which of its blocks are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(vectors)
        order = sorted((i for i, v in enumerate(vectors) if len(v)), key=lambda i: len(vectors[i]))
        while order:  # pages of like length together, at most about PAGES_AT_ONCE * 64 steps
            longest = len(vectors[order[-1]])
            take = max(1, min(PAGES_AT_ONCE, PAGES_AT_ONCE * 64 // longest))
            group, order = order[-take:], order[:-take]
            x, mask = padded([vectors[i] for i in group])
            logits = self.logits(x, mask)
            for row, i in enumerate(group):
                out[i] = logits[row, : len(vectors[i])] > 0
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, WIDTH), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, page in enumerate(pages):
        x[i, : len(page)], mask[i, : len(page)] = page, 1
    return x, mask


def fit(pages: list[str], seed: int = 5) -> Labeller:
    """Train on what the pages' own names say, with names put on and taken off at random."""
    draw = np.random.Generator(np.random.PCG64(seed))
    model = Labeller.new(seed)
    read = [b for b in map(blocks, pages) if b]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in model.parameters()]
    steps, t = EPOCHS * -(-len(read) // BATCH), 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(read))
        for at in range(0, len(order), BATCH):
            xs, ys, t = [], [], t + 1
            for i in order[at : at + BATCH]:
                page, y, held = [], [], []
                # one draw per page: names of its parts swapped for others, or missing; only some blocks there
                swap, bare, few = draw.random() < 0.4, draw.random() < 0.15, draw.random() < 0.3
                own, other = MAIN[draw.integers(len(MAIN))], ASIDE[draw.integers(len(ASIDE))]
                for block in read[i]:
                    path, says = block.path, stated(block.path)
                    if few and draw.random() < 0.6:
                        continue
                    if draw.random() < 0.12 and says > 0:
                        path, says = (*path, ASIDE[draw.integers(len(ASIDE))]), 0.0
                    elif bare and says != 0.5 and draw.random() < 0.5:
                        path = tuple(n for n in path if n not in _ASIDE and n not in _MAIN)
                    elif swap:
                        path = tuple(own if n in _MAIN else other if n in _ASIDE else n for n in path)
                    page.append(path)
                    y.append(says)
                    held.append(block)
                if not held:
                    continue
                xs.append(vectors(held, page))
                ys.append(y)
            if not xs:
                continue
            x, mask = padded(xs)
            target = np.zeros(mask.shape, np.float32)
            for row, y in enumerate(ys):
                target[row, : len(y)] = y
            weight = mask * (target != 0.5)
            for p, g, s in zip(model.parameters(), model.gradients(x, mask, target, weight), state, strict=True):
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.99 * s[1] + 0.01 * g * g
                step = (s[0] / (1 - 0.9**t)) / (np.sqrt(s[1] / (1 - 0.99**t)) + 1e-8)
                p -= (RATE * (1 - t / (steps + 1)) * step).astype(np.float32)
    return model


def main_texts(model: Labeller, pages: list[str]) -> list[str]:
    read = [blocks(p) for p in pages]
    every = [b for page in read for b in page]
    parts = np.split(vectors(every, [b.path for b in every]), np.cumsum([len(page) for page in read])[:-1])
    kept = model.main_blocks(parts)
    return [
        "\n\n".join(b.text for b, k in zip(page, keep, strict=True) if k)
        for page, keep in zip(read, kept, strict=True)
    ]


def extract(pages: DataFrame, fitted_pages: int = FITTED_PAGES) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``: its blocks joined by an empty line.

    The network is fitted on at most ``fitted_pages`` pages, those whose texts have the smallest
    hashes; all pages are labelled. A page without main text, without blocks, empty or null, has an
    empty text. Repeated rows get the same text. Other columns are kept, but for one named ``text``,
    which is replaced. An empty table stays empty.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    # hashes first, so that a task only gives the driver numbers; then their pages
    hashes = pages.select(F.xxhash64(html).alias("h")).distinct().orderBy("h").limit(fitted_pages)
    chosen = pages.select(html.alias("html"), F.xxhash64(html).alias("h")).join(F.broadcast(hashes), "h")
    few = chosen.dropDuplicates(["h"]).toPandas().sort_values("h")["html"]
    model = fit(list(few))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = [v or "" for v in batch]
            parts = [main_texts(model, values[i : i + 512]) for i in range(0, len(values), 512)]
            yield pd.Series([t for part in parts for t in part], dtype=object)

    return pages.withColumn("text", text(html))
