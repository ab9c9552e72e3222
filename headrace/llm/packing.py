"""Harmonic packing of tokenized documents into sequences of at most ``CAPACITY`` tokens.

Lengths belong to reciprocal-capacity classes: class j holds lengths over capacity/(j+1) and up to
capacity/j, and a bin of class j takes exactly j whole documents; lengths of the last class share a
bin as long as they fit. Classes fill independently of each other and of other workers: a task keeps
one open bin per class and no row ever leaves it, so there is no shuffle. What a full bin has left is
given to later documents: to one that fits whole, or else, when the gaps of a task have come to a
sequence together, by cutting the next document into them. Otherwise only documents over a whole sequence
are cut. A task's last bins are filled from each other, and what still is not full is divided into sequences
whose lengths are powers of two, which are not padded.

Sequence ids carry the partition's number. Which rows share a partition does not matter to what holds
inside it, so a task that is run again yields whole sequences again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.pre_tokens import PreTokenIds

CAPACITY = 4096
END_ID = 2
CLASSES = 64  # lengths up to capacity / CLASSES are one class
GAPS = 64  # bins with gaps that a task keeps
TEXTS_AT_ONCE = 256
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Whole capacities, then the powers of two that make up the rest, largest first."""
    rest = n % capacity
    digits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [capacity] * (n // capacity) + digits


@dataclass(slots=True, frozen=True)
class Piece:
    """Ids ``start`` to ``stop`` of one document."""

    doc_id: int | None
    ids: np.ndarray
    start: int
    stop: int

    def __len__(self) -> int:
        return self.stop - self.start

    def parted(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids, and the rest."""
        middle = self.start + n
        return Piece(self.doc_id, self.ids, self.start, middle), Piece(self.doc_id, self.ids, middle, self.stop)


class Bins:
    """One open bin for each class, and full ones with gaps; ``add`` and ``close`` return finished rows."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, classes: int = CLASSES, gaps: int = GAPS):
        self._next, self._capacity, self._classes, self._most = first_id, capacity, classes, gaps
        self._open: dict[int, list[Piece]] = {}
        self._gaps: list[tuple[int, list[Piece]]] = []  # free ids and pieces, smallest gap first
        self._free = 0

    def _sequence(self, pieces: list[Piece]) -> list[tuple]:
        rows, offset = [], 0
        for p in pieces:
            crc = zlib.crc32(p.ids[p.start : p.stop].tobytes())
            rows.append((p.doc_id, p.start, len(p), crc, len(p.ids), self._next, offset))
            offset += len(p)
        self._next += 1
        return rows

    def _closed(self, pieces: list[Piece]) -> list[tuple]:
        free = self._capacity - sum(map(len, pieces))
        if not free:
            return self._sequence(pieces)
        insort(self._gaps, (free, pieces), key=itemgetter(0))
        self._free += free
        return []

    def _fill(self, at: int, piece: Piece) -> list[tuple]:
        """Put a piece that fits into this gap."""
        free, pieces = self._gaps.pop(at)
        self._free -= free
        return self._closed([*pieces, piece])

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        piece, rows = Piece(doc_id, ids, 0, len(ids)), []
        while len(piece) >= self._capacity:
            whole, piece = piece.parted(self._capacity)
            rows += self._sequence([whole])
        if not len(piece):
            return rows
        fitting = bisect_left(self._gaps, len(piece), key=itemgetter(0))
        if fitting < len(self._gaps):
            return rows + self._fill(fitting, piece)
        if self._free >= self._capacity or len(self._gaps) >= self._most or len(ids) > self._capacity:
            while len(piece) and self._gaps:  # larger than any gap: the largest ones are filled first
                part, piece = piece.parted(min(len(piece), self._gaps[-1][0]))
                rows += self._fill(len(self._gaps) - 1, part)
        return rows + self._placed(piece) if len(piece) else rows

    def _placed(self, piece: Piece) -> list[tuple]:
        kind = min(self._capacity // len(piece), self._classes)
        held = self._open.setdefault(kind, [])
        if kind < self._classes:
            held.append(piece)
            return self._closed(self._open.pop(kind)) if len(held) == kind else []
        if sum(map(len, held)) + len(piece) <= self._capacity:
            held.append(piece)
            return []
        self._open[kind] = [piece]
        return self._closed(held)

    def close(self) -> list[tuple]:
        rest, rows = [p for held in self._open.values() for p in held], []
        self._open = {}
        waiting = [pieces for _, pieces in self._gaps] + ([rest] if rest else [])
        self._gaps, self._free = [], 0
        # one after another, cut where a sequence is full; the last one at the binary digits of its length
        pieces = [p for held in waiting for p in held]
        for length in cut_lengths(sum(map(len, pieces)), self._capacity):
            taken: list[Piece] = []
            while length:
                part, left = pieces[0].parted(min(length, len(pieces[0])))
                taken.append(part)
                length -= len(part)
                pieces[:1] = [left] if len(left) else []
            rows += self._sequence(taken)
        return rows


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids end with ``end_id``. Null and empty texts are that one id. Rows that repeat
    are packed each; a null id stays null. An empty table gives no rows. Other columns are ignored.
    ``capacity`` is a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = PreTokenIds(tokenizer_path)
        bins = Bins(TaskContext.get().partitionId() << 40, capacity)
        names = [c.split()[0] for c in PIECES.split(", ")]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame({name: pd.array(c, "Int64") for name, c in zip(names, zip(*rows, strict=True), strict=True)})

        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[at : at + TEXTS_AT_ONCE]
                rows: list[tuple] = []
                for doc_id, own in zip(part["doc_id"], tokens.ids([t or "" for t in part["text"]]), strict=True):
                    ids = np.append(own, np.uint32(end_id)).astype("<u4")
                    rows += bins.add(None if pd.isna(doc_id) else int(doc_id), ids)
                if rows:
                    yield frame(rows)
        if rows := bins.close():
            yield frame(rows)

    # ids travel as text: pandas would turn a column with nulls into doubles and lose digits
    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInPandas(packed, PIECES)
