"""Removal of repeated word windows by suffix automata of reference shards.

A word goes if a window of ``WINDOW`` words that covers it also starts anywhere else, in its own text or
another. Four passes:

1. *Anchors.* Every window has an anchor, the eight words in it with the smallest fingerprint, so equal
   windows have equal anchors at equal places. An anchor's place stands for a run of consecutive windows, its
   piece of the text; each window is in one piece. Where an anchor occurs once, its windows do too.
2. *Reference.* Equal pieces are counted on the map side. The distinct pieces of anchors that occur several
   times, a small part of the corpus, are the reference; their words are fetched once.
3. *Matching.* The reference is cut into shards of whole anchors, about ``SHARD_WORDS`` words each. A shard's
   suffix automaton counts how often each string occurs; the shard's pieces are streamed through it for their
   matching statistics, and windows that lie in a match are repeats. Equal windows meet in one shard,
   so no automaton needs to be sent to other texts: see the README for what became of the broadcast.
4. *Removal.* What was found goes back to the pieces' places, and from there to the texts.

*Anchors with many different pieces* (more than ``KINDS``) are split: windows that reach far to the left of the
anchor hold a longer string on that side, the others one on the right side, and those longer strings are the
anchors of the next level. Equal pieces merge again. After at most five levels an anchor is a whole window, of which
all pieces are equal; so no group grows with the data, and every window still meets its copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.llm.common import stored
from headrace.llm.shingles import mixed
from headrace.llm.suffix_automaton import SuffixAutomaton

WINDOW = 35
GRAM = 8
SHARD_WORDS = 1 << 15
KINDS = 256
CHUNK_BYTES = 4 << 20
_LONGEST = 1 << 12
_DRAW = np.random.Generator(np.random.PCG64(29))
_PLACES = _DRAW.integers(0, 2**63, _LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_AT = np.uint64(0x7FFFFFFF)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
ANCHORED = "rid bigint, start int, windows int, core int, key bigint, piece bigint"
PIECE = "key bigint, piece bigint, n bigint, windows int, core int, gram int, words binary"


def word_prints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of all texts, one after another, and the place after each text's last word."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(np.append(True, blank[:-1]) & ~blank)
    ends = np.flatnonzero(np.append(~blank[:-1] & blank[1:], False)) + 1
    bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    inside = np.arange(sizes.sum()) - np.repeat(first, sizes)
    letters = (raw[~blank].astype(np.uint64) + np.uint64(1)) * _PLACES[inside & (_LONGEST - 1)]
    prints = np.add.reduceat(letters, first, dtype=np.uint64)
    for i in np.flatnonzero(sizes > _LONGEST):
        word = raw[starts[i] : ends[i]].tobytes()
        prints[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return mixed(prints), bounds


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def _anchored(texts: list[bytes], rids: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """The pieces of texts laid end to end: per piece the columns of ``ANCHORED``."""
    words, bounds = word_prints(texts)
    n = len(words)
    if n < window:
        return {}
    grams, have = words, 1
    while have < gram:
        step = min(have, gram - have)
        grams = mixed(grams[:-step] * _ODD + grams[step:])
        have += step
    # the place breaks ties, so the smallest value is unique in its window and names its place
    low = _lowest((grams & ~_AT) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds, prepend=0))
    inside = owner[: len(low)] == owner[window - 1 :]
    new = inside & np.append(True, (low[1:] != low[:-1]) | ~inside[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return {}
    own = owner[first]
    last = np.minimum(np.append(first[1:], n) - 1, bounds[own] - window)
    core = (low[first] & _AT).astype(np.int64)
    # a sum of words times powers, shifted back to the piece's own start
    powers = np.cumprod(np.append(np.uint64(1), np.full(n, _ODD)))
    backs = np.cumprod(np.append(np.uint64(1), np.full(n, _BACK)))
    sums = np.append(np.uint64(0), np.cumsum(words * powers[:-1]))
    pieces = mixed((sums[last + window] - sums[first]) * backs[first] + (last - first).astype(np.uint64))
    begin = np.append(0, bounds)[own]
    return {
        "rid": rids[own],
        "start": (first - begin).astype(np.int32),
        "windows": (last - first + 1).astype(np.int32),
        "core": (core - first).astype(np.int32),
        "key": grams[core].view(np.int64),
        "piece": pieces.view(np.int64),
    }


def _anchors(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rids, texts = batch.column("rid").to_numpy(), batch.column("text").to_pylist()
        cuts = np.cumsum([len(t) for t in texts]) // CHUNK_BYTES
        for cut in np.unique(cuts):
            a, b = np.searchsorted(cuts, [cut, cut + 1])
            found = _anchored(texts[a:b], rids[a:b], window, gram)
            if found:
                yield pa.RecordBatch.from_pydict(found)


def _fetched(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pd.DataFrame]:
    """The words of the pieces wanted of each text."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            words = text.split()
            for w in wanted:
                piece = b" ".join(words[w["start"] : w["start"] + w["windows"] + window - 1])
                out.append((w["key"], w["piece"], w["n"], w["windows"], w["core"], gram, piece))
        columns = [pa.array(c) for c in zip(*out, strict=True)]
        names = [c.split()[0] for c in PIECE.split(", ")]
        if out:
            types = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names)


def _repeats(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """(key, piece, bits): the windows of each of a shard's pieces that occur twice or more in it."""
    automaton = SuffixAutomaton()
    texts = [text.split(b" ") for text in rows["words"]]
    for words, n in zip(texts, rows["n"].tolist(), strict=True):
        automaton.add(words, n)
    automaton.count()
    bits = []
    for words in texts:
        statistics = automaton.matching(words)
        bits.append(sum(1 << j for j, length in enumerate(statistics[window - 1 :]) if length >= window))
    return pd.DataFrame({"key": rows["key"].to_numpy(), "piece": rows["piece"].to_numpy(), "bits": np.array(bits, np.int64)})


def _matched(batches: Iterator[pd.DataFrame], window: int, shard_words: int) -> Iterator[pd.DataFrame]:
    """Pieces in the order of their anchors, a shard at a time; an anchor is never parted."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += int((batch["windows"] + window - 1).sum())
        if n < shard_words:
            continue
        rows = pd.concat(waiting, ignore_index=True)
        keys = rows["key"].to_numpy()
        cuts = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1)  # first rows of anchors
        before = np.cumsum((rows["windows"] + window - 1).to_numpy())
        start = 0
        for cut in cuts[1:].tolist():
            if before[cut - 1] - (before[start - 1] if start else 0) >= shard_words:
                yield _repeats(rows.iloc[start:cut], window)
                start = cut
        waiting = [rows.iloc[start:]]
        n = int(before[-1] - (before[start - 1] if start else 0))
    if n:
        yield _repeats(pd.concat(waiting, ignore_index=True), window)


def _print(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


def _split(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Each piece as the windows that reach far to the left of its anchor, and those that do not."""
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            words = row.words.split(b" ")
            free = window - row.gram  # words of a window besides the anchor
            left = (free + 1) // 2
            right = free - left + 1
            for a, b, core, gram in (
                (0, min(row.windows - 1, row.core - left), row.core - left, row.gram + left),
                (max(0, row.core - left + 1), row.windows - 1, row.core, row.gram + right),
            ):
                if a <= b:
                    piece = words[a : b + window]
                    key = _print([b"%d" % gram, *words[core : core + gram]])
                    out.append((row.root_key, row.root_piece, row.shift + a, key, _print(piece), row.n, b - a + 1, core - a, gram, b" ".join(piece)))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _BRANCH.split(", ")])


_BRANCH = f"root_key bigint, root_piece bigint, shift int, {PIECE}"


def _windows_found(pieces: DataFrame, window: int, kinds: int, shard_words: int) -> DataFrame:
    """(key, piece, bits) for the pieces given (``PIECE``, each once), by level."""
    branches = pieces.select(F.col("key").alias("root_key"), F.col("piece").alias("root_piece"), F.lit(0).alias("shift"), "*")
    found, level = None, 0
    while True:
        distinct = pieces
        if level:
            same = branches.groupBy("key", "piece").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("windows", "core", "gram", "words")))
            distinct = stored(same, f"substring-pieces-{level}")
        many = distinct.groupBy("key").agg(F.count("*").alias("kinds")).where(F.col("kinds") > kinds).select("key")
        many = stored(many, f"substring-split-{level}")
        split = not many.isEmpty()
        few = distinct.join(many, "key", "left_anti") if split else distinct
        shards = few.select("key", "piece", "n", "windows", "words").repartition("key").sortWithinPartitions("key")
        bits = shards.mapInPandas(partial(_matched, window=window, shard_words=shard_words), "key bigint, piece bigint, bits bigint")
        bits = stored(bits.where("bits <> 0"), f"substring-bits-{level}")
        here = bits
        if level:
            here = branches.select("root_key", "root_piece", "shift", "key", "piece").join(bits, ["key", "piece"])
            here = here.select(F.col("root_key").alias("key"), F.col("root_piece").alias("piece"), F.expr("shiftleft(bits, shift)").alias("bits"))
        found = here if found is None else found.unionByName(here)
        if not split:
            break
        hot = branches.join(many, "key", "left_semi").select([c.split()[0] for c in _BRANCH.split(", ")])
        branches = stored(hot.mapInPandas(partial(_split, window=window), _BRANCH), f"substring-branches-{level}")
        level += 1
    return found.groupBy("key", "piece").agg(F.bit_or("bits").alias("bits")) if level else found


def _without(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Texts without the words of the windows found."""
    for batch in batches:
        lists = batch.column("found")
        inner = lists.flatten()
        start, bits = (inner.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "bits"))
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        ends = np.cumsum(sizes)
        spread = np.arange(window)
        n_words, removed, spans, kept = [], [], [], []
        for text, a, b in zip(batch.column("text").to_pylist(), ends - sizes, ends, strict=True):
            words = text.split()
            change = np.zeros(len(words) + 1, np.int64)
            if b > a:
                piece, j = np.nonzero((bits[a:b, None] >> spread) & 1)
                first = start[a:b][piece] + j
                change = np.bincount(first, minlength=len(words) + 1) - np.bincount(first + window, minlength=len(words) + 1)
            covered = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
            n_words.append(len(words))
            removed.append(int(covered.sum()))
            spans.append([{"start": s, "stop": e} for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
            if len(edges):
                words = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_words", "n_removed", "spans", "kept"],
        )


def deduplicate_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, kinds: int = KINDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (removed runs of words: start, stop), kept (the rest, joined by blanks).

    Words are parted by ASCII white space and kept as they are. Null and empty texts have no words; a text of
    fewer words than a window loses none. Rows are told apart by where they are, not by doc_id: repeated rows
    and copies under one id, or none, are different texts and all lose what they share. Windows are judged on the
    input. Other columns are ignored, an empty table gives no rows. ``window`` may be up to 60 words and ``gram`` less.
    Anchors and pieces are told apart by 64 bits each, words inside shards are compared in full.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    rows = stored(rows, "substring-texts")
    anchored = rows.select("rid", "text").mapInArrow(partial(_anchors, window=window, gram=gram), ANCHORED)
    anchored = stored(anchored, "substring-anchors")
    several = anchored.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    places = stored(anchored.join(stored(several, "substring-keys"), "key", "left_semi"), "substring-places")

    distinct = places.groupBy("key", "piece").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "start")).alias("at"), F.first("windows").alias("windows"), F.first("core").alias("core")
    )
    distinct = stored(distinct, "substring-distinct")
    alone = distinct.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1").select("key")
    # pieces that meet others; the rest are repeats of one piece, as are all that occur twice
    meeting = distinct.join(stored(alone, "substring-meeting"), "key", "left_semi")
    wanted = meeting.groupBy(F.col("at.rid").alias("rid")).agg(
        F.collect_list(F.struct("key", "piece", "n", F.col("at.start").alias("start"), "windows", "core")).alias("wanted")
    )
    pieces = rows.select("rid", "text").join(wanted, "rid").mapInArrow(partial(_fetched, window=window, gram=gram), PIECE)
    found = _windows_found(stored(pieces, "substring-pieces"), window, kinds, shard_words)
    whole = distinct.where("n > 1").select("key", "piece", F.expr("shiftleft(1L, windows) - 1").alias("bits"))
    once = distinct.where("n = 1").select("key", "piece").join(found, ["key", "piece"])
    known = stored(whole.unionByName(once.select("key", "piece", "bits")), "substring-known")

    marks = places.join(known, ["key", "piece"]).groupBy("rid").agg(F.collect_list(F.struct("start", "bits")).alias("found"))
    cut = rows.select("rid", "doc_id", "text").join(marks, "rid", "left")
    span = T.ArrayType(T.StructType().add("start", T.LongType()).add("stop", T.LongType()))
    schema = (
        T.StructType()
        .add(rows.schema["doc_id"])
        .add("n_words", T.LongType())
        .add("n_removed", T.LongType())
        .add("spans", span)
        .add("kept", T.BinaryType())
    )
    return cut.mapInArrow(partial(_without, window=window), schema).withColumn("kept", F.col("kept").cast("string"))
