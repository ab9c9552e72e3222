"""Removal of repeated byte strings by sorting suffixes.

A byte is removed if it lies in a string of ``WINDOW`` bytes that also starts in a document with a
smaller id. Three passes over the texts:

1. *Anchors.* Every window has an anchor, a gram of it chosen by content. Workers pack the prints of
   their texts' anchors by print; where a print, with the bytes next to it on one side, occurs in
   two documents, its windows may repeat. All others are done.
2. *Sort.* The contexts of those anchors, just the bytes of the windows they stand for, are brought
   together by print, so equal windows meet. Each part's distinct contexts are one text whose
   suffixes are put in order by external induced sorting; neighbours that agree on a window's length
   are one string, and its smallest document is known. Bytes of copies are merged before the shuffle
   and again before the sort; each place of a copy stays an entry of the part.
3. *Removal.* Windows that a smaller document holds are marked in their texts.

*Hot anchors*, which occur more than ``HOT`` times as far as an eighth of the rows tells, take no part
in this. Their contexts and windows are rows: workers merge equal contexts of a chunk, and Spark sums up
the smallest and the largest id of each context, then of each window, on the map side first. Places stay
with their chunk, to which what their contexts were found to repeat is joined, so no task holds all
places of an anchor. Either way gives the same windows: hotness only decides how they meet.

Parts are as many as the bytes ask for; a task takes several, one after the other, and writes one file for
all of them. Texts are shuffled once, by row; both joins use it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.llm.anchors import GRAM, anchors
from headrace.llm.common import stored
from headrace.llm.induced_sort import equal_windows

WINDOW = 50
PART_BYTES = 2 << 20  # bytes of text for each part of the prints
CHUNK_BYTES = 8 << 20  # bytes of text packed together by a worker
PLACES_AT_ONCE = 20_000
HOT = 50_000  # occurrences from which an anchor is hot: about 5 MB of contexts in one part
SAMPLED = 8  # one row in so many is counted for that
SALTS = 16
NO_ID = -(2**63)  # stands for a null id: smaller than all others


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Rows and their texts' bytes, about ``CHUNK_BYTES`` at a time."""
    for batch in batches:
        raws = [np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8) for t in batch["text"]]
        ends = np.cumsum([len(r) for r in raws])
        cut = np.searchsorted(ends // CHUNK_BYTES, np.arange(ends[-1] // CHUNK_BYTES + 2)) if len(ends) else [0]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b > a:
                yield batch.iloc[a:b], raws[a:b]


def _runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """First places and ends of the runs of equal values."""
    bounds = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(bounds[:-1], bounds[1:], strict=True)) if len(values) else []


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    for a, b in _runs_of(part[order]):
        yield int(part[order[a]]), order[a:b]


def _part_of(prints: np.ndarray, parts: int) -> np.ndarray:
    """Evenly: anchors have small prints, so the upper bits as they are would favour the first parts."""
    mixed = (prints ^ (prints >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _packed_runs(owner: np.ndarray, place: np.ndarray) -> pd.DataFrame:
    """(rid, runs): first and last of the consecutive windows of each row."""
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    breaks = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + np.uint32(1))
    at = _runs_of(np.append(0, np.cumsum(breaks)) if len(owner) else owner)
    begin, end = np.array([a for a, _ in at], np.int64), np.array([b - 1 for _, b in at], np.int64)
    runs = np.stack([place[begin], place[end]], axis=1).astype(np.uint32)
    own = owner[begin]
    docs = _runs_of(own)
    return pd.DataFrame(
        {
            "rid": own[[a for a, _ in docs]] if docs else np.zeros(0, np.int64),
            "runs": [runs[a:b].tobytes() for a, b in docs],
        }
    )


def _hot_prints(docs: DataFrame, least: int, window: int) -> np.ndarray:
    """Prints of anchors with ``least`` occurrences or more among the rows given, sorted."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, raws in _chunks(batches):
            prints, counts = np.unique(anchors(raws, window).prints, return_counts=True)
            several = counts > 1 if least > 1 else counts > 0  # a hot one occurs twice in some chunk
            yield pd.DataFrame({"print": prints[several].view(np.int64), "n": counts[several]})

    counted = docs.select("rid", "text").mapInPandas(read, "print bigint, n bigint").groupBy("print").agg(F.sum("n").alias("n"))
    found = [r["print"] for r in counted.where(F.col("n") >= least).collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def _among(prints: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(prints), bool)
    return hot[np.minimum(np.searchsorted(hot, prints), len(hot) - 1)] == prints


def _hot_runs(docs: DataFrame, hot: np.ndarray, window: int) -> DataFrame:
    """(rid, runs) for the windows of hot anchors, see ``_marked``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, raws in _chunks(batches):
            owner, prints, _, first, last, _ = anchors(raws, window)
            at = np.flatnonzero(_among(prints, hot))
            rids, ids = rows["rid"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
            known: dict[bytes, int] = {}
            which = np.array(
                [known.setdefault(raws[owner[j]][first[j] : last[j] + window].tobytes(), len(known)) for j in at], np.int64
            )
            order = np.argsort(which, kind="stable")
            at, texts = at[order], list(known)
            out = []
            for context, (a, b) in zip(texts, _runs_of(which[order]), strict=True):
                here = at[a:b]
                own = ids[owner[here]]
                out.append(
                    {
                        "chunk": int(rids[0]),
                        "context": context,
                        "low": int(own.min()),
                        "high": int(own.max()),
                        "rids": rids[owner[here]].tobytes(),
                        "ids": own.tobytes(),
                        "first": first[here].astype(np.uint32).tobytes(),
                    }
                )
            if out:
                yield pd.DataFrame(out)

    def mark(chunk: pd.DataFrame) -> pd.DataFrame:
        owners, places, held, out = [], [], 0, []
        for row in chunk.itertuples(index=False):
            found = np.frombuffer(row.found, ">i8").reshape(-1, 2)
            place, low = found[:, 0].astype(np.uint32), found[:, 1].astype(np.int64)
            rids, ids, first = (np.frombuffer(x, t) for x, t in ((row.rids, np.int64), (row.ids, np.int64), (row.first, np.uint32)))
            for a in range(0, len(ids), PLACES_AT_ONCE):
                own, inside = np.nonzero(low[None, :] < ids[a : a + PLACES_AT_ONCE, None])
                owners.append(rids[a : a + PLACES_AT_ONCE][own])
                places.append(first[a : a + PLACES_AT_ONCE][own] + place[inside])
                held += len(own)
                if held > 50 * PLACES_AT_ONCE:
                    out.append(_packed_runs(np.concatenate(owners), np.concatenate(places)))
                    owners, places, held = [], [], 0
        if held or not out:
            out.append(_packed_runs(np.concatenate(owners), np.concatenate(places)))
        return pd.concat(out)

    entries = stored(
        docs.select("rid", "id", "text").mapInPandas(
            read, "chunk bigint, context binary, low bigint, high bigint, rids binary, ids binary, first binary"
        ),
        "hot-contexts",
    )
    contexts = entries.groupBy("context").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    windows = stored(
        contexts.select(F.posexplode(F.expr(f"transform(sequence(1, length(context) - {window - 1}), i -> substring(context, i, {window}))")).alias("at", "window"), "context", "low", "high"),
        "hot-windows",
    )
    least = windows.groupBy("window").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most")
    least = stored(least.select("window", "least"), "repeated-windows")
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    packed = F.expr("to_binary(concat(lpad(hex(cast(at as bigint)), 16, '0'), lpad(hex(least), 16, '0')), 'hex')")
    found = (
        windows.withColumn("salt", F.pmod(F.xxhash64("context"), F.lit(SALTS)).cast("int"))
        .join(salted, ["window", "salt"])
        .where("least < high")
        .groupBy("context")
        .agg(F.sort_array(F.collect_list(packed)).alias("found"))
        .select(F.col("context"), F.expr("aggregate(found, cast('' as binary), (x, y) -> concat(x, y))").alias("found"))
    )
    asked = entries.join(stored(found, "hot-found"), "context").select("chunk", "rids", "ids", "first", "found")
    return asked.groupBy("chunk").applyInPandas(mark, "rid bigint, runs binary")


def _entries(docs: DataFrame, parts: int, window: int, hot: np.ndarray) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, raws in _chunks(batches):
            owner, prints, place, _, _, sides = anchors(raws, window)
            if len(hot):
                cold = ~_among(prints, hot)
                owner, prints, place, sides = owner[cold], prints[cold], place[cold], sides[cold]
            rids = rows["rid"].to_numpy(np.int64)
            out = []
            for part, at in _by_part(_part_of(prints, parts)):
                docs_here, counts = np.unique(owner[at], return_counts=True)
                steps = np.diff(place[at], prepend=0).astype(np.int32)
                out.append(
                    {
                        "part": part,
                        "rids": rids[docs_here].tobytes(),
                        "counts": counts.astype(np.uint32).tobytes(),
                        "prints": np.ascontiguousarray(prints[at].view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(),
                        "sides": sides[at].tobytes(),
                        "places": np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(),
                    }
                )
            if out:
                yield pd.DataFrame(out)

    return docs.select("rid", "text").mapInPandas(
        read, "part bigint, rids binary, counts binary, prints binary, sides binary, places binary"
    )


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """(rid, places): anchors whose print and one side occur in another row too.

    Whether that is a document with another id is seen when the windows themselves are compared.
    """
    kept = {"rids": [], "prints": [], "sides": [], "places": []}
    for row in rows.itertuples(index=False):
        counts = np.frombuffer(row.counts, np.uint32)
        kept["rids"].append(np.repeat(np.frombuffer(row.rids, np.int64), counts))
        five = np.frombuffer(row.prints, np.uint8).reshape(-1, 5)
        whole = np.zeros((len(five), 8), np.uint8)
        whole[:, :5] = five
        kept["prints"].append(whole.view(np.uint64).ravel())
        kept["sides"].append(np.frombuffer(row.sides, np.uint16).reshape(-1, 2))
        steps = np.ascontiguousarray(np.frombuffer(row.places, np.uint8).reshape(4, -1).T).view(np.int32).ravel()
        kept["places"].append(np.cumsum(steps, dtype=np.int64))
    rids, prints, places = (np.concatenate(kept[k]) for k in ("rids", "prints", "places"))
    sides = np.concatenate(kept["sides"])
    repeated = np.zeros(len(rids), bool)
    for side in (0, 1):
        key = prints << np.uint64(16) | sides[:, side].astype(np.uint64)
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        own = rids[order]
        several = np.minimum.reduceat(own, starts) < np.maximum.reduceat(own, starts)
        repeated[order] |= np.repeat(several, np.diff(np.append(starts, len(own))))
    at = np.flatnonzero(repeated)
    at = at[np.argsort(rids[at], kind="stable")]
    runs = _runs_of(rids[at])
    return pd.DataFrame(
        {
            "rid": rids[at[[a for a, _ in runs]]] if runs else np.zeros(0, np.int64),
            "places": [places[at[a:b]].astype(np.uint32).tobytes() for a, b in runs],
        }
    )


def _contexts(docs: DataFrame, parts: int, window: int) -> DataFrame:
    """Packed contexts of the anchors in ``places``: distinct bytes once, and where each occurs."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, raws in _chunks(batches):
            asked = [i for i, packed in enumerate(rows["places"]) if packed is not None]
            if not asked:
                continue
            rows, raws = rows.iloc[asked], [raws[i] for i in asked]
            owner, prints, place, first, last, _ = anchors(raws, window)
            wanted = [np.concatenate([np.frombuffer(p, np.uint32) for p in packed]).astype(np.int64) for packed in rows["places"]]
            # one number for text and place
            key = np.concatenate([w + (i << 32) for i, w in enumerate(wanted)])
            at = np.flatnonzero(np.isin(place + (owner << 32), key))
            prints, owner, first, last = prints[at], owner[at], first[at], last[at]
            rids, ids = rows["rid"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
            out = []
            for part, at in _by_part(_part_of(prints, parts)):
                known: dict[bytes, int] = {}
                which = [
                    known.setdefault(raws[owner[j]][first[j] : last[j] + window].tobytes(), len(known)) for j in at
                ]
                out.append(
                    {
                        "part": part,
                        "texts": b"".join(known),
                        "sizes": np.fromiter(map(len, known), np.uint32, len(known)).tobytes(),
                        "which": np.array(which, np.uint32).tobytes(),
                        "rids": rids[owner[at]].tobytes(),
                        "ids": ids[owner[at]].tobytes(),
                        "first": first[at].astype(np.uint32).tobytes(),
                    }
                )
            if out:
                yield pd.DataFrame(out)

    return docs.select("rid", "id", "text", "places").mapInPandas(
        read, "part bigint, texts binary, sizes binary, which binary, rids binary, ids binary, first binary"
    )


def _marked(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """(rid, runs): first and last windows that a document with a smaller id holds as well."""
    known: dict[bytes, int] = {}
    which, rids, ids, first = [], [], [], []
    for row in rows.itertuples(index=False):
        sizes = np.frombuffer(row.sizes, np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        here = np.array(
            [known.setdefault(row.texts[e - s : e], len(known)) for s, e in zip(sizes, ends, strict=True)], np.int64
        )
        which.append(here[np.frombuffer(row.which, np.uint32)])
        rids.append(np.frombuffer(row.rids, np.int64))
        ids.append(np.frombuffer(row.ids, np.int64))
        first.append(np.frombuffer(row.first, np.uint32).astype(np.int64))
    which, rids, ids, first = map(np.concatenate, (which, rids, ids, first))
    sizes = np.fromiter(map(len, known), np.int64, len(known))
    text = np.frombuffer(b"".join(known), np.uint8)
    smallest = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(smallest, which, ids)

    # windows of all distinct contexts, and of each the smallest document that holds its bytes
    windows = sizes - window + 1
    offset = np.cumsum(windows) - windows  # of a context's first window
    inside = np.arange(windows.sum()) - np.repeat(offset, windows)
    inside += np.repeat(np.cumsum(sizes) - sizes, windows)
    string = equal_windows(text, inside, window)
    del inside, known
    least = np.full(int(string.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, string, np.repeat(smallest, windows))
    least = least[string]

    # back to every place a context occurs at, some at a time: a hot anchor has very many
    owners, places = [], []
    for at in range(0, len(which), PLACES_AT_ONCE):
        here = slice(at, at + PLACES_AT_ONCE)
        n = windows[which[here]]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        marked = least[np.repeat(offset[which[here]], n) + inside] < np.repeat(ids[here], n)
        owners.append(np.repeat(rids[here], n)[marked])
        places.append((np.repeat(first[here], n) + inside)[marked].astype(np.uint32))
    owner, place = np.concatenate(owners), np.concatenate(places)
    del string, least, which, text
    return _packed_runs(owner, place)


def covered(n: int, packed: list[bytes] | None, window: int) -> np.ndarray:
    """Which of ``n`` bytes lie in a marked window."""
    delta = np.zeros(n + 1, np.int32)
    if packed is not None and len(packed):
        runs = np.concatenate([np.frombuffer(p, np.uint32).reshape(-1, 2) for p in packed]).astype(np.int64)
        np.add.at(delta, runs[:, 0], 1)
        np.add.at(delta, runs[:, 1] + window, -1)
    return np.cumsum(delta[:n]) > 0


def row_print() -> Column:
    """Fingerprint of a row's doc_id and text; nulls count as values of their own."""
    return F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull())


def deduplicate(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """One row per document: rid, doc_id, kept (the remaining bytes), text, n_bytes, n_removed, n_spans.

    ``text`` is what remains without characters that a cut went through. Null texts count as empty
    and stay null; texts shorter than a window lose
    nothing. Rows with the same doc_id do not affect each other, so repeated rows get the same
    result; a null id counts as smaller than all others. ``rid`` is a fingerprint of id and text. An
    empty table gives no rows; other columns are ignored. doc_id must be an integer.
    ``window`` is at least three anchor grams long, less a byte. ``hot`` does not change the result.
    """
    if window < 3 * GRAM - 1:
        raise ValueError(f"windows must have at least {3 * GRAM - 1} bytes")
    spark = docs.sparkSession
    rows = docs.select(
        row_print().alias("rid"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col("text").cast("string").alias("text"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(tasks, -(-total // PART_BYTES))

    some = rows.where(F.pmod("rid", F.lit(SAMPLED)) == 0)
    prints = _hot_prints(some, max(hot // SAMPLED, 1), window)

    entries = _entries(rows, parts, window, prints).repartition(tasks, "part").groupBy("part")
    places = stored(entries.applyInPandas(_repeated, "rid bigint, places binary"), "anchor-places")
    places = places.groupBy("rid").agg(F.collect_set("places").alias("places"))

    by_row = rows.repartition(tasks, "rid")
    contexts = _contexts(by_row.join(places, "rid", "left"), parts, window).repartition(tasks, "part")
    runs = contexts.groupBy("part").applyInPandas(lambda part: _marked(part, window), "rid bigint, runs binary")
    if len(prints):
        runs = runs.unionByName(_hot_runs(rows, prints, window))
    runs = runs.groupBy("rid").agg(F.collect_set("runs").alias("runs"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk, raws in _chunks(batches):
            gone = [covered(len(raw), r, window) for raw, r in zip(raws, chunk["runs"], strict=True)]
            kept = [raw[~g].tobytes() for raw, g in zip(raws, gone, strict=True)]
            yield pd.DataFrame(
                {
                    "rid": chunk["rid"],
                    "id": chunk["id"],
                    "text": [None if t is None else k.decode("utf-8", "ignore") for t, k in zip(chunk["text"], kept, strict=True)],
                    "kept": kept,
                    "n_bytes": [len(raw) for raw in raws],
                    "n_removed": [int(g.sum()) for g in gone],
                    "n_spans": [int(np.count_nonzero(g[1:] & ~g[:-1]) + g[:1].sum()) for g in gone],
                }
            )

    return (
        by_row.join(runs, "rid", "left")
        .select("rid", "id", "text", "runs")
        .mapInPandas(
            cut,
            "rid bigint, id bigint, text string, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint",
        )
        .withColumn("doc_id", F.when(F.col("id") != NO_ID, F.col("id")))
        .drop("id")
    )
