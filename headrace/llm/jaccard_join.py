"""Exact n-gram Jaccard join with skipping by set relations, and its groups.

Documents are sets of word shingles; two link at a Jaccard similarity of at least ``PERCENT`` %.

* *Equal sets* are one node from the start.
* *Index.* Shingles have one global order: the frequent ones last, from rare to frequent, as counted over
  all shingles of all sets, and all others by fingerprint. Linked sets share a shingle among the first |x| - ceil(0.85 |x|) + 1 of each,
  so only those are indexed, each with its position. Lists are cut into blocks by size class and by
  band of positions; a set only visits blocks whose sizes and positions leave room for the overlap
  that is needed, and skips all others.
* *Answers from similar sets.* First every set is compared with one leader of each list it stands
  in: the one of its size class with the fewest rarer shingles, so copies meet in what they share. Sets that hang together are then known to be one group, and no pair inside a group is looked
  at again: whole lists of one group are dropped, and of the other lists, the sets outside the
  list's largest group visit the rest. Only groups are asked for, so no answer is lost.

Pairs are checked on the whole sets, after a bound from sets' parities that no linked pair fails. No size or frequency limits what is compared; the bound on how
many frequent shingles are told apart only concerns the order, any of which is right.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm.common import small_side, stored, text_key
from headrace.llm.components import components
from headrace.llm.shingles import WORDS, mixed, shingle_sets

PERCENT = 85
FREQUENT = 1 << 16  # so many of the most frequent shingles are ordered by frequency
COUNTED = 1 << 21  # shingles counted together by a worker, 16 MB
BANDS = 4
BITS = 4096
_SUM = np.uint64(0xC2B2AE3D27D4EB4F)


def set_print(shingles: np.ndarray) -> int:
    """One fingerprint for a whole set."""
    total = mixed(shingles + _SUM).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([total], np.uint64)).astype(np.int64)[0])


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _needed(percent: int) -> str:
    """SQL for the smallest overlap of linked sets of sizes x.size and y.size."""
    return f"ceil({percent} * (x.size + y.size) / {100 + percent}D - 1e-9)"


def _repeated(sets: list[np.ndarray], ids: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of two or more different ones of the sets given, and of how many."""
    one_each = {i: s for i, s in zip(ids, sets, strict=True) if i is not None}
    if len(one_each) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tokens = np.sort(np.concatenate(list(one_each.values())))
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    times = np.diff(np.append(first, len(tokens)))
    return tokens[first[times > 1]].view(np.int64), times[times > 1]


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, key, size, set_id, tokens, times): set_id is null for an empty set.

    Workers count all shingles of about ``COUNTED`` at a time; one row of these has, as ``tokens`` and
    ``times``, those that occur in several of its sets. A shingle that is frequent in the table is so there too.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, sets, held = [], [], 0

        def counted() -> pd.DataFrame:
            ids = [set_print(s) if len(s) else None for s in sets]
            tokens, times = _repeated(sets, ids)
            none = [np.zeros(0, np.int64)] * (len(sets) - 1)
            some = pd.concat(rows, ignore_index=True)
            return pd.DataFrame(
                {
                    "doc_id": some["doc_id"].to_numpy(),
                    "key": some["key"].to_numpy(),
                    "size": [len(s) for s in sets],
                    "set_id": pd.array(ids, dtype="Int64"),
                    "tokens": [tokens, *none],
                    "times": [times, *none],
                }
            )

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                rows.append(part[["doc_id", "key"]])
                sets += shingle_sets(list(part["text"]), words)
                held += sum(map(len, sets[-len(part) :]))
                if held >= COUNTED:
                    yield counted()
                    rows, sets, held = [], [], 0
        if rows:
            yield counted()

    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    out = plain.mapInPandas(
        read, "doc_id string, key bigint, size bigint, set_id bigint, tokens array<bigint>, times array<bigint>"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _postings(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """Index entries (token, set_id, size, pos, common) of all sets; ``frequent`` is ordered rarest first.

    A task gives each set once, however many copies it reads. ``common`` tokens are those of ``frequent``.
    """
    known = np.sort(frequent)
    rank = np.argsort(frequent, kind="stable")  # of known[i], its place in ``frequent``

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            tokens, ids, sizes, places, common = [], [], [], [], []
            texts = list(batch["text"])
            for s in (s for at in range(0, len(texts), 256) for s in shingle_sets(texts[at : at + 256], words)):
                own = set_print(s) if len(s) else None
                if own is None or own in seen:
                    continue
                seen.add(own)
                late = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    late = np.where(known[at] == s, rank[at] + 1, 0)
                    if late.any():
                        order = np.lexsort((s, late))
                        s, late = s[order], late[order]
                n = prefix_length(len(s), percent)
                tokens.append(s[:n])
                common.append(late[:n] > 0)
                ids.append(np.full(n, own, np.int64))
                sizes.append(np.full(n, len(s), np.int32))
                places.append(np.arange(n, dtype=np.int32))
            if tokens:
                yield pd.DataFrame(
                    {
                        "token": np.concatenate(tokens).view(np.int64),
                        "set_id": np.concatenate(ids),
                        "size": np.concatenate(sizes),
                        "pos": np.concatenate(places),
                        "common": np.concatenate(common),
                    }
                )

    return docs.select("text").mapInPandas(read, "token bigint, set_id bigint, size int, pos int, common boolean")


def parities(shingles: np.ndarray) -> np.ndarray:
    """``BITS`` bits: whether an odd number of shingles falls on each. Differing bits are differing shingles."""
    odd = np.bincount((shingles >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _read_again(docs: DataFrame, chosen: DataFrame, words: int, column: str, value) -> DataFrame:
    """(set_id, column): ``value`` of each chosen document's set.

    A row that repeats such a document gives its set again; links are made distinct later.
    """
    side = small_side(chosen, 48)
    texts = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text").join(
        side, F.col("doc_id").eqNullSafe(F.col("chosen")) & (F.col("key") == F.col("chosen_key"))
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                sets = shingle_sets(list(part["text"]), words)
                yield pd.DataFrame({"set_id": part["set_id"], column: [value(s) for s in sets]})

    return texts.select("set_id", "text").mapInPandas(read, f"set_id bigint, {column} array<bigint>")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()


def _linked(pairs: DataFrame, docs: DataFrame, base: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are similar enough.

    Parities come first: half of what sizes and differing bits leave is the most two sets can share,
    so pairs short of the overlap needed go without their sets being moved.
    """
    pairs = stored(pairs, "pairs")
    chosen = stored(
        base.join(_nodes(pairs), "set_id", "left_semi")
        .groupBy("set_id", "size")
        .agg(F.min(F.struct("doc_id", "key")).alias("d"))
        .select("set_id", "size", F.col("d.doc_id").alias("chosen"), F.col("d.key").alias("chosen_key")),
        "chosen-documents",
    )
    bits = stored(
        _read_again(docs, chosen, words, "bits", parities).join(chosen.select("set_id", "size"), "set_id"), "parities"
    )
    a = bits.select(F.col("set_id").alias("a"), F.col("bits").alias("p"), F.col("size").alias("m"))
    b = bits.select(F.col("set_id").alias("b"), F.col("bits").alias("q"), F.col("size").alias("n"))
    apart = F.aggregate(F.zip_with("p", "q", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    most = F.floor((F.col("m") + F.col("n") - apart) / 2)
    near = stored(
        pairs.join(a, "a").join(b, "b").where((100 + percent) * most >= percent * (F.col("m") + F.col("n"))).select("a", "b").distinct(),
        "near-pairs",
    )
    left = stored(chosen.join(_nodes(near), "set_id", "left_semi"), "near-documents")
    sets = stored(_read_again(docs, left, words, "shingles", lambda s: s.view(np.int64)), "whole-sets")
    a = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = 100 * both >= percent * (F.size("x") + F.size("y") - both)
    return stored(near.join(a, "a").join(b, "b").where(alike).select("a", "b").distinct(), "links")


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, key, n_shingles, component_id, group_id.

    ``component_id`` is the smallest doc_id that links lead to, the document's own included. Null and
    empty texts, and texts of white space, have no shingles and stand alone. Repeated rows are each
    returned; a null id takes part but names a group only if no other id is in it. An empty table
    gives no rows; other columns are ignored. ``key`` tells texts with one id apart; ``group_id``, null
    without shingles, tells groups apart whose ids are null or repeat.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    base = stored(_sets(docs, words), "sets")
    one_each = base.where("set_id is not null")

    counts = base.select(F.explode(F.arrays_zip("tokens", "times")).alias("c")).groupBy(F.col("c.tokens").alias("token")).agg(F.sum("c.times").alias("n"))
    top = counts.where("n > 16").orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    frequent = np.array([r["token"] for r in reversed(top)], np.int64).view(np.uint64)
    width = math.log(100 / (percent - 1))
    index = stored(_postings(docs, frequent, words, percent), "index")
    # Lists of one set link nothing. Common shingles are in several sets, as they were counted there; any other
    # list is short against the table, as the frequent ones are among the common, so it may meet in one task.
    alone = Window.partitionBy("token")
    rare = index.where("not common").drop("common").select("*", F.min("set_id").over(alone).alias("least"), F.max("set_id").over(alone).alias("most"))

    def blocks(entries: DataFrame) -> DataFrame:
        return entries.withColumn("class", F.floor(F.log(F.col("size")) / width).cast("int")).withColumn(
            "band", (F.col("pos") * BANDS / (F.col("size") * (1 - percent / 100) + 1)).cast("int")
        )

    # the set that has least before the shingle: of similar sets, the one nearest to what they share
    leader = F.min(F.struct("pos", "set_id", "size"))
    rare = blocks(rare.where("least < most").drop("least", "most").distinct())  # these lie by token already
    rare = rare.withColumn("leader", leader.over(Window.partitionBy("token", "class")))
    common = blocks(index.where("common").drop("common").distinct())
    index = stored(rare.unionByName(common, allowMissingColumns=True), "shared-index")

    needed = _needed(percent)
    fits = f"x.size - x.pos >= {needed} and y.size - y.pos >= {needed}"
    led = index.where("leader is not null").select(F.struct("set_id", "size", "pos").alias("x"), F.col("leader").alias("y"))
    common = index.where("leader is null").drop("leader")
    leaders = common.groupBy("token", "class").agg(leader.alias("y")).select("token", "class", "y.*")
    pair = F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")
    first = (
        common.alias("x")
        .join(leaders.alias("y"), F.expr("x.token = y.token and x.class = y.class and y.set_id <> x.set_id and " + fits))
        .select(*pair)
        .unionByName(led.where("y.set_id <> x.set_id and " + fits).select(*pair))
        .distinct()
    )
    links = _linked(first, docs, base, words, percent)
    labels = stored(components(links), "labels")

    known = index.drop("leader").join(small_side(labels.withColumnRenamed("node", "set_id"), 48), "set_id", "left").withColumn(
        "label", F.coalesce("label", "set_id")
    )
    known = stored(known, "labelled-index")
    ends = {"low_class": F.min, "high_class": F.max, "low_band": F.min, "high_band": F.max}
    by_label = known.groupBy("token", "label").agg(
        F.count("*").alias("n"), *(end(name.partition("_")[2]).alias(name) for name, end in ends.items())
    )
    mixed_lists = (
        by_label.groupBy("token")
        .agg(
            F.count("*").alias("labels"),
            F.max(F.struct("n", "label"))["label"].alias("main"),
            *(end(name).alias(name) for name, end in ends.items()),
        )
        .where("labels > 1")
    )
    some = stored(known.join(mixed_lists.drop("labels"), "token"), "mixed-lists")
    # the farthest position of a partner of class c: its size less the overlap that is needed
    largest = F.exp((F.col("block.class") + 1) * width)
    least = F.exp(F.col("block.class") * width)
    room = (largest - (F.col("size") + least) * percent / (100 + percent)) / (least * (1 - percent / 100) + 1)
    visits = (
        some.where("label <> main")
        .withColumn(
            "block",
            F.explode(
                F.expr(
                    f"flatten(transform(array(class - 1, class, class + 1), c -> "
                    f"transform(sequence(0, {BANDS}), p -> struct(c as class, p as band))))"
                )
            ),
        )
        .where(F.col("block.band") <= F.floor(F.greatest(room, F.lit(0.0)) * BANDS) + 1)
        # a list has no blocks beyond its smallest and largest class and band
        .where("block.class between low_class and high_class and block.band between low_band and high_band")
        .select("token", "block.*", "set_id", "size", "pos", "label")
    )
    second = (
        visits.alias("x")
        .join(
            some.alias("y"),
            F.expr(
                "x.token = y.token and x.class = y.class and x.band = y.band and x.label <> y.label"
                " and (y.label = y.main or x.set_id < y.set_id)"
                f" and {fits}"
            ),
        )
        .select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b"))
        .distinct()
    )
    more = _linked(second, docs, base, words, percent)
    # links between groups, not between sets, are what is left to join
    named = labels.select(F.col("node"), "label")
    between = (
        more.join(named.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
        .join(named.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    )
    merged = stored(components(between), "merged")
    final = (
        one_each.select("set_id")
        .distinct()
        .join(named.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("label", F.coalesce("label", "set_id"))
        .join(merged.select(F.col("node").alias("label"), F.col("label").alias("joined")), "label", "left")
        .select("set_id", F.coalesce("joined", "label").alias("group"))
    )
    smallest = one_each.select("set_id", "doc_id").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    named_groups = stored(smallest.join(final, "set_id"), "group-members")
    firsts = named_groups.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    by_set = named_groups.join(firsts, "group").select("set_id", "component_id", F.col("group").alias("group_id"))
    return base.join(by_set, "set_id", "left").select(
        "doc_id",
        "key",
        F.col("size").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "group_id",
    )
