"""The prefix trie of conversations, found and summed up by peeling turns off the ends.

A node is a distinct sequence of first turns. Peeling starts at the deepest level: conversations that end
there are merged by their whole sequence; then each node loses its last turn and is grouped again, together
with the conversations that end one level higher. One grouping a level finds the nodes and sums up their
subtrees at the same time, as all that lies below is in the rows that come together. Rows carry the
fingerprints of what is left of their sequence, so a strip shortens a list and needs no join.

Turns get their places by ranges, and fingerprints of prefixes are running combinations of their turns' own,
so a conversation with a third of all turns is spread. Copies of one conversation merge on the map side.

*Long conversations.* Levels below ``BLOCK`` mostly hold few nodes each, and there may be thousands. What
lies below a node of that depth is peeled by one task, with the same step, if it has at most ``HELD`` turns
(counted); larger parts go on level by level like the rest, ``BLOCK`` levels of the sequence at a time.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm.common import bind, small_side, stored
from headrace.llm.places import PLACE, placed

SHARED = 4  # up to this many turns, less one, come from a block's first conversation
BLOCK_OF = 20
BLOCK = 16
HELD = 100_000
WORD = r"[^\\x20\\x09-\\x0D]+"
NODE = "a bigint, b bigint, depth bigint, conv bigint, n bigint, children bigint, leaves bigint, saved bigint, parent_a bigint, parent_b bigint"
_STEP = "struct(depth, a, b, words)"


def _shared_turns() -> Column:
    return F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED


def _name() -> Column:
    """A node's name, empty for the root, which has no fingerprint."""
    return F.concat_ws(",", "a", "b")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth from 1, x, y, words) as rebuilt, and all conversations (conv, turns).

    ``x`` and ``y`` are fingerprints of the turn's role and text. Turns with the same number are ordered
    by them; rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.xxhash64(role, text).alias("x"),
        F.xxhash64(F.lit("turn"), text, role).alias("y"),
        bind(text, lambda t: F.regexp_count(t, F.expr(f"'{WORD}'"))).cast("long").alias("words"),
    )
    turns = placed(turns, ["conv"], [F.col("turn"), F.col("x"), F.col("y")], "trie-turns")
    turns = stored(turns.select("conv", (F.col(PLACE) + 1).alias("at"), "x", "y", "words"), "trie-turns")
    convs = turns.groupBy("conv").agg(F.count("*").alias("n")).select(
        "conv", "n", _shared_turns().alias("h"), F.expr(f"conv - pmod(conv, {BLOCK_OF})").alias("base")
    )
    head = turns.where(f"pmod(conv, {BLOCK_OF}) = 0 AND at < {SHARED}")  # at most three turns of one in twenty
    firsts = head.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("at", "x", "y", "words"))).alias("head"))
    convs = convs.join(firsts, "base", "left").withColumn("head", F.coalesce("head", F.array().cast("array<struct<at:bigint,x:bigint,y:bigint,words:bigint>>")))
    convs = convs.withColumn("head", F.slice("head", 1, F.col("h").cast("int")))
    convs = stored(convs.withColumn("b", F.size("head").cast("long")), "trie-conversations")
    own = turns.where(f"at > {SHARED - 1}").select("conv", F.col("at").alias("depth"), "x", "y", "words")
    # Up to three turns of each own conversation may give way; those beyond move by a constant of it.
    early = turns.where(f"at < {SHARED}").join(convs.select("conv", "h", "b"), "conv").where("at > h")
    early = early.select("conv", F.expr("at - h + b").alias("depth"), "x", "y", "words")
    moved = convs.where("h <> b").select("conv", (F.col("h") - F.col("b")).alias("less"))
    own = own.join(moved, "conv", "left").withColumn("depth", F.expr("depth - coalesce(less, 0)")).drop("less")
    copied = convs.select("conv", F.explode("head").alias("t")).select("conv", F.col("t.at").alias("depth"), "t.x", "t.y", "t.words")
    all_convs = convs.select("conv", F.expr("b + greatest(n - h, 0)").alias("turns"))
    return copied.unionByName(early).unionByName(own), all_convs


def _prefixes(turns: DataFrame) -> DataFrame:
    """Turns (conv, depth, a, b, words) with the 128-bit fingerprint of the sequence up to each.

    It is the exclusive or of its turns' fingerprints, each mixed with its depth: ranges of a
    conversation are combined on their own and then together.
    """
    mixed = turns.select("conv", "depth", F.xxhash64("x", "depth", "y").alias("a"), F.xxhash64("depth", "y", "x").alias("b"), "words")
    by = ["conv", "depth"]
    dealt = mixed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, a, b = None, 0, 0
        for batch in batches:
            out_a, out_b = [], []
            for c, x, y in zip(batch["conv"].tolist(), batch["a"].tolist(), batch["b"].tolist(), strict=True):
                a, b = (a ^ x, b ^ y) if c == conv else (x, y)
                conv = c
                out_a.append(a)
                out_b.append(b)
            yield batch.assign(a=out_a, b=out_b)

    local = stored(dealt.mapInPandas(run, dealt.schema), "trie-prefixes")
    ends = local.groupBy("conv", "part").agg(F.max_by(F.struct("a", "b"), "depth").alias("end"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv", "part", F.bit_xor("end.a").over(before).alias("ca"), F.bit_xor("end.b").over(before).alias("cb"))
    # only conversations that go on in another range: at most one for each range
    carried = small_side(stored(carried.where("ca IS NOT NULL"), "trie-carried"), 32)
    found = local.join(carried, ["conv", "part"], "left")
    return stored(
        found.select("conv", "depth", F.expr("a ^ coalesce(ca, 0)").alias("a"), F.expr("b ^ coalesce(cb, 0)").alias("b"), "words"),
        "trie-prefixes",
    )


def _merged(rows: DataFrame) -> DataFrame:
    """One level: rows (path, conv, n, child, leaves, saved) that are at the same node become one.

    A row is a conversation that ends here or a child that lost its last turn (``child`` = 1). ``path``
    ends with the node itself. Everything sums up on the map side.
    """
    at = F.element_at("path", -1)
    nodes = rows.groupBy(at["a"].alias("a"), at["b"].alias("b")).agg(
        F.min("conv").alias("conv"),
        F.sum("n").alias("n"),
        F.sum("child").alias("children"),
        F.sum("leaves").alias("below"),
        F.sum("saved").alias("saved"),
        F.first("path").alias("path"),  # all are alike
    )
    return nodes.select(
        "a", "b", "conv", "n", "children",
        F.expr("if(children = 0, 1, below)").alias("leaves"),
        F.expr("saved + (n - 1) * element_at(path, -1).words").alias("saved"),
        "path",
    )


_SURVIVORS = "path string, conv bigint, n bigint, child bigint, leaves bigint, saved bigint"


def _survivors(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn; those without turns left are passed over."""
    stripped = nodes.withColumn("path", F.expr("slice(path, 1, size(path) - 1)")).where("size(path) > 0")
    return stripped.select("path", "conv", "n", F.lit(1).cast("long").alias("child"), "leaves", "saved")


def _peeled(ended: DataFrame, entering: DataFrame | None, top: int, bottom: int) -> list[DataFrame]:
    """Tables of the nodes of depths ``bottom`` down to ``top + 1``, by merging level by level.

    ``ended`` (path, conv, depth) are the conversations that end there, their paths cut off at ``top``;
    ``entering`` are nodes one level below ``bottom``, already without their last turn.
    """
    found, coming = [], entering
    for depth in range(bottom, top, -1):
        here = ended.where(F.col("depth") == depth).select(
            "path", "conv", *(F.lit(v).cast("long").alias(c) for c, v in (("n", 1), ("child", 0), ("leaves", 0), ("saved", 0)))
        )
        rows = here if coming is None else here.unionByName(coming)
        nodes = stored(_merged(rows).withColumn("depth", F.lit(depth).cast("long")), f"trie-level-{depth}")
        found.append(nodes)
        coming = _survivors(nodes)
    return found


def _peel_here(turns: pd.DataFrame) -> pd.DataFrame:
    """The same step for all of one task's turns (conv, depth, a, b, words), which end in whole subtrees."""
    paths = {c: list(zip(g["depth"], g["a"], g["b"], g["words"], strict=True)) for c, g in turns.sort_values("depth").groupby("conv")}
    ending = defaultdict(list)
    for conv, path in paths.items():
        ending[path[-1][0]].append(conv)
    coming: list[tuple] = []  # conv, n, children, leaves, saved of nodes that lost their last turn
    out = []
    first = int(turns["depth"].min())
    for depth in range(max(ending), first - 1, -1):
        merged: dict[tuple, list] = {}
        for conv, n, child, leaves, saved in [*coming, *((c, 1, 0, 0, 0) for c in ending[depth])]:
            own = merged.setdefault(paths[conv][depth - first][1:], [conv, 0, 0, 0, 0])
            own[0] = min(own[0], conv)
            for i, value in enumerate((n, child, leaves, saved), 1):
                own[i] += value
        coming = []
        for (a, b, words), (conv, n, children, leaves, saved) in merged.items():
            leaves, saved = leaves if children else 1, saved + (n - 1) * words
            above = paths[conv][depth - first - 1][1:3] if depth > first else (None, None)
            out.append((a, b, depth, conv, n, children, leaves, saved, *above))
            coming.append((conv, n, 1, leaves, saved))
    # column by column: a null among plain numbers would make floats of all
    names = [column.split()[0] for column in NODE.split(", ")]
    return pd.DataFrame({name: pd.array(values, "Int64") for name, values in zip(names, zip(*out, strict=True), strict=True)})


def _peel_parts(batches: Iterator[pd.DataFrame], held: int) -> Iterator[pd.DataFrame]:
    """Whole subtrees, in order of ``ra`` and ``rb``: as many at a time as have about ``held`` turns together."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        if n >= held:
            rows = pd.concat(waiting, ignore_index=True)
            last = (rows["ra"] == rows["ra"].iloc[-1]) & (rows["rb"] == rows["rb"].iloc[-1])
            if not last.all():
                yield _peel_here(rows[~last])
                rows = rows[last]
            waiting, n = [rows], len(rows)
    if n:
        yield _peel_here(pd.concat(waiting, ignore_index=True))


def _paths(turns: DataFrame, top: int, bottom: int) -> DataFrame:
    """(conv, path): the steps of depths above ``top`` up to ``bottom``, in order."""
    some = turns.where((F.col("depth") > top) & (F.col("depth") <= bottom))
    return some.groupBy("conv").agg(F.array_sort(F.collect_list(F.expr(_STEP))).alias("path"))


def _outcome(levels: list[DataFrame]) -> list[DataFrame]:
    return [
        level.select(
            "a", "b", "depth", "conv", "n", "children", "leaves", "saved",
            *(F.expr(f"if(size(path) > 1, element_at(path, -2).{c}, NULL)").alias(f"parent_{c}") for c in "ab"),
        )
        for level in levels
    ]


def _nodes(turns: DataFrame, convs: DataFrame, block: int, held: int) -> DataFrame:
    """All nodes but the root, as ``NODE``; the first of a block of levels lack their parent's fingerprint."""
    deepest = convs.agg(F.max("turns")).first()[0] or 0
    found, entering, hot_convs = [], None, None
    if deepest > block:
        deep = turns.where(F.col("depth") > block)
        roots = turns.where(F.col("depth") == block).select("conv", F.col("a").alias("ra"), F.col("b").alias("rb"))
        sized = convs.where(F.col("turns") > block).join(roots, "conv").select("conv", "turns", "ra", "rb")
        sized = stored(sized, "trie-long")
        load = sized.groupBy("ra", "rb").agg(F.sum(F.col("turns") - block).alias("load"))
        sized = stored(sized.join(load, ["ra", "rb"]), "trie-long")
        cold = sized.where(F.col("load") <= held).select("conv", "ra", "rb")
        below = deep.join(cold, "conv").repartition("ra", "rb").sortWithinPartitions("ra", "rb")
        local = stored(below.mapInPandas(partial(_peel_parts, held=held), NODE), "trie-deep")
        found.append(local)
        entering = local.where(F.col("depth") == block + 1).select("conv", "n", "leaves", "saved")
        hot_convs = sized.where(F.col("load") > held).select("conv", "turns")
        most = hot_convs.agg(F.max("turns")).first()[0] or 0
        lower = None
        for top in range((most - 1) // block * block if most else 0, 0, -block):
            paths = stored(_paths(deep.join(hot_convs, "conv", "left_semi"), top, top + block), "trie-paths")
            ended = hot_convs.where((F.col("turns") > top) & (F.col("turns") <= top + block))
            ended = stored(ended.join(paths, "conv").select("path", "conv", F.col("turns").alias("depth")), "trie-ended")
            levels = _peeled(ended, lower and _entering(lower, paths), top, min(most, top + block))
            found += _outcome(levels)
            lower = levels[-1].select("conv", "n", "leaves", "saved")
        entering = entering.unionByName(lower) if lower is not None else entering
    paths = stored(_paths(turns, 0, block), "trie-paths")
    ended = convs.where((F.col("turns") > 0) & (F.col("turns") <= block)).join(paths, "conv")
    ended = stored(ended.select("path", "conv", F.col("turns").alias("depth")), "trie-ended")
    levels = _peeled(ended, entering and _entering(entering, paths), 0, max(1, min(deepest, block)))
    first, *others = [*_outcome(levels), *found]
    for frame in others:
        first = first.unionByName(frame)
    return first


def _entering(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes whose last turn opened a block, with what is left of their conversation: the block above."""
    return nodes.join(paths, "conv").select("path", "conv", "n", F.lit(1).cast("long").alias("child"), "leaves", "saved")


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(node, digest) of the ids of the conversations that end at each node; the root's name is empty.

    Ids are put in order by ranges and joined piece by piece; a node's pieces are then hashed one
    after another, as a digest must be, without ever being held together.
    """
    at_end = turns.join(convs.where("turns > 0").select("conv", F.col("turns").alias("depth")), ["conv", "depth"])
    ids = at_end.select(_name().alias("node"), "conv").unionByName(convs.where("turns = 0").select(F.lit("").alias("node"), "conv"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = [
                (node, [conv for _, conv in run])
                for node, run in groupby(zip(batch["node"], batch["conv"].tolist(), strict=True), key=itemgetter(0))
            ]
            yield pd.DataFrame([(n, c[0], ",".join(map(str, c))) for n, c in runs], columns=["node", "first", "ids"])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            done = []
            for own, ids in zip(batch["node"], batch["ids"], strict=True):
                if own == node:
                    state.update(b",")
                else:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=["node", "digest"])
        if state is not None:
            yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "digest"])

    by = ["node", "conv"]
    parts = ids.repartitionByRange(*by).sortWithinPartitions(*by).mapInPandas(pieces, "node string, first bigint, ids string")
    return parts.repartition("node").sortWithinPartitions("node", "first").mapInPandas(digests, "node string, digest string")


def trie(conversations: DataFrame, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty; null turns come first; turns with one number are ordered by their
    fingerprints, so repeated rows are turns of their own. Rows without a conv_id are in no conversation.
    Texts count whole. An empty table has no conversations and gives no rows, not even a root. Other
    columns are ignored. Sequences are told apart by 128 bits of fingerprints.
    """
    turns, convs = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    convs = stored(convs, "trie-convs")
    turns = _prefixes(turns)
    nodes = stored(_nodes(turns, convs, block, held), "trie-nodes")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    below = nodes.where("depth = 1").agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    total, sums = root.first(), below.first()
    # A node's parent by the parent's own turns: names for most, and for the first of a block its conversation's.
    named = nodes.where("depth > 1 AND parent_a IS NOT NULL")
    parents = nodes.where("children > 0").select(
        F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("depth").alias("above"), F.col("conv").alias("parent_conv_id")
    )
    unnamed = nodes.where("depth > 1 AND parent_a IS NULL").drop("parent_a", "parent_b")
    steps = turns.where(F.expr(f"depth % {block} = 0")).select("conv", (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"))
    linked = named.unionByName(unnamed.join(steps, ["conv", "depth"]))
    linked = linked.join(parents, ["parent_a", "parent_b"]).where("above = depth - 1")
    top = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(total and total["conv"]).cast("long"))
    columns = ["a", "b", "depth", "conv", "n", "children", "leaves", "saved", "parent_conv_id"]
    every = linked.select(columns).unionByName(top.select(columns))
    if total:
        at_root = conversations.sparkSession.range(1).select(
            *(F.lit(v).cast("long").alias(c) for c, v in zip(columns, [
                None, None, 0, total["conv"], total["n"], sums["children"], sums["leaves"] or 1, sums["saved"] or 0, None
            ], strict=True))
        )
        every = every.unionByName(at_root)
    return every.withColumn("node", _name()).join(_ends(turns, convs), "node", "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
