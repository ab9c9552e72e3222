"""A Merkle manifest of a dataset, and each document's proof checked against its root.

Leaves are digests of rows. Per source, in id order, runs of 16 consecutive nodes become one node until
one is left; what is left of the sources is joined in the same way. Two steps:

1. *Build.* Leaves get their place within their source by ranges, so a source with a third of all rows is
   spread. Each level is one grouping of at most ``FANOUT`` rows a group, and is written as node rows: own
   name, own digest, digests of its children, name of its parent and slot there.
2. *Climb.* A recursive query starts at the lowest run of each leaf and joins its parent's row until there is
   none, appending the siblings it passes and folding the leaf's digest with them. Leaves of one run share all
   siblings above it, so they climb in one row that carries as many folded digests, each folded on its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.llm.common import small_side, stored
from headrace.llm.places import PLACE, placed

FANOUT = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
RESULT = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TAMPERED_OF = 5

CLIMB = """
WITH RECURSIVE climb (run, folded, proof, subroot, parent, slot) AS (
  SELECT run, folded, proof, subroot, parent, slot FROM {bottom}
  UNION ALL
  SELECT c.run,
    transform(c.folded, f -> sha2(array_join(transform(n.children, (x, i) -> if(i = c.slot, f, x)), ''), 256)),
    concat(c.proof, array_join(filter(n.children, (x, i) -> i <> c.slot), '')),
    coalesce(c.subroot, n.subroot), n.parent, n.slot
  FROM climb AS c JOIN {nodes} AS n ON n.node = c.parent
)
SELECT run, folded, proof, subroot FROM climb WHERE parent IS NULL
"""


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*(_part(F.col(f)) for f in FIELDS[:-1]), _part(text)), 256)


def _folded(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def _name(top: bool, tree: Column, level: Column | int, place: Column) -> Column:
    """A node's name; the digest of tree, level and place, as sources may be long."""
    level = F.lit(level) if isinstance(level, int) else level
    return F.md5(F.concat_ws("|", F.lit("top" if top else "own"), level, place, _part(tree)))


def _above(width: Column) -> Column:
    return F.ceil(width / FANOUT).cast("long")


def _levels(nodes: DataFrame, widest: int, purpose: str) -> list[DataFrame]:
    """Tables of runs (tree, width, level, place, digest, children), lowest level first.

    ``nodes`` are (tree, width, place, digest) with the number of nodes of their tree as ``width``.
    """
    found, level = [], 0
    while widest > 1:
        level, widest = level + 1, -(-widest // FANOUT)
        run = F.floor(F.col(PLACE) / FANOUT).cast("long")
        runs = (
            nodes.where("width > 1")
            .groupBy("tree", "width", run.alias("run"))
            .agg(F.array_sort(F.collect_list(F.struct(PLACE, "digest"))).alias("kids"))
            .select("tree", _above(F.col("width")).alias("width"), F.lit(level).alias("level"), F.col("run").alias(PLACE),
                    F.col("kids.digest").alias("children"))
            .withColumn("digest", _folded(F.col("children")))
        )
        nodes = stored(runs, f"{purpose}-{level}")
        found.append(nodes)
    return found


def _united(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


@contextmanager
def _unlimited_rows(spark: SparkSession) -> Iterator[None]:
    """A recursive query over any number of rows; the caller's setting comes back."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _linked(runs: DataFrame) -> DataFrame:
    """Runs that are not their tree's last node, with the name of their parent."""
    return runs.where("width > 1").select(
        _name(False, F.col("tree"), F.col("level"), F.col(PLACE)).alias("node"),
        "children",
        F.lit(None).cast("string").alias("subroot"),
        _name(False, F.col("tree"), F.col("level") + 1, F.floor(F.col(PLACE) / FANOUT)).alias("parent"),
        (F.col(PLACE) % FANOUT).cast("int").alias("slot"),
    )


def manifest(docs: DataFrame) -> dict[str, DataFrame | str | None]:
    """``leaves`` (tree, width, place, doc_id, leaf, changed), ``nodes`` (node, digest's children, subroot,
    parent, slot) and the ``root`` digest, null for an empty table.

    ``changed`` is the leaf of a tampered row, null for others.
    """
    text = F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_OF == 0
    leaves = docs.select(
        F.col("source").cast("string").alias("tree"),
        "doc_id",
        _leaf(text).alias("leaf"),
        F.when(tampered, _leaf(F.translate(text, _UPPER, _UPPER.lower()))).alias("changed"),
    )
    leaves = placed(leaves, ["tree"], [F.col("doc_id"), F.col("leaf")], "merkle-leaves")
    widths = stored(leaves.groupBy(F.col("tree").alias("_tree")).agg(F.count("*").alias("width")), "merkle-widths")
    size = widths.agg(F.max("width"), F.count("*"), F.max(F.octet_length("_tree"))).first()
    if not size[1]:
        return {"leaves": leaves.withColumn("width", F.lit(0).cast("long")), "nodes": None, "root": None}
    widths = small_side(widths, 16 + (size[2] or 0))
    leaves = stored(leaves.join(widths, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree"), "merkle-leaves")

    lowest = leaves.select("tree", "width", PLACE, F.col("leaf").alias("digest"))
    levels = _levels(lowest, size[0], "merkle")
    single = lowest.select("tree", "width", F.lit(0).alias("level"), PLACE, F.lit(None).cast("array<string>").alias("children"), "digest")
    last = _united([frame.where("width = 1") for frame in [single, *levels]]).withColumnRenamed(PLACE, "own_place")
    last = stored(placed(last, [], [F.col("tree")], "merkle-subroots"), "merkle-subroots")
    sources = size[1]
    tops = _levels(
        last.select(F.lit("").alias("tree"), F.lit(sources).cast("long").alias("width"), PLACE, "digest"), sources, "merkle-top"
    )
    nowhere = F.lit(None).cast("string")
    subroots = last.select(
        _name(False, F.col("tree"), F.col("level"), F.col("own_place")).alias("node"),
        "children",
        F.col("digest").alias("subroot"),
        (_name(True, F.lit(""), 1, F.floor(F.col(PLACE) / FANOUT)) if sources > 1 else nowhere).alias("parent"),
        (F.col(PLACE) % FANOUT).cast("int").alias("slot"),
    )
    above = [
        top.select(
            _name(True, F.lit(""), F.col("level"), F.col(PLACE)).alias("node"),
            "children",
            nowhere.alias("subroot"),
            F.when(F.col("width") > 1, _name(True, F.lit(""), F.col("level") + 1, F.floor(F.col(PLACE) / FANOUT))).alias("parent"),
            (F.col(PLACE) % FANOUT).cast("int").alias("slot"),
        )
        for top in tops
    ]
    root = (tops[-1] if tops else last).select("digest").first()[0]
    nodes = stored(_united([*map(_linked, levels), subroots, *above]), "merkle-nodes")
    return {"leaves": leaves, "nodes": nodes, "root": root}


def verify(docs: DataFrame) -> DataFrame:
    """Per row: leaf, subroot, root and proof as built, and the root folded from the tampered row.

    Null values have a digest part of their own; a null source is a source, first of all; a null doc_id is
    smallest and never tampered; rows that share an id are ordered by their leaves, so equal rows have equal
    digests in any order. A null text stays null when tampered, an empty one is its own tampered form and
    still verifies, as do texts without capitals. Extra columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    built = manifest(docs.select(FIELDS))
    leaves, nodes, root = built["leaves"], built["nodes"], built["root"]
    if nodes is None:
        empty = ", ".join(f"CAST(NULL AS STRING) AS {c}" for c in ("subroot", "root", "proof_sha256", "folded_root"))
        return leaves.selectExpr("doc_id", "leaf", *empty.split(", "), "CAST(NULL AS BOOLEAN) AS verified")
    # The lowest run of each leaf; an only leaf is its tree's last node and climbs on its own.
    run = F.floor(F.col(PLACE) / FANOUT)
    lone = F.col("width") == 1
    name = F.when(lone, _name(False, F.col("tree"), 0, F.col(PLACE))).otherwise(_name(False, F.col("tree"), 1, run))
    start = F.struct(PLACE, "doc_id", "leaf", F.coalesce("changed", "leaf").alias("changed"), lone.alias("lone"))
    grouped = leaves.groupBy(name.alias("run")).agg(F.array_sort(F.collect_list(start)).alias("kids"))
    runs = stored(grouped, "merkle-runs")
    fold = F.transform(
        "kids",
        lambda own: F.when(own["lone"], own["changed"]).otherwise(
            _folded(F.transform("kids", lambda kid: F.when(kid[PLACE] == own[PLACE], own["changed"]).otherwise(kid["leaf"])))
        ),
    )
    bottom = runs.select("run", fold.alias("folded")).join(nodes, F.col("run") == F.col("node"))
    bottom = stored(bottom.select("run", "folded", F.lit("").alias("proof"), "subroot", "parent", "slot"), "merkle-bottom")
    names = {name: f"merkle_{name}_{uuid.uuid4().hex}" for name in ("bottom", "nodes")}
    bottom.createOrReplaceTempView(names["bottom"])
    nodes.createOrReplaceTempView(names["nodes"])
    try:
        with _unlimited_rows(spark):
            climbed = stored(spark.sql(CLIMB.format(**names)), "merkle-climbed")
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)
    each = runs.join(climbed, "run").select("kids", "folded", "proof", "subroot", F.posexplode("kids").alias("at", "own"))
    beside = F.array_join(F.transform(F.filter("kids", lambda kid: kid[PLACE] != F.col("own")[PLACE]), lambda kid: kid["leaf"]), "")
    return each.select(
        F.col("own.doc_id").alias("doc_id"),
        F.col("own.leaf").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        F.sha2(F.concat(beside, "proof"), 256).alias("proof_sha256"),
        F.element_at("folded", F.col("at") + 1).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
