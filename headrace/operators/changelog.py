"""Row changes as events: what was created, updated or deleted, with the row before and after."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.functions.columns import field

# Operation codes of a change event.
CREATED, UPDATED, DELETED = "c", "u", "d"

# Copies of one row that a single task writes out; more are shared among tasks.
COPIES_PER_TASK = 1_000_000


def _row(columns: Sequence[str]) -> Column:
    return F.struct(*(field(name) for name in columns))


def _surplus(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every distinct row that changed in number, with the difference: after minus before.

    Equal rows are counted on the map side, so neither unchanged rows nor copies go further than one
    shuffle of distinct rows.
    """
    if set(before.columns) != set(after.columns):
        raise ValueError("both snapshots must have the same columns")
    marked = before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))
    return marked.groupBy(*map(field, before.columns)).agg(F.sum("_n").alias("_n")).where("_n <> 0")


def keyed_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``op, before, after`` for every key whose row differs between two snapshots.

    Only rows that differ are brought together by key. A key with more than one removed or one added
    row cannot be told as a single change and is an error; ``row_changes`` needs no keys. A null in a
    key equals nothing, as in a join: such rows are created or deleted, each copy for itself.
    """
    row, gone, came = _row(before.columns), F.col("_n") < 0, F.col("_n") > 0
    nameless = reduce(or_, (field(name).isNull() for name in keys))
    by_key = _surplus(before, after).groupBy(*map(field, keys), F.when(nameless, row).alias("_alone")).agg(
        F.first(F.when(gone, row), ignorenulls=True).alias("before"),
        F.first(F.when(came, row), ignorenulls=True).alias("after"),
        F.max(F.abs("_n")).alias("copies"),
        F.greatest(F.count_if(gone), F.count_if(came)).alias("rows"),
    )
    repeated = F.col("_alone").isNull() & ((F.col("copies") > 1) | (F.col("rows") > 1))
    op = (
        F.when(repeated, F.raise_error(F.lit("a changed key occurs more than once")).cast("string"))
        .when(F.col("before").isNull(), CREATED)
        .when(F.col("after").isNull(), DELETED)
        .otherwise(UPDATED)
    )
    events = by_key.select(op.alias("op"), "before", "after", F.when(F.col("_alone").isNotNull(), F.col("copies")).alias("_copies"))
    each = events.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("_copies", F.lit(1)).cast("bigint"))))
    return each.select("op", "before", "after")


def row_changes(before: DataFrame, after: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """``op, before, after`` without keys: one event per copy of a row that came or went.

    A row with very many surplus copies is written out in shares by several tasks.
    """
    columns = before.columns
    net = _surplus(before, after)
    copies = F.abs("_n")

    few = net.where(copies <= copies_per_task).withColumn("_share", copies)
    last = F.floor((copies - 1) / copies_per_task).cast("bigint")
    many = (
        net.where(copies > copies_per_task)
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .repartition(F.col("_part"), *map(field, columns))
        .withColumn("_share", F.least(F.lit(copies_per_task), copies - F.col("_part") * copies_per_task))
        .drop("_part")
    )
    each = few.unionByName(many).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_share").cast("bigint")))
    )
    came = F.col("_n") > 0
    return each.select(
        F.when(came, CREATED).otherwise(DELETED).alias("op"),
        F.when(~came, _row(columns)).alias("before"),
        F.when(came, _row(columns)).alias("after"),
    )


def created(rows: DataFrame) -> DataFrame:
    """Every row as newly created."""
    row = _row(rows.columns)
    row_type = rows.select(row.alias("row")).schema["row"].dataType
    return rows.select(
        F.lit(CREATED).alias("op"), F.lit(None).cast(row_type).alias("before"), row.alias("after")
    )


def as_messages(changes: DataFrame, at: Column | None = None) -> DataFrame:
    """Changes as JSON text in one ``value`` column, ready for a topic."""
    millis = F.unix_millis(at if at is not None else F.current_timestamp())
    event = F.struct("op", "before", "after", millis.alias("ts_ms"))
    return changes.select(F.to_json(event, {"ignoreNullFields": "false"}).alias("value"))


def topic_name(server: str, schema: str, table: str) -> str:
    return f"{server}.{schema}.{table}"
