"""Places of rows within their groups, without a window over any group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.llm.common import small_side, stored

PLACE = "place"
_LOCAL = ["_group", "_part", "_local"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's place among the neighbours of its group in this task; groups lie in one run."""
    group, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column("_group").to_numpy(zero_copy_only=False)
        new = np.append(own[0] != group, own[1:] != own[:-1])
        at = np.arange(len(own))
        start = np.maximum.accumulate(np.where(new, at, -1))
        local = np.where(start >= 0, at - start, at + seen)
        group, seen = own[-1], int(local[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], [*batch.schema.names, "_local"])


def placed(df: DataFrame, keys: list[str], order: list[Column], purpose: str) -> DataFrame:
    """``df`` with ``place``: 0, 1, 2, ... within rows of equal ``keys``, in the given order, nulls first.

    Rows are dealt out by ranges of keys and order, so a group that holds a third of all rows is
    spread like the rest, and equal rows too, by where they were read. Workers number runs; only groups that go on in
    another range, at most one for each range, need an offset. The result is a stored table.
    """
    by = [*map(F.col, keys), *order, F.col("_tie")]
    group = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    tied = df.withColumn("_group", group).withColumn("_tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_part", F.spark_partition_id())
    rows = stored(dealt.mapInArrow(_counted, T.StructType([*dealt.schema, T.StructField("_local", T.LongType())])), purpose)
    pieces = rows.groupBy("_group", "_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = pieces.select("_group", "_part", before.alias("_before")).where("_before > 0")
    offsets = small_side(stored(offsets, f"{purpose}-offsets"), 24)
    found = rows.join(offsets, ["_group", "_part"], "left")
    return found.withColumn(PLACE, F.col("_local") + F.coalesce("_before", F.lit(0))).drop(*_LOCAL, "_before")
