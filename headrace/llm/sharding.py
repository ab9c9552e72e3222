"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in the order of their ids. A keyed Feistel network permutes the numbers of
the next even power of two, and a number that lands at n or beyond walks on through the permutation
until it is below n; so the numbers 0..n-1 are permuted among themselves. ``position % shards`` is the
shard and ``position // shards`` the slot: counts differ by one at most and slots have no gaps. Both
ways can be computed from the seed and n alone, without any table.

Numbering needs one range shuffle of narrow rows; per-task counts give each task its first number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm.common import stored

SHARDS = 16
ROUNDS = 6
SEED = 20_240_229


def _mixed(half: np.ndarray, key: int) -> np.ndarray:
    """64 well-mixed bits of each value: multiply and fold, twice."""
    x = half + np.uint64(key)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, ROUNDS)]


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _walk(values: np.ndarray, n: int, step) -> np.ndarray:
    out = step(values.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = step(out[outside])
    return out.astype(np.int64)


def permute(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """Positions of row numbers under the permutation of 0..n-1."""
    bits, keys = np.uint64(_half_bits(n)), _keys(seed)
    mask = np.uint64((1 << int(bits)) - 1)

    def step(x):
        left, right = x >> bits, x & mask
        for key in keys:
            left, right = right, left ^ (_mixed(right, key) & mask)
        return left << bits | right

    return _walk(numbers, n, step)


def unpermute(positions: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """Row numbers that ``permute`` puts at these positions."""
    bits, keys = np.uint64(_half_bits(n)), _keys(seed)
    mask = np.uint64((1 << int(bits)) - 1)

    def step(x):
        left, right = x >> bits, x & mask
        for key in reversed(keys):
            left, right = right ^ (_mixed(left, key) & mask), left
        return left << bits | right

    return _walk(positions, n, step)


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Add a dense ``row_number`` from 0 in the given order; also returns how many rows there are."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        rows.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftright("_at", 33))
        .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))),
        "ordered",
    )
    counts = sorted(placed.groupBy("_task").count().collect())  # one per task
    first = accumulate((c for _, c in counts), initial=0)
    offsets = spark.createDataFrame(
        [(t, o) for (t, _), o in zip(counts, first, strict=False)], "_task bigint, _first bigint"
    )
    out = placed.join(F.broadcast(offsets), "_task").withColumn("row_number", F.col("_first") + F.col("_at"))
    return out.drop("_task", "_first", "_at"), sum(c for _, c in counts)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's bytes plus one; null texts count as empty. Null ids come first in the
    order; rows with the same id are ordered by their texts' checksums, and full repeats are alike,
    so either may have either place. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows, n = numbered(narrow, ["doc_id", "text_crc32", "size"])

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            position = permute(batch["row_number"].to_numpy(), n, seed)
            yield batch[["doc_id", "size", "text_crc32"]].assign(
                law="rows", shard=(position % shards).astype(np.int32), slot=position // shards, grown_shard=None
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    as_text = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = as_text.mapInPandas(
        placed, "doc_id string, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
