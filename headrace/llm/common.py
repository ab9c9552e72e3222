"""Helpers the operators share: stored intermediate tables, document keys, checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.session import scratch

# Tables up to this many bytes, counted after they were written, may be broadcast.
BROADCAST_BYTES = 32 << 20
BATCH_ROWS = 1024


def modest_batches(spark) -> None:
    """Rows reach Python at most this many at a time: whole texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    modest_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later steps start from files."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """Ask for a broadcast of a *stored* table only if its rows' bytes stay under the bound.

    Rows of one width are counted; for rows that hold lists or texts the width is an expression, summed.
    """
    size = df.count() * row_bytes if isinstance(row_bytes, int) else df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once per row and hand it to ``use``, as often as that refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id but not a text; null and empty texts count as different."""
    return F.xxhash64(text)
