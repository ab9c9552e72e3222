"""Sets of keys over two sources, ordered lists, newest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _presence(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every distinct key with the sides it occurs on.

    One shuffle, reduced on the map side first: a key that fills a third of all rows travels as one
    row per task. Null keys count as equal.
    """
    sides = left.select(*keys, F.lit(True).alias("in_left"), F.lit(False).alias("in_right")).unionByName(
        right.select(*keys, F.lit(False).alias("in_left"), F.lit(True).alias("in_right"))
    )
    return sides.groupBy(*keys).agg(
        F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right")
    )


def in_both(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present on both sides."""
    return _presence(left, right, keys).where("in_left AND in_right").select(*keys)


def in_either(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present on at least one side."""
    return left.select(*keys).unionByName(right.select(*keys)).distinct()


def distinct_list(
    df: DataFrame, value: str, by: Sequence[str] = (), separator: str = ", ", name: str | None = None
) -> DataFrame:
    """Distinct values in order, joined to one text, per group.

    Values are made distinct before they are gathered, so a group's size in rows does not matter.
    """
    values = df.select(*by, value).where(F.col(value).isNotNull()).distinct()
    gathered = F.array_join(F.array_sort(F.collect_list(value)), separator)
    return values.groupBy(*by).agg(gathered.alias(name or value))


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in an order: each task keeps n, so no full sort takes place."""
    return df.orderBy(*order).limit(n)
