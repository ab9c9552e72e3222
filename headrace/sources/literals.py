"""Small frames made of known values, without a detour through Python workers or RDDs."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(value, Mapping):
        return F.create_map(*(F.lit(x) for item in value.items() for x in item)).cast(kind)
    return F.lit(value).cast(kind)


def one_row(spark: SparkSession, schema: T.StructType, *values: Any) -> DataFrame:
    columns = (_literal(value, f.dataType).alias(f.name) for value, f in zip(values, schema, strict=True))
    return spark.range(0, 1, 1, 1).select(*columns)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
