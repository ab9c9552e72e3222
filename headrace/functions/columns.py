"""Column names and types: the rules every table passes through on its way to serving.

Only names and schemas are handled on the driver; rows are touched by one ``select``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORIGIN = "data_source"
ID = "id"


def field(name: str) -> Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lowered(names: Iterable[str]) -> list[str]:
    """Lower-cased names in order; two names that become equal are an error."""
    result = [name.lower() for name in names]
    repeated = sorted(name for name, n in Counter(result).items() if n > 1)
    if repeated:
        raise ValueError(f"column names differ only in case: {', '.join(repeated)}")
    return result


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.select(*(field(old).alias(new) for old, new in zip(df.columns, lowered(df.columns))))


def to_string(df: DataFrame) -> DataFrame:
    """Cast every column to string."""
    return df.select(*(field(name).cast("string").alias(name) for name in df.columns))


def normalise(df: DataFrame) -> DataFrame:
    """Lower-case all names and cast all values to string, in a single projection."""
    return df.select(
        *(field(old).cast("string").alias(new) for old, new in zip(df.columns, lowered(df.columns)))
    )


def without_id(names: Iterable[str]) -> list[str]:
    """Names other than the row id, whatever its case."""
    return [name for name in names if name.lower() != ID]


def common_columns(left: Sequence[str], right: Sequence[str]) -> list[str]:
    """Sorted lower-cased names found on both sides, without the row id."""
    return sorted(set(without_id(lowered(left))) & set(without_id(lowered(right))))


def all_columns(left: Sequence[str], right: Sequence[str]) -> list[str]:
    """Sorted lower-cased names found on either side, without the row id."""
    return sorted(set(without_id(lowered(left))) | set(without_id(lowered(right))))


def tagged(df: DataFrame, columns: Sequence[str], origin: str) -> DataFrame:
    """Only the given columns, plus the literal origin."""
    return df.select(*(field(name) for name in columns), F.lit(origin).alias(ORIGIN))


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def serving_schema(batch: Sequence[str], stream: Sequence[str]) -> T.StructType:
    """Row id, every column of either side as text, and the origin."""
    names = all_columns(batch, stream)
    if ORIGIN in names:
        raise ValueError(f"an input already has a column named {ORIGIN}")
    return T.StructType(
        [T.StructField(ID, T.LongType()), *text_schema(names), T.StructField(ORIGIN, T.StringType())]
    )


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order; those the table lacks are null."""
    present = set(df.columns)
    return df.select(
        *(
            field(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def widened(known: T.StructType, incoming: T.StructType) -> T.StructType:
    """Known columns followed by the incoming ones that are new; a changed type is an error."""
    types = {f.name: f.dataType for f in known}
    for f in incoming:
        if types.get(f.name, f.dataType) != f.dataType:
            raise ValueError(
                f"column {f.name} changes type from {types[f.name].simpleString()} "
                f"to {f.dataType.simpleString()}"
            )
    new = [f for f in incoming if f.name not in types]
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*known, *new]])
