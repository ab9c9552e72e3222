"""The stream message: JSON text holding its own schema next to the payload.

``{"schema": {"type", "name", "fields": [{"field", "type"}]}, "payload": {column: text}}``
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.columns import field, text_schema

VALUE = "value"


def encode(df: DataFrame, name: str) -> DataFrame:
    """One ``value`` per row. All columns are sent as text; nulls are kept as JSON nulls."""
    fields = [{"field": column, "type": "string"} for column in df.columns]
    schema = {"type": "struct", "name": name, "fields": fields}
    # The schema part is the same for every row, so it is printed once, here.
    head = '{"schema":' + json.dumps(schema, separators=(",", ":"), ensure_ascii=False) + ',"payload":'
    payload = F.struct(*(field(column).cast("string").alias(column) for column in df.columns))
    text = F.to_json(payload, {"ignoreNullFields": "false"})
    return df.select(F.concat(F.lit(head), text, F.lit("}")).alias(VALUE))


def _opened(df: DataFrame, spellings: Sequence[str], *keep: str) -> DataFrame:
    """Each message as ``schema`` and ``payload``, both null where the text is not JSON.

    The payload's fields come by place (``_0``, ``_1``, ...), as names that differ only in case could not
    be told apart afterwards. ``inline`` keeps the parsed text: behind a plain projection, every later
    filter and column would have the optimizer parse it again.
    """
    payload = text_schema(spellings) if spellings else T.MapType(T.StringType(), T.StringType())
    fields = T.ArrayType(text_schema(["field"]))
    shape = T.StructType().add("schema", T.StructType().add("fields", fields)).add("payload", payload)
    opened = df.select(*keep, F.inline(F.array(F.from_json(VALUE, shape))))
    if not spellings:
        return opened
    by_place = text_schema(f"_{n}" for n in range(len(spellings)))
    return opened.withColumn("payload", F.col("payload").cast(by_place))


READABLE = "schema.fields IS NOT NULL AND payload IS NOT NULL"


def survey(df: DataFrame) -> tuple[list[str], bool]:
    """The column names the messages' own schemas declare, sorted, and whether all are readable.

    One pass; names are made distinct on the executors, so only names reach the driver.
    """
    names = F.when(F.expr(READABLE), F.col("schema.fields.field"))
    found = _opened(df, []).select(F.explode_outer(names).alias("name")).distinct().collect()
    declared = {row["name"] for row in found}
    return sorted(declared - {None}), None not in declared


def decode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given payload columns of every readable message; an absent one is null."""
    rows = _opened(df, columns).where(READABLE)
    return rows.select(*(F.col(f"payload._{n}").alias(column) for n, column in enumerate(columns)))


def merged(spellings: Sequence[str]) -> dict[str, list[int]]:
    """Places of the names that are equal in lower case, by that name, in order of its first place."""
    places: dict[str, list[int]] = {}
    for n, name in enumerate(spellings):
        places.setdefault(name.lower(), []).append(n)
    return places


def decode_observed(df: DataFrame, spellings: Sequence[str], seen: Observation) -> DataFrame:
    """Rows of every readable message in lower-case columns, and what else there was, in one parse.

    Fields whose names differ only in case are one column; if a message has several of them, the first
    in order of ``spellings`` that is not null counts. ``seen`` gets ``undeclared``, the lists of names
    that messages declare and ``spellings`` lacks, and ``unreadable``, the number of messages left out.
    """
    known = F.array(*map(F.lit, spellings)).cast("array<string>")
    other = F.filter("schema.fields.field", lambda name: ~F.array_contains(known, name))
    readable = F.expr(READABLE)
    rows = _opened(df, spellings).observe(
        seen,
        F.collect_set(F.when(readable & (F.size(other) > 0), other)).alias("undeclared"),
        F.count_if(~F.coalesce(readable, F.lit(False))).alias("unreadable"),
    )
    columns = (
        F.coalesce(*(F.col(f"payload._{n}") for n in places)).alias(name) for name, places in merged(spellings).items()
    )
    return rows.where(READABLE).select(*columns)


def rejects(df: DataFrame) -> DataFrame:
    """Messages that are not an envelope, unchanged."""
    return _opened(df, [], VALUE).where(f"NOT ({READABLE})").select(VALUE)
