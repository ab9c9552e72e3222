"""Row counts and the report of a committed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.functions.columns import ORIGIN, field
from headrace.sources.committed import VERSION, CommittedTable

SAMPLE_ROWS = 10


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def origin_counts(serving: DataFrame) -> DataFrame:
    """Batch, stream and total rows in one pass."""
    return serving.agg(
        F.count_if(F.col(ORIGIN) == "batch").alias("batch_rows"),
        F.count_if(F.col(ORIGIN) == "stream").alias("stream_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def table_report(table: CommittedTable) -> DataFrame:
    """Rows, source files and version span, all from the commit records: no data is scanned."""
    last = table.latest()
    visible = table.log().where(F.col(VERSION) >= (last.base if last else 0))
    return visible.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.size("files")), F.lit(0)).cast("bigint").alias("file_count"),
        F.min(VERSION).alias("first_version"),
        F.max(VERSION).alias("last_version"),
    )


def sample(table: CommittedTable, by: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows by the given columns, found by a top-n per task."""
    return table.read().orderBy(*map(field, by)).limit(rows)
