"""What to take from a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.sources.committed import CHANGE_TYPE, CHANGE_VERSION, COMMITTED_AT

# The change types that carry a row's current content.
CURRENT_ROWS = ["insert", "update_postimage"]


def current_rows(feed: DataFrame) -> DataFrame:
    """Inserted rows and the new side of updates."""
    return feed.where(F.col(CHANGE_TYPE).isin(CURRENT_ROWS))


def without_feed_columns(feed: DataFrame) -> DataFrame:
    return feed.drop(CHANGE_TYPE, CHANGE_VERSION, COMMITTED_AT)


def exportable(feed: DataFrame) -> DataFrame:
    """The rows to export, with the table's own columns only."""
    return without_feed_columns(current_rows(feed))
