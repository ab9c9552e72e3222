"""New source files into the lake table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from headrace.sources.committed import NONE, CommittedTable
from headrace.sources.files import list_files, not_processed, read_as_text

FILES_PER_COMMIT = 1000


@dataclass
class Ingested:
    version_before: int
    version_after: int
    files: list[str] = field(default_factory=list)

    @property
    def has_new_data(self) -> bool:
        return self.version_after > self.version_before


def new_files(spark: SparkSession, location: str, lake: CommittedTable, pattern: str = "*.parquet") -> list[str]:
    """Paths of files not yet committed, in order. Names only; the driver plans the scan from them."""
    listing = list_files(spark, location, pattern)
    return [row["path"] for row in not_processed(listing, lake.source_files()).select("path").collect()]


def ingest(
    spark: SparkSession,
    location: str,
    lake: CommittedTable,
    pattern: str = "*.parquet",
    files_per_commit: int = FILES_PER_COMMIT,
) -> Ingested:
    """Commit all new files, ``files_per_commit`` at a time (1: a version per file).

    Rows and the list of files they came from are committed together. A run that breaks off leaves
    every file either committed or still new.
    """
    last = lake.latest()
    before = last.version if last else NONE
    found = new_files(spark, location, lake, pattern)
    for start in range(0, len(found), files_per_commit):
        chunk = found[start : start + files_per_commit]
        last = lake.commit(read_as_text(spark, chunk), files=chunk, after=last)
    return Ingested(before, last.version if last else NONE, found)
