"""The daily chain: ingest, mirror, export, merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.operators.mirror import mirror_files
from headrace.plans.export import export_changes
from headrace.plans.ingest import FILES_PER_COMMIT, ingest
from headrace.sources.committed import VERSION, CommittedTable
from headrace.sources.literals import one_row
from headrace.sources.relational import JdbcTable

SUMMARY = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "new_files", "version_before", "version_after", "mirrored_files", "unmirrored_files", "exported_rows"
        )
    ]
)

MERGED = T.StructType().add("merge_status", T.StringType()).add("merged_rows", T.LongType())


def mirror_pending(
    spark: SparkSession, lake: CommittedTable, mirrored: CommittedTable, destination: str
) -> DataFrame:
    """Mirror every ingested file without an ``ok`` so far; missing and failed ones stay pending."""
    done = mirrored.read().where("status = 'ok'") if mirrored.last_version() >= 0 else None
    files = lake.source_files().groupBy("path").agg(F.max(VERSION).alias(VERSION))
    pending = files.join(done, "path", "left_anti") if done is not None else files
    # in the order of their arrival: a later file replaces an earlier one of its name
    paths = [row["path"] for row in pending.orderBy(VERSION, "path").select("path").collect()]
    if paths:
        version = mirrored.commit(mirror_files(spark, paths, destination)).version
    else:
        version = mirrored.last_version() + 1
    return mirrored.scan(version, version)


def run_daily(
    spark: SparkSession,
    source: str,
    lake: CommittedTable,
    mirrored: CommittedTable,
    mirror_to: str,
    target: CommittedTable | JdbcTable,
    pattern: str = "*.parquet",
    files_per_commit: int = FILES_PER_COMMIT,
    merge: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """One row saying what the run did. A step that fails ends the run; a later run makes up for it.

    ``merge`` is the last step, such as a view's ``rebuild``, which takes up what was exported; its status and
    row count are then part of the row. A merge that fails says so there, and leaves what was served.
    """
    new = ingest(spark, source, lake, pattern, files_per_commit)
    outcome = mirror_pending(spark, lake, mirrored, mirror_to)
    if "status" in outcome.columns:
        counts = outcome.agg(F.count_if(F.col("status") == "ok"), F.count_if(F.col("status") != "ok")).first()
    else:
        counts = (0, 0)
    exported = export_changes(lake, target)
    rows = exported.rows if exported else 0
    done = (len(new.files), new.version_before, new.version_after, *counts, rows)
    if merge is None:
        return one_row(spark, SUMMARY, *done)
    merged = merge().first()
    return one_row(spark, T.StructType([*SUMMARY, *MERGED]), *done, merged["status"], merged["total_rows"])
