"""Space given back: directories that no reader can come to any more.

What is still reachable follows from the records alone. A table's data is reachable from its newest
base on, and as far back as its history is to be kept; a serving table's live commits are reachable
beyond the oldest snapshot that is kept. The rest goes, records first: a commit without a record is
not seen by anyone, so a run that breaks off leaves nothing half there.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from headrace.operators.serving import ServingTable
from headrace.sources.committed import NONE, RECORD_KEY, VERSION, CommittedTable


def _folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders directly under a location, on any file system the session knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(path) if s.isDirectory()] if system.exists(path) else []


def _drop(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _forget(table: CommittedTable, versions: list[int]) -> None:
    """Records, newest first: what is left is always a table as of some version.

    The source files they list are noted first, for they must not be taken as new again.
    """
    if versions:
        files = table.log().where(F.col(VERSION) <= max(versions)).select(F.explode("files").alias("path"), VERSION)
        files.write.mode("overwrite").parquet(f"{table.taken}/through={max(versions)}")
    for version in sorted(versions, reverse=True):
        _drop(table.spark, f"{table.records}/{RECORD_KEY}={version}")
        _drop(table.spark, f"{table.data}/{VERSION}={version}")


def unrecorded(table: CommittedTable) -> list[int]:
    """Versions below the newest that have data and no record: what attempts left that were given up."""
    known = table.versions()
    stored = {int(found) for name in _folders(table.spark, table.data) for found in re.findall(rf"^{VERSION}=(\d+)$", name)}
    return sorted(v for v in stored - set(known) if known and v < known[-1])


def give_back(table: CommittedTable, keep_from: int | None = None) -> list[int]:
    """Drop the commits that a replaced table consisted of, and what given-up attempts left.

    ``keep_from`` keeps the table readable as of that version and all later ones; without it only the newest
    content stays. Readers that started on older content must be done. A feed or an export that has to
    start further back than what was kept takes the table as replaced. Returns the versions dropped.
    """
    newest = table.latest()
    if newest is None:
        return []
    oldest = table.latest(keep_from) if keep_from is not None else newest
    base = min(newest.base, oldest.base if oldest else newest.base)
    gone = table.versions(last=base - 1)
    _forget(table, gone)
    left = unrecorded(table)
    for version in left:
        _drop(table.spark, f"{table.data}/{VERSION}={version}")
    return sorted([*gone, *left])


def give_back_serving(serving: ServingTable, snapshots: int = 2) -> dict[str, list[int]]:
    """Keep the newest ``snapshots`` snapshots, and the live commits beyond the oldest of them.

    The newest live commit always stays, for it tells how far live rows have been counted.
    """
    known = serving.snapshots.versions()
    if not known:
        return {"snapshots": [], "live": []}
    kept = serving.snapshots.latest(known[-min(max(snapshots, 1), len(known))])
    through = int(kept.details["stream_through"])
    live = serving.live.versions(last=through)
    reached = live[:-1] if through != NONE else []  # its count is where the live part starts
    _forget(serving.live, reached)
    gone = serving.snapshots.versions(last=kept.version - 1)
    _forget(serving.snapshots, gone)
    return {"snapshots": gone, "live": reached}


def give_back_scratch(spark: SparkSession, root: str | None = None, running: tuple[str, ...] = ()) -> list[str]:
    """Drop the scratch of applications that have ended; returns their ids.

    All folders under the shared scratch folder but this application's own and those named as ``running``.
    """
    root = root or spark.conf.get("spark.checkpoint.dir")
    place = f"{root.rstrip('/')}/headrace"
    own = {spark.conf.get("spark.app.id", "app"), *running}
    ended = [name for name in _folders(spark, place) if name not in own]
    for name in ended:
        _drop(spark, f"{place}/{name}")
    return ended
