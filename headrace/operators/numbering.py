"""Dense row ids 1..n over stored Parquet rows, without sorting or moving them.

A Parquet row already has a place: its file and its index in it. A count per file (footers only)
gives each file its first id, and a row's id is that plus its index. No window over the rows, and a
retried task gives the same ids, for the files do not change. Files count in the order of their paths,
however many there are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headrace.functions.columns import ID, field
from headrace.session import scratch

# Up to so many files are listed on the driver, as in every micro-batch; more are listed in ranges.
LISTED_FILES = 1000
# Largest list of files that is sent to every executor. Longer ones are joined by shuffle.
BROADCAST_BYTES = 200 * 1024 * 1024
# Per listed file, besides its path: two longs and the row's own overhead in memory.
ENTRY_BYTES = 64


def _files(scan: DataFrame) -> DataFrame:
    """Every file with its row count."""
    return scan.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))


def _listed_firsts(scan: DataFrame, start: int) -> tuple[DataFrame, int] | None:
    """First id per file and the row count, where the files are few enough to be listed here."""
    listed = _files(scan).limit(LISTED_FILES + 1).collect()
    if len(listed) > LISTED_FILES:
        return None
    firsts, next_id = [], start
    for row in sorted(listed, key=lambda row: row["_file"].encode()):
        firsts.append((row["_file"], next_id))
        next_id += row["_rows"]
    frame = scan.sparkSession.createDataFrame(firsts, "_file STRING, _first LONG").coalesce(1)
    return F.broadcast(frame), next_id - start


def _ranged_firsts(scan: DataFrame, start: int, broadcast_bytes: int) -> tuple[DataFrame, int]:
    """The same ids for any number of files, which are dealt out by ranges of their names.

    Only sums per range are listed here; within a range a window adds up its own files.
    """
    ranged = _files(scan).repartitionByRange("_file").withColumn("_range", F.spark_partition_id())
    place = scratch(scan.sparkSession, "files")
    ranged.write.parquet(place)
    files = scan.sparkSession.read.schema(ranged.schema).parquet(place)
    totals = files.groupBy("_range").agg(
        F.sum("_rows").alias("rows"), F.sum(F.length("_file") + ENTRY_BYTES).alias("size")
    )
    starts, next_id, size = {}, start, 0
    for row in sorted(totals.collect(), key=lambda row: row["_range"]):
        starts[row["_range"]] = next_id
        next_id += row["rows"]
        size += row["size"]
    range_starts = F.create_map(*(F.lit(x) for item in starts.items() for x in item))
    before = Window.partitionBy("_range").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    firsts = files.select("_file", (range_starts[F.col("_range")] + rows_before).alias("_first"))
    return (F.broadcast(firsts) if size <= broadcast_bytes else firsts), next_id - start


def number_rows(
    scans: Mapping[str, DataFrame], start: int = 1, broadcast_bytes: int = BROADCAST_BYTES
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Add ``id`` to each scan, counting on from one scan to the next; also return their row counts.

    A scan must read whole Parquet files: columns may be chosen or renamed and whole directories
    left out, but rows may not be filtered, or the ids would have gaps.
    """
    numbered, counts = {}, {}
    for name, scan in scans.items():
        firsts, counts[name] = _listed_firsts(scan, start) or _ranged_firsts(scan, start, broadcast_bytes)
        start += counts[name]
        placed = scan.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")
        )
        numbered[name] = placed.join(firsts, "_file").select(
            (F.col("_first") + F.col("_index")).alias(ID), *(field(c) for c in scan.columns)
        )
    return numbered, counts
