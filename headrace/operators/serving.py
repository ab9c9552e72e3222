"""The serving table: batch and stream rows on their common columns, tagged with their origin.

A full merge writes a new snapshot and switches to it; a failed one leaves the old in place. Between
merges, each micro-batch of the stream table is appended to the live part. A snapshot records the
stream commit it reaches, and readers add only live commits beyond it, so a row is never seen twice.

Ids of live rows are running numbers over all live commits, kept with each commit. What a reader adds to
them is one number: where the snapshot ends, less what ran before it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.columns import (
    ID,
    ORIGIN,
    aligned,
    common_columns,
    field,
    lowercase_columns,
    normalise,
    serving_schema,
    tagged,
    text_schema,
)
from headrace.operators.numbering import number_rows
from headrace.session import scratch
from headrace.sources.committed import (
    NONE,
    RECORD_KEY,
    VERSION,
    Commit,
    CommittedTable,
    read_records,
    utc_now,
    write_record,
)
from headrace.sources.literals import no_rows, one_row

BATCH, STREAM = "batch", "stream"
SUCCESS = "SUCCESS"
MERGED = "merged"  # kept with a snapshot: location, base and newest version of each table it was merged from
RAN = "rows_through"  # kept with a live commit: rows of all live commits up to it

MERGE_LOG = (
    T.StructType()
    .add("run_time", T.TimestampType())
    .add("batch_count", T.LongType())
    .add("stream_count", T.LongType())
    .add("total_count", T.LongType())
    .add("execution_seconds", T.DecimalType(10, 2))
    .add("status", T.StringType())
)
MERGE_RESULT = (
    T.StructType()
    .add("status", T.StringType())
    .add("batch_rows", T.LongType())
    .add("stream_rows", T.LongType())
    .add("total_rows", T.LongType())
    .add("exec_time", T.DecimalType(10, 2))
)


def domain_violations(rows: DataFrame) -> DataFrame:
    """Rows whose origin is neither batch nor stream. An unknown (null) origin passes."""
    return rows.where(~F.col(ORIGIN).isin(BATCH, STREAM))


def merged_rows(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Batch then stream rows in the serving columns; what only one side has is null.

    The row id is left to the stored table, where every row has a place to be counted from.
    """
    batch, stream = normalise(batch), normalise(stream)
    schema = serving_schema(batch.columns, stream.columns)
    common = common_columns(batch.columns, stream.columns)
    if not common:
        raise ValueError("no common columns")
    united = tagged(batch, common, BATCH).unionByName(tagged(stream, common, STREAM))
    return aligned(united, T.StructType([f for f in schema if f.name != ID]))


class ServingTable:
    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")
        self.snapshots = CommittedTable(spark, f"{self.location}/snapshots")
        self.live = CommittedTable(spark, f"{self.location}/live")
        self.log_location = f"{self.location}/merge_log"

    # -- writing ---------------------------------------------------------------------------------

    def create(self, batch_columns: Sequence[str], stream_columns: Sequence[str]) -> None:
        """An empty serving table for two inputs with these columns."""
        schema = serving_schema(batch_columns, stream_columns)
        empty = no_rows(self.spark, schema)
        self.snapshots.commit(
            empty, replace=True, details=self._details(batch_columns, stream_columns, NONE)
        )

    def merge(
        self,
        batch: DataFrame | CommittedTable,
        stream: DataFrame | CommittedTable,
        notes: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Rebuild from both inputs and return one row: status, counts and seconds.

        A committed table is numbered where it lies. Any other frame is stored first, because ids
        are counted from stored rows; as the stream side it stands for all the stream has delivered
        so far. A committed table without commits adds no rows; its columns are those it was last
        declared or merged with, or else the other side's. ``notes`` are kept with the snapshot. On an
        error nothing changes but the log, and the row says FAILED.
        """
        run = self._next_run()
        started = time.monotonic()
        try:
            counts = self._write_snapshot(batch, stream, notes or {})
            result = (SUCCESS, counts[BATCH], counts[STREAM], counts[BATCH] + counts[STREAM])
        except Exception as error:
            failed = f"FAILED: {error}"
            self._log(run, None, None, None, None, failed)
            return one_row(self.spark, MERGE_RESULT, failed, 0, 0, 0, Decimal(0))
        seconds = Decimal(f"{time.monotonic() - started:.2f}")
        self._log(run, *result[1:], seconds, SUCCESS)
        return one_row(self.spark, MERGE_RESULT, *result, seconds)

    def _log(self, run: int, *values: object) -> None:
        write_record(self.spark, self.log_location, run, MERGE_LOG, utc_now(), *values)

    def _write_snapshot(
        self, batch: DataFrame | CommittedTable, stream: DataFrame | CommittedTable, notes: Mapping[str, str]
    ) -> dict[str, int]:
        newest = {o: t.latest() if isinstance(t, CommittedTable) else None for o, t in ((BATCH, batch), (STREAM, stream))}
        if isinstance(stream, CommittedTable):
            through = newest[STREAM].version if newest[STREAM] else NONE
        else:
            through = self.live.last_version()
        scans = {o: self._stored(side, newest[o]) for o, side in ((BATCH, batch), (STREAM, stream))}
        columns = self._columns(scans)
        schema = serving_schema(columns[BATCH], columns[STREAM])
        common = common_columns(columns[BATCH], columns[STREAM])
        if not common:
            raise ValueError("no common columns")
        narrow = {
            origin: scan.select(*(field(name).cast("string").alias(name) for name in common))
            for origin, scan in scans.items()
            if scan.columns
        }
        numbered, counts = number_rows(narrow)
        # One directory per origin, written apart: no sort, and a filter on origin reads one of them.
        # Columns of one side only are null for every row; the schema supplies them without storage.
        parts = {f"{ORIGIN}={origin}": rows for origin, rows in numbered.items()}
        merged = {
            origin: [side.location, newest[origin].base, newest[origin].version]
            for origin, side in ((BATCH, batch), (STREAM, stream))
            if newest[origin]
        }
        self.snapshots.commit(
            parts or no_rows(self.spark, schema),
            replace=True,
            schema=schema,
            details={
                **notes,
                **self._details(columns[BATCH], columns[STREAM], through),
                MERGED: json.dumps(merged),
            },
        )
        return {BATCH: 0, STREAM: 0, **counts}

    def load(self, rows: DataFrame, aside: CommittedTable | None = None) -> int:
        """Make rows that carry their own origin the served ones; returns how many had to stay out.

        Origins are checked in the pass that stores the rows: those outside the domain are never
        served. They go to ``aside``, or without that table nothing is loaded and the error says how many
        there were. An unknown (null) origin passes.
        """
        seen = Observation()
        rows = normalise(rows)
        place = scratch(self.spark, "loaded")
        bad = ~F.coalesce(F.col(ORIGIN).isin(BATCH, STREAM), F.lit(True))
        checked = rows.observe(seen, F.count_if(bad).alias("violations")).where(~bad)
        checked.write.parquet(place)
        violations = seen.get["violations"]
        if violations and aside is None:
            raise ValueError(f"{violations} rows have an origin other than {BATCH} and {STREAM}")
        if violations:
            aside.commit(rows.where(bad))
        stored = self.spark.read.schema(rows.schema).parquet(place)
        columns = [name for name in rows.columns if name not in (ID, ORIGIN)]
        schema = serving_schema(columns, columns)
        numbered, _ = number_rows({"rows": stored.select(*map(field, columns), ORIGIN)})
        details = self._details(columns, columns, self.live.last_version())
        self.snapshots.commit(aligned(numbered["rows"], schema), replace=True, schema=schema, details=details)
        return violations

    def _columns(self, scans: Mapping[str, DataFrame]) -> dict[str, list[str]]:
        """Both sides' columns; of a side that has none yet, those declared or the other side's."""
        found = {origin: scan.columns for origin, scan in scans.items()}
        if not all(found.values()):
            last = self.snapshots.latest()
            known = last.details if last else {}
            found = {o: c or json.loads(known.get(f"{o}_columns", "[]")) for o, c in found.items()}
        return {BATCH: found[BATCH] or found[STREAM], STREAM: found[STREAM] or found[BATCH]}

    def _stored(self, rows: DataFrame | CommittedTable, newest: Commit | None) -> DataFrame:
        if not isinstance(rows, CommittedTable):
            staged, place = normalise(rows), scratch(self.spark, "staged")
            staged.write.parquet(place)
            return self.spark.read.schema(staged.schema).parquet(place)
        return lowercase_columns(rows.read(newest.version if newest else NONE))

    @staticmethod
    def _details(
        batch_columns: Sequence[str], stream_columns: Sequence[str], stream_through: int
    ) -> dict[str, str]:
        return {
            f"{BATCH}_columns": json.dumps(list(batch_columns)),
            f"{STREAM}_columns": json.dumps(list(stream_columns)),
            "stream_through": str(stream_through),
        }

    def append_stream(self, stream: CommittedTable, commit: Commit) -> DataFrame:
        """Copy one commit of the stream table to serving; repeating it replaces the copy.

        Returns the appended rows as readers see them. Ids continue after all rows before them; rows
        of a commit that the snapshot reaches were numbered anew by the merge and come without ids.
        """
        snapshot = self.snapshots.latest()
        if snapshot is None:
            raise ValueError("create or merge the serving table first")
        rows = lowercase_columns(stream.only(commit))
        common = common_columns(json.loads(snapshot.details["batch_columns"]), rows.columns)
        before = self._ran(commit.version - 1)
        numbered, counts = number_rows({STREAM: rows.select(*map(field, common))}, start=before + 1)
        schema = T.StructType(
            [T.StructField(ID, T.LongType()), *text_schema(common), T.StructField(ORIGIN, T.StringType())]
        )
        added = self.live.commit(
            {f"{ORIGIN}={STREAM}": numbered[STREAM]},
            commit.version,
            schema=schema,
            details={RAN: str(before + counts[STREAM])},
        )
        number = F.lit(None).cast("long") if self.reaches(commit) else F.col(ID) + self._shift(snapshot)
        return aligned(self.live.only(added).withColumn(ID, number), snapshot.schema)

    def _ran(self, version: int) -> int:
        """How many rows all live commits up to a version have."""
        commit = self.live.latest(version)
        return int(commit.details[RAN]) if commit else 0

    def _shift(self, snapshot: Commit) -> int:
        """What the running numbers of live rows differ by from their ids after this snapshot."""
        return snapshot.row_count - self._ran(int(snapshot.details["stream_through"]))

    def reaches(self, commit: Commit) -> bool:
        """Whether the newest snapshot holds this commit of the stream."""
        snapshot = self.snapshots.latest()
        return snapshot is not None and commit.version <= int(snapshot.details["stream_through"])

    # -- reading ---------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The current serving rows: newest snapshot plus the live commits beyond it."""
        snapshot = self.snapshots.latest()
        return self.snapshots.read() if snapshot is None else self._served(snapshot)

    def read_before(self, snapshot: Commit) -> DataFrame:
        """The rows served before this snapshot, none if it is the first."""
        previous = self.snapshots.latest(snapshot.version - 1)
        if previous is None:
            return no_rows(self.spark, snapshot.schema)
        return self._served(previous, int(snapshot.details["stream_through"]))

    def live_versions(self, snapshot: Commit, last: int | None = None) -> list[int]:
        """Stream commits copied to serving beyond a snapshot."""
        return self.live.versions(int(snapshot.details["stream_through"]) + 1, last)

    def _served(self, snapshot: Commit, last: int | None = None) -> DataFrame:
        rows, versions = self.snapshots.only(snapshot), self.live_versions(snapshot, last)
        if not versions:
            return rows
        live = self.live.scan(versions[0], versions[-1])
        return rows.unionByName(aligned(live.withColumn(ID, F.col(ID) + self._shift(snapshot)), snapshot.schema))

    def merge_log(self) -> DataFrame:
        return read_records(self.spark, self.log_location, MERGE_LOG).select(
            F.col(RECORD_KEY).alias(ID), *MERGE_LOG.names
        )

    def _next_run(self) -> int:
        return (self.merge_log().agg(F.max(ID)).first()[0] or 0) + 1
