"""A Parquet dataset with one directory per commit and one small record per commit.

A commit becomes visible when its record is written, after its data. A retry under the same version
overwrites the same directory, so nothing is stored twice and nothing half-written is ever read.
The record holds the table's schema, so a reader opens no footers to learn it. Which commits there are is
told by the names of the records: a reader opens the newest one only, at any age of the table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions.columns import aligned, widened
from headrace.operators.changelog import CREATED, DELETED, keyed_changes
from headrace.sources.literals import no_rows, one_row

VERSION = "commit_version"
COMMITTED_AT = "_commit_timestamp"
CHANGE_TYPE = "_change_type"
CHANGE_VERSION = "_commit_version"
NONE = -1

RECORD = (
    T.StructType()
    .add("base", T.LongType())
    .add("committed_at", T.TimestampType())
    .add("row_count", T.LongType())
    .add("schema", T.StringType())
    .add("details", T.MapType(T.StringType(), T.StringType()))
    .add("files", T.ArrayType(T.StringType()))
)
RECORD_KEY = "record"
# The kinds of change of a feed.
INSERT, DELETE = "insert", "delete"
BEFORE_UPDATE, AFTER_UPDATE = "update_preimage", "update_postimage"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def write_record(spark: SparkSession, location: str, key: int, schema: T.StructType, *values: Any) -> None:
    """Write or replace the one-row record of this key."""
    one_row(spark, schema, *values).write.mode("overwrite").parquet(f"{location}/{RECORD_KEY}={key}")


def read_records(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """All records with their key; none if nothing was written yet."""
    full = T.StructType([*schema, T.StructField(RECORD_KEY, T.LongType())])
    try:
        return spark.read.schema(full).parquet(location)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, full)


def recorded_keys(spark: SparkSession, location: str) -> list[int]:
    """Keys of all records, sorted, from the names of their files; none of them is opened."""
    try:
        names = spark.read.schema("base LONG").parquet(location).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({int(found) for name in names for found in re.findall(rf"/{RECORD_KEY}=(\d+)/", name)})


@dataclass(frozen=True)
class Commit:
    """What is recorded of one commit. ``base`` is the first version still part of the table."""

    version: int
    base: int
    row_count: int
    schema: T.StructType
    details: dict[str, str]

    @property
    def replaces(self) -> bool:
        """Whether nothing before this commit is part of the table any more."""
        return self.base == self.version

    @classmethod
    def of(cls, row: Row) -> Commit:
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        return cls(row[VERSION], row["base"], row["row_count"], schema, row["details"] or {})


class CommittedTable:
    """Versioned table: append with schema growth, replace, read, read what changed."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.location = location.rstrip("/")
        self.data = f"{self.location}/data"
        self.records = f"{self.location}/commits"
        self.taken = f"{self.location}/taken"  # source files of commits whose records are gone

    # -- what is there ---------------------------------------------------------------------------

    def log(self) -> DataFrame:
        """One row per commit."""
        return read_records(self.spark, self.records, RECORD).withColumnRenamed(RECORD_KEY, VERSION)

    def versions(self, first: int | None = None, last: int | None = None) -> list[int]:
        """Committed versions in the range given, both ends included."""
        known = recorded_keys(self.spark, self.records)
        return [v for v in known if (first is None or v >= first) and (last is None or v <= last)]

    def _commit(self, version: int) -> Commit:
        record = self.spark.read.schema(RECORD).parquet(f"{self.records}/{RECORD_KEY}={version}")
        row = record.select(F.lit(version).alias(VERSION), "base", "row_count", "schema", "details").first()
        return Commit.of(row)

    def latest(self, version: int | None = None) -> Commit | None:
        """The newest commit, or the newest one up to a version. One record is opened."""
        known = self.versions(last=version)
        return self._commit(known[-1]) if known else None

    def has(self, version: int) -> bool:
        found = self.latest(version)
        return found is not None and found.version == version

    def last_version(self) -> int:
        """The newest committed version, -1 for a table that does not exist yet."""
        found = self.latest()
        return found.version if found else NONE

    def schema(self) -> T.StructType:
        found = self.latest()
        return found.schema if found else T.StructType()

    def columns(self) -> list[str]:
        return self.schema().names

    def source_files(self) -> DataFrame:
        """Path and version of every source file committed so far, also by commits that were given up."""
        known = self.log().select(F.explode("files").alias("path"), VERSION)
        try:
            return known.unionByName(self.spark.read.schema(known.schema).parquet(self.taken).select(known.columns)).distinct()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return known

    # -- writing ---------------------------------------------------------------------------------

    def commit(
        self,
        df: DataFrame | Mapping[str, DataFrame],
        version: int | None = None,
        *,
        replace: bool = False,
        schema: T.StructType | None = None,
        files: Iterable[str] = (),
        details: Mapping[str, str] | None = None,
        after: Commit | None = None,
        accept: Callable[[], None] | None = None,
    ) -> Commit:
        """Store rows as one commit.

        The version defaults to the next one; a caller that may retry passes its own, such as a
        micro-batch id. ``after`` spares looking up the newest commit where the caller knows it. ``replace`` makes this commit the table's only content. Several frames may be
        given by partition directory (``{"data_source=batch": df}``); then the declared ``schema``
        names the partition column as well. ``accept`` is called when the data is written and before
        anything is visible, such as to look at what the write observed; if it raises, nothing ever is.
        """
        last = after or self.latest()
        if version is None:
            version = last.version + 1 if last else 0
        elif last and last.version >= version:
            # A retry is judged by what came before it.
            last = self.latest(version - 1)
        parts = df if isinstance(df, Mapping) else {"": df}
        stored = schema or next(iter(parts.values())).schema
        known = last.schema if last and not replace else T.StructType()
        table_schema = widened(known, stored)

        target = f"{self.data}/{VERSION}={version}"
        at = utc_now()
        for directory, frame in parts.items():
            path = f"{target}/{directory}" if directory else target
            frame.withColumn(COMMITTED_AT, F.lit(at)).write.mode("overwrite").parquet(path)
        if accept is not None:
            accept()
        # Counted from what was written: file footers only, and right whatever tasks were retried.
        rows = self.spark.read.schema(f"{COMMITTED_AT} TIMESTAMP").parquet(target).count()

        base = version if replace or not last else last.base
        details = dict(details or {})
        write_record(
            self.spark, self.records, version, RECORD, base, at, rows, table_schema.json(), details, list(files)
        )
        return Commit(version, base, rows, table_schema, details)

    # -- reading ---------------------------------------------------------------------------------

    def scan(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Rows of the commits first..last, both included, with their version and commit time."""
        known = self.versions(last=last)
        if not known:
            return no_rows(self.spark, _stored(T.StructType()))
        newest = self._commit(known[-1])
        low = max(first or 0, newest.base)
        return self._directories([v for v in known if v >= low], newest.schema)

    def _directories(self, versions: Sequence[int], schema: T.StructType) -> DataFrame:
        """Rows of just these commits. Only recorded directories are named, at any number of versions: what
        an attempt left that was given up is never read, and other versions are not listed."""
        full = _stored(schema)
        if not versions:
            return no_rows(self.spark, full)
        reader = self.spark.read.schema(full).option("basePath", self.data)
        return reader.parquet(*(f"{self.data}/{VERSION}={v}" for v in versions))

    def commits(self, versions: Sequence[int]) -> DataFrame:
        """Rows of just these commits."""
        return self._directories(sorted(versions), self.schema())

    def only(self, commit: Commit) -> DataFrame:
        """The rows of one commit, in the table's columns as of it."""
        reader = self.spark.read.schema(commit.schema).option("basePath", f"{self.data}/{VERSION}={commit.version}")
        return reader.parquet(f"{self.data}/{VERSION}={commit.version}")

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of its newest commit, or as of an older one."""
        return self.scan(last=version).drop(VERSION, COMMITTED_AT)

    def replaced_since(self, version: int) -> Commit | None:
        """The commit that replaced the table as of ``version``, if one has come since.

        Also where what was there then has been given up, or was never there.
        """
        newest = self.latest()
        return self._commit(newest.base) if newest and NONE < version < newest.base else None

    def changes(self, first: int, last: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
        """Change feed of the commits first..last: applied to the table as of ``first - 1`` it gives the one of ``last``.

        Appended rows are inserts of their own version. If the table was replaced in the range, all rows it
        had before the range are deletes, and those of the replacing commit inserts, under its version; what
        came and went within the range is left out. With ``keys`` the two are compared: equal rows are left out,
        and a row whose key was there before is an ``update_preimage`` and an ``update_postimage``. Without a
        replaced table no row is shuffled either way.
        """
        newest, held = self.latest(last), self.latest(first - 1)
        inserts = _as_feed(self.scan(first, last), INSERT)
        if newest is None or held is None or newest.base < first:
            return inserts
        schema = newest.schema
        gone = self.read(held.version)
        if not keys:
            deletes = self._marked(aligned(gone, widened_by(schema, gone.schema)), newest.base).withColumn(CHANGE_TYPE, F.lit(DELETE))
            return inserts.unionByName(deletes, allowMissingColumns=True)
        came = self.only(self._commit(newest.base))
        both = widened_by(schema, gone.schema)
        differ = keyed_changes(aligned(gone, both), aligned(came, both), keys)
        new, was = F.struct(F.lit(INSERT).alias(CHANGE_TYPE), "after.*"), F.struct(F.lit(DELETE).alias(CHANGE_TYPE), "before.*")
        pair = F.array(
            F.struct(F.lit(BEFORE_UPDATE).alias(CHANGE_TYPE), "before.*"), F.struct(F.lit(AFTER_UPDATE).alias(CHANGE_TYPE), "after.*")
        )
        kinds = F.when(F.col("op") == CREATED, F.array(new)).when(F.col("op") == DELETED, F.array(was)).otherwise(pair)
        replaced = self._marked(differ.select(F.inline(kinds)), newest.base)
        later = inserts.where(F.col(CHANGE_VERSION) > newest.base)
        return later.unionByName(replaced, allowMissingColumns=True)

    def _marked(self, rows: DataFrame, version: int) -> DataFrame:
        """Rows as part of the commit ``version``."""
        at = self.log().where(F.col(VERSION) == version).first()["committed_at"]
        return rows.withColumn(COMMITTED_AT, F.lit(at)).withColumn(CHANGE_VERSION, F.lit(version).cast("long"))

    # -- as an export target ---------------------------------------------------------------------

    def exported_through(self) -> int:
        return self.last_version()

    def append(self, df: DataFrame, through: int) -> int:
        """Store rows exported up to a version; repeating the export replaces them."""
        return self.commit(df, through).row_count

    def overwrite(self, df: DataFrame, through: int | None = None) -> int:
        """Replace the whole content in one switch; readers see the old or the new table.

        ``through`` is the version of the source that the content is, if that is known.
        """
        return self.commit(df, through, replace=True).row_count


def _as_feed(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumn(CHANGE_TYPE, F.lit(kind)).withColumnRenamed(VERSION, CHANGE_VERSION)


def widened_by(schema: T.StructType, other: T.StructType) -> T.StructType:
    """The schema's columns, and those that only the other one has, each with its own type."""
    return T.StructType([*schema, *(f for f in other if f.name not in schema.names)])


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [*schema, T.StructField(COMMITTED_AT, T.TimestampType()), T.StructField(VERSION, T.LongType())]
    )
