"""Relational tables over JDBC.

Connection settings, credentials included, come from the caller as options; none are kept in code.
A name may be qualified by its schema and quoted, as in SQL: ``taxi.trips``, ``"Taxi"."Trips"``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headrace.operators.numbering import number_rows
from headrace.sources.committed import NONE, CommittedTable

# How the snapshot load writes.
SNAPSHOT_WRITERS = 100
SNAPSHOT_BATCH = 1000
# Columns that name a row of a micro-batch, where the target has them.
BATCH_ID, BATCH_ROW = "batch_id", "batch_row"


def name_parts(table: str) -> list[tuple[str, bool]]:
    """The parts of a possibly qualified name, and whether each was quoted; a doubled quote stands for one."""
    found = re.findall(r'"((?:[^"]|"")*)"|([^".]+)', table)
    return [(quoted.replace('""', '"'), True) if not plain else (plain.strip(), False) for quoted, plain in found]


def _matches(column: str, name: str, quoted: bool) -> str:
    """A condition on a column of the database's metadata. Names without quotes are known in any case."""
    text = (name if quoted else name.lower()).replace("'", "''")
    return f"{column} = '{text}'" if quoted else f"lower({column}) = '{text}'"


class JdbcTable:
    """One table of a relational database, as source and as export target.

    ``progress`` records what was exported. Rows and record cannot be written in one transaction, so
    an append that fails half-way and is repeated may deliver rows twice (at least once).
    """

    def __init__(
        self,
        spark: SparkSession,
        options: Mapping[str, str],
        table: str,
        progress: CommittedTable | None = None,
    ):
        self.spark = spark
        self.options = {key: value for key, value in options.items() if key != "dbtable"}
        self.table = table
        self.progress = progress

    def _source(self):
        return self.spark.read.format("jdbc").options(**self.options)

    def _metadata(self, what: str) -> DataFrame:
        """What the database says of the table's columns, of the schema named or else the current one."""
        *schemas, table = name_parts(self.table)
        where = [_matches("table_name", *table)]
        where += [_matches("table_schema", *schemas[-1])] if schemas else ["table_schema = current_schema"]
        query = f"SELECT {what} FROM information_schema.columns WHERE {' AND '.join(where)}"
        return self._source().option("query", query).load()

    def exists(self) -> bool:
        """Whether the database lists the table. A failing connection is an error, not a no."""
        return not self._metadata("table_name").isEmpty()

    def columns(self) -> list[str]:
        """Column names from the database's own metadata."""
        rows = self._metadata("column_name, ordinal_position").collect()
        return [row[0] for row in sorted(rows, key=lambda row: row[1])]

    def read(self, split_on: str | None = None, bounds: tuple = (), partitions: int = 1) -> DataFrame:
        """The table; filters and column choice are pushed to the database.

        With a numeric or date column and its bounds it is read by that many tasks.
        """
        reader = self._source().option("dbtable", self.table)
        if split_on:
            low, high = bounds
            reader = reader.options(
                partitionColumn=split_on, lowerBound=low, upperBound=high, numPartitions=partitions
            )
        return reader.load()

    def exported_through(self) -> int:
        return self.progress.last_version() if self.progress else NONE

    def _write(self, df: DataFrame, mode: str, **options: str) -> int:
        """Write rows and count them in the same pass."""
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("jdbc")
        writer.options(**self.options, **options).option("dbtable", self.table).mode(mode).save()
        return seen.get["rows"]

    def append(self, df: DataFrame, through: int | None = None, writers: int | None = None) -> int:
        """Insert rows, by at most so many tasks at once, and record the version reached."""
        rows = self._write(df, "append", **({"numPartitions": str(writers)} if writers else {}))
        self._done(rows, through)
        return rows

    def _done(self, rows: int, through: int | None) -> None:
        if self.progress is not None and through is not None:
            done = self.spark.createDataFrame([(self.table, rows)], "target STRING, row_count LONG")
            self.progress.commit(done, through)

    def overwrite(
        self,
        df: DataFrame,
        through: int | None = None,
        writers: int = SNAPSHOT_WRITERS,
        batch: int = SNAPSHOT_BATCH,
        spread: bool = False,
        keep_definition: bool = True,
    ) -> int:
        """Replace all rows, and record the version they are.

        At most ``writers`` tasks write at once; more partitions than that are merged without a
        shuffle. ``spread`` shuffles a table of fewer partitions over all writers.
        ``keep_definition`` empties the table instead of dropping it, so types and indexes stay.
        """
        rows = self._write(
            df.repartition(writers) if spread else df,
            "overwrite",
            numPartitions=str(writers),
            batchsize=str(batch),
            truncate=str(keep_definition).lower(),
        )
        self._done(rows, through)
        return rows

    def append_batch(self, rows: DataFrame, batch_id: int, accept: Callable[[], None] | None = None) -> int:
        """Insert a micro-batch once, however often it is given; returns how many rows went out.

        Rows are staged as a commit beside ``progress`` first, and ``accept`` may still refuse them then. Columns
        that an existing table lacks are an error before a row is sent. A batch that ``progress`` knows is not
        sent again. If the table has the columns ``batch_id`` and ``batch_row``, rows are numbered within
        their batch, and of a batch that broke off on the way only the rows that did not arrive go out; without
        them such a batch is delivered from the start again (at least once).
        """
        if self.progress is None:
            raise ValueError("micro-batches need a progress table")
        if self.progress.has(batch_id):
            return 0
        stage = CommittedTable(self.spark, f"{self.progress.location}/staged")
        commit = stage.latest(batch_id)
        if commit is None or commit.version < batch_id:
            commit = stage.commit(rows, batch_id, accept=accept)
        staged = stage.only(commit)
        known = {name.lower() for name in self.columns()} if self.exists() else None
        if known is not None:
            missing = [name for name in staged.columns if name.lower() not in known]
            if missing:
                raise ValueError(f"{self.table} lacks the columns {', '.join(missing)}")
        if known is not None and {BATCH_ID, BATCH_ROW} <= known:
            numbered, _ = number_rows({"rows": staged})
            staged = numbered["rows"].toDF(BATCH_ROW, *staged.columns).withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
            arrived = self.read().where(F.col(BATCH_ID) == batch_id).select(F.col(BATCH_ROW).cast("long").alias(BATCH_ROW))
            staged = staged.join(arrived, BATCH_ROW, "left_anti")
        return self.append(staged, batch_id)

    def missing_columns(self, names: Sequence[str]) -> list[str]:
        """Names an append would need that the table lacks; Spark does not add columns over JDBC."""
        known = {name.lower() for name in self.columns()}
        return [name for name in names if name.lower() not in known]
