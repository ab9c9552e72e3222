"""Batch and stream in one serving table, kept current."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headrace.operators.changelog import as_messages
from headrace.operators.rebuilds import rebuild_changes
from headrace.operators.serving import BATCH, STREAM, SUCCESS, ServingTable
from headrace.sources.committed import VERSION, CommittedTable
from headrace.streaming.tables import StreamToTable, table_sink
from headrace.streaming.topics import run

PUBLISH = "publish"  # kept with a snapshot: the keys its changes are published by


class LambdaView:
    """The tables of one view under one folder: batch, stream, serving, rejects and changelogs."""

    def __init__(self, spark: SparkSession, location: str):
        self.location = location.rstrip("/")
        self.batch = CommittedTable(spark, f"{self.location}/batch")
        self.stream = CommittedTable(spark, f"{self.location}/stream")
        self.rejects = CommittedTable(spark, f"{self.location}/rejects")
        self.changelog = CommittedTable(spark, f"{self.location}/changelog")
        self.rebuild_changelog = CommittedTable(spark, f"{self.location}/rebuild_changelog")
        self.serving = ServingTable(spark, f"{self.location}/serving")

    def follow(self, messages: DataFrame, once: bool = False) -> StreamingQuery:
        """Copy arriving messages to the stream table, on to serving and into the changelog."""
        step = StreamToTable(
            self.stream, rejects=self.rejects, serving=self.serving, changelog=self.changelog
        )
        return run(table_sink(messages, step), f"{self.location}/checkpoint", once)

    def rebuild(self, keys: Sequence[str] | None = ()) -> DataFrame:
        """Full merge of what both tables hold now.

        The difference to the rows served before goes to ``rebuild_changelog`` under the snapshot's
        version: by business keys if they are given, row by row without them, not at all for None.
        What a rebuild that broke off has left out is made up for by the next one. Row ids restart
        with every merge, so they take no part in it. Only commits that are not in both are compared.
        """
        self._publish()
        notes = {} if keys is None else {PUBLISH: json.dumps(list(keys))}
        result = self.serving.merge(self.batch, self.stream, notes)
        if result.first()["status"] == SUCCESS:
            self._publish()
        return result

    def _publish(self) -> None:
        """Changes of all snapshots that are to be published and are not."""
        missing = self.serving.snapshots.log().where(
            (F.col(VERSION) > self.rebuild_changelog.last_version()) & F.col(f"details.{PUBLISH}").isNotNull()
        )
        for row in missing.select(VERSION).orderBy(VERSION).collect():
            snapshot = self.serving.snapshots.latest(row[VERSION])
            keys = json.loads(snapshot.details[PUBLISH])
            tables = {BATCH: self.batch, STREAM: self.stream}
            changes = rebuild_changes(self.serving, snapshot, tables, keys)
            self.rebuild_changelog.commit(as_messages(changes), snapshot.version)

    def read(self) -> DataFrame:
        return self.serving.read()
