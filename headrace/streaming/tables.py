"""Stream to table: decode, store, copy to serving and publish, once per micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import DataStreamWriter

from headrace.functions import envelope
from headrace.operators.changelog import as_messages, created
from headrace.operators.serving import ServingTable
from headrace.sources.committed import Commit, CommittedTable
from headrace.sources.relational import JdbcTable


SPELLINGS = "spellings"  # kept with a commit: names of the messages' fields as they were spelled so far


class Undeclared(Exception):
    """Messages declare fields that the write did not take up."""

    def __init__(self, names: list[str]):
        super().__init__(", ".join(names))
        self.names = names


class StreamToTable:
    """Insert every message's payload into a table that grows new columns as messages declare them.

    Each step stores under the micro-batch id and replaces what an interrupted attempt left, so a
    repeated micro-batch changes nothing. Messages are parsed once, by the write, with the names known from
    earlier commits; the write counts unreadable messages and notes names that are new. Only if there are new ones
    is the batch written again. Names that differ only in case are one column. Unreadable messages go
    to ``rejects``; without that table they stop the stream before any row is visible, so none is lost.

    ``table`` may be a relational table as well: it takes rows under the micro-batch id, does not grow, and
    says which columns it lacks before a row is written.
    """

    def __init__(
        self,
        table: CommittedTable | JdbcTable,
        *,
        rejects: CommittedTable | None = None,
        serving: ServingTable | None = None,
        changelog: CommittedTable | None = None,
        also: Callable[[DataFrame, int], None] | None = None,
    ):
        if isinstance(table, JdbcTable) and not (serving is changelog is also is None):
            raise ValueError("serving, changelog and further steps read the rows back, from a committed table")
        self.table = table
        self.rejects = rejects
        self.serving = serving
        self.changelog = changelog
        self.also = also

    def _spellings(self, messages: DataFrame) -> list[str]:
        """Names as spelled in earlier messages; in these ones, if there were none before."""
        last = self.table.latest() if isinstance(self.table, CommittedTable) else None
        known = json.loads(last.details.get(SPELLINGS, "[]")) if last else []
        return known or (last.schema.names if last else []) or envelope.survey(messages)[0]

    def _stored(self, messages: DataFrame, batch_id: int, spellings: list[str]) -> tuple[Commit | None, int | None]:
        """The commit of a micro-batch, and how many messages could not be read, if they were parsed now."""
        seen, found = Observation(), {}

        def accept() -> None:
            found.update(seen.get)
            names = sorted({name for names in found["undeclared"] for name in names})
            if names:
                raise Undeclared(names)
            if self.rejects is None and found["unreadable"]:
                raise ValueError("unreadable messages, and no table is given to set them aside in")

        rows = envelope.decode_observed(messages, spellings, seen)
        commit = None
        try:
            if isinstance(self.table, JdbcTable):
                self.table.append_batch(rows, batch_id, accept)  # an earlier attempt may have staged them
            else:
                commit = self.table.commit(rows, batch_id, details={SPELLINGS: json.dumps(spellings)}, accept=accept)
        except Undeclared as more:
            return self._stored(messages, batch_id, [*spellings, *more.names])
        return commit, found.get("unreadable")

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        stored, unreadable = self._stored(messages, batch_id, self._spellings(messages))
        if unreadable or (unreadable is None and self.rejects is not None):
            self.rejects.commit(envelope.rejects(messages), batch_id)
        if self.serving is not None:
            added = self.serving.append_stream(self.table, stored)
            # Events that are out already stay when a merge has taken up their rows since.
            published = self.changelog is not None and self.serving.reaches(stored) and self.changelog.has(batch_id)
            if self.changelog is not None and not published:
                self.changelog.commit(as_messages(created(added)), batch_id)
        if self.also is not None:
            self.also(self.table.only(stored), batch_id)


def table_sink(messages: DataFrame, step: StreamToTable) -> DataStreamWriter:
    return messages.writeStream.foreachBatch(step)
