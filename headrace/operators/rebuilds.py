"""What a full merge changed, from the commits that only one of two snapshots holds.

Both snapshots were merged from ranges of commits. Commits in both give equal rows, so only the others
need to be looked at: appended commits are created rows as they are, and where the batch table was
replaced, its old and new rows are compared. The stream side takes no part, unless rows were not
served live.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from headrace.functions.columns import ID, aligned, common_columns, field, lowercase_columns, tagged
from headrace.operators.changelog import created, keyed_changes, row_changes
from headrace.operators.serving import BATCH, MERGED, STREAM, ServingTable
from headrace.sources.committed import NONE, Commit, CommittedTable

Range = tuple[int, int]  # base and newest version


def _differences(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keyed_changes(before, after, keys) if keys else row_changes(before, after)


def _common(snapshot: Commit) -> list[str]:
    return common_columns(*(json.loads(snapshot.details[f"{side}_columns"]) for side in (BATCH, STREAM)))


def merged_ranges(snapshot: Commit, tables: Mapping[str, CommittedTable]) -> dict[str, Range] | None:
    """The commits of each table that a snapshot was merged from; None if it was not these tables."""
    known = json.loads(snapshot.details.get(MERGED, "null"))
    if known is None or any(known[o][0] != tables[o].location for o in known):
        return None
    return {o: (known[o][1], known[o][2]) if o in known else (NONE, NONE) for o in tables}


def _still_there(table: CommittedTable, known: Range) -> bool:
    base, last = known
    return last == NONE or (table.has(base) and table.has(last))


def rebuild_changes(
    serving: ServingTable, snapshot: Commit, tables: Mapping[str, CommittedTable], keys: Sequence[str] = ()
) -> DataFrame:
    """``op, before, after`` between what was served before a snapshot and the snapshot, row ids aside.

    Without a replaced table no row is shuffled: every new row was created, whatever its key. Snapshots of
    other tables or columns, or of commits that have been given up, are compared as a whole.
    """
    schema = T.StructType([f for f in snapshot.schema if f.name != ID])
    previous = serving.snapshots.latest(snapshot.version - 1)
    after = serving.snapshots.only(snapshot).drop(ID)
    if previous is None:
        return created(after)
    old, new = merged_ranges(previous, tables), merged_ranges(snapshot, tables)
    comparable = (
        old is not None
        and new is not None
        and _common(previous) == _common(snapshot)
        and (old[STREAM][0] == new[STREAM][0] or old[STREAM][1] == NONE)
        and all(_still_there(tables[o], ranges[o]) for ranges in (old, new) for o in tables)
    )
    if not comparable:
        return _differences(aligned(serving.read_before(snapshot), schema), after, keys)

    def rows(origin: str, stored: DataFrame) -> DataFrame:
        narrow = lowercase_columns(stored)
        present = [name for name in _common(snapshot) if name in narrow.columns]
        text = narrow.select(*(field(name).cast("string").alias(name) for name in present))
        return aligned(tagged(text, present, origin), schema)

    batch, stream = tables[BATCH], tables[STREAM]
    if old[BATCH][0] in (new[BATCH][0], NONE):
        first = old[BATCH][1] + 1 if old[BATCH][1] != NONE else None
        changes = created(rows(BATCH, batch.scan(first, new[BATCH][1])))
    else:
        changes = _differences(rows(BATCH, batch.read(old[BATCH][1])), rows(BATCH, batch.read(new[BATCH][1])), keys)
    served = set(serving.live_versions(previous, new[STREAM][1]))
    silent = [v for v in stream.versions(old[STREAM][1] + 1, new[STREAM][1]) if v not in served]
    if silent:
        changes = changes.unionByName(created(rows(STREAM, stream.commits(silent))))
    return changes
