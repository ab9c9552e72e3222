"""Lake rows out to a relational table: only what is new, or everything."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from headrace.operators.changefeed import exportable
from headrace.sources.committed import CommittedTable
from headrace.sources.relational import JdbcTable


@dataclass
class Exported:
    first: int
    last: int
    rows: int


def pending_range(lake: CommittedTable, exported_through: int) -> tuple[int, int] | None:
    """Versions committed but not yet exported, both ends included; none if all are."""
    last = lake.last_version()
    return (exported_through + 1, last) if last > exported_through else None


def export_changes(lake: CommittedTable, target: CommittedTable | JdbcTable) -> Exported | None:
    """Bring the target up to the lake's newest version; None if it is there already.

    Rows of versions it has not seen are appended. If the lake table was replaced since, what the target
    holds is no longer part of it, and an append could not take that back: the target is replaced too.
    The range comes from the target's own record, so a failed run is made up for by the next one.
    """
    seen = target.exported_through()
    versions = pending_range(lake, seen)
    if versions is None:
        return None
    if lake.replaced_since(seen) is not None:
        return Exported(*versions, target.overwrite(lake.read(versions[1]), through=versions[1]))
    return Exported(*versions, target.append(exportable(lake.changes(*versions)), versions[1]))


def full_reload(table: DataFrame, target: CommittedTable | JdbcTable, through: int | None = None) -> int:
    """Replace the target's content with a whole table and return its row count.

    ``through`` is the lake version the table is, so that the next export goes on from there.
    """
    return target.overwrite(table, through=through)
