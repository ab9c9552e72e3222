import glob
import shutil

import pytest
from pyspark.sql import functions as F

from headrace.sources.committed import CommittedTable
from tests.conftest import rows


def frame(spark, *pairs, columns="a STRING, b STRING"):
    return spark.createDataFrame(list(pairs), columns)


def test_absent_table(spark, place):
    table = CommittedTable(spark, place())
    assert table.last_version() == -1 and table.columns() == [] and table.latest() is None
    assert table.read().collect() == [] and table.changes(0).collect() == []
    assert table.source_files().collect() == []


def test_append_grows_columns_and_keeps_old_rows(spark, place):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x")))
    table.commit(frame(spark, ("2", "y"), columns="a STRING, c STRING"))
    assert rows(table.read(), "a", "b", "c") == [("1", "x", None), ("2", None, "y")]
    assert table.read(0).columns == ["a", "b"] and rows(table.read(0)) == [("1", "x")]


def test_changes_are_inclusive_and_marked(spark, place):
    table = CommittedTable(spark, place())
    for n in range(4):
        table.commit(frame(spark, (str(n), "v")))
    feed = table.changes(1, 2)
    assert rows(feed, "a", "_change_type", "_commit_version") == [("1", "insert", 1), ("2", "insert", 2)]
    assert dict(feed.dtypes)["_commit_timestamp"] == "timestamp"
    assert len(rows(table.changes(0))) == 4
    assert rows(table.changes(4)) == [] and table.changes(4).columns == feed.columns
    stamps = {r["committed_at"] for r in table.log().collect()}
    assert {r["_commit_timestamp"] for r in table.changes(0).collect()} == stamps


def test_a_range_lists_only_its_own_directories(spark, place):
    table = CommittedTable(spark, place())
    for n in range(4):
        table.commit(frame(spark, (str(n), "v")))
    assert {path.split("commit_version=")[1][0] for path in table.scan(1, 2).inputFiles()} == {"1", "2"}


@pytest.mark.parametrize("versions", [2, 12])
def test_an_abandoned_attempt_is_never_read(spark, place, versions):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("0", "v")))
    # the export of version 1 breaks off after its data; the next export goes on with version 2
    table.commit(frame(spark, ("lost", "v")), 1)
    shutil.rmtree(glob.glob(f"{table.records}/*=1")[0])
    for n in range(2, versions + 2):
        table.append(frame(spark, (str(n), "v")), n)
    assert sorted(int(r["a"]) for r in table.read().collect()) == [0, *range(2, versions + 2)]
    assert sorted(int(r["a"]) for r in table.changes(0, 2).collect()) == [0, 2]


def test_retry_replaces_the_same_commit(spark, place):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x")), 0)
    table.commit(frame(spark, ("2", "y")), 1)
    table.commit(frame(spark, ("2", "z"), ("3", "z")), 1)
    assert rows(table.read()) == [("1", "x"), ("2", "z"), ("3", "z")]
    assert table.log().count() == 2


def test_data_without_a_record_is_not_seen_and_is_replaced(spark, place):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x")))
    frame(spark, ("half", "written")).withColumn("_commit_timestamp", F.current_timestamp()).write.parquet(
        f"{table.data}/commit_version=1"
    )
    assert rows(table.read()) == [("1", "x")] and table.last_version() == 0
    table.commit(frame(spark, ("2", "y")))
    assert rows(table.read()) == [("1", "x"), ("2", "y")]


def test_replace_switches_content_and_schema(spark, place):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x")))
    before = table.read()
    assert table.overwrite(frame(spark, ("9", 9), columns="a STRING, n LONG")) == 1
    assert rows(table.read()) == [("9", 9)] and table.columns() == ["a", "n"]
    assert rows(before) == [("1", "x")], "a reader that started earlier still finds its rows"
    table.commit(frame(spark, ("10", 10), columns="a STRING, n LONG"))
    assert rows(table.read(), "a") == [("10",), ("9",)]
    assert rows(table.changes(0), "a") == [("10",), ("9",)], "replaced commits are no longer part of the feed"


def test_gaps_in_versions(spark, place):
    table = CommittedTable(spark, place())
    for version in (2, 5, 9):
        table.commit(frame(spark, (str(version), "v")), version)
    assert rows(table.read(), "a") == [("2",), ("5",), ("9",)]
    assert rows(table.changes(3, 8), "a") == [("5",)]
    assert rows(table.changes(6, 8), "a") == []


def test_type_change_is_refused_before_anything_is_written(spark, place):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x")))
    with pytest.raises(ValueError, match="changes type"):
        table.commit(frame(spark, (1, "x"), columns="a LONG, b STRING"))
    assert table.last_version() == 0


def test_empty_commit(spark, place):
    table = CommittedTable(spark, place())
    commit = table.commit(frame(spark))
    assert commit.row_count == 0 and rows(table.read()) == []


def test_parts_become_partitions(spark, place):
    table = CommittedTable(spark, place())
    one = frame(spark, ("1",), columns="a STRING")
    schema = frame(spark, columns="a STRING, s STRING").schema
    commit = table.commit({"s=x": one, "s=y": one}, schema=schema)
    assert commit.row_count == 2
    assert rows(table.read(), "a", "s") == [("1", "x"), ("1", "y")]
    assert rows(table.only(commit), "a", "s") == [("1", "x"), ("1", "y")]
    plan = table.read().where("s = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(s" in plan


def test_the_newest_record_alone_is_opened(spark, place, monkeypatch):
    table = CommittedTable(spark, place())
    for n in range(5):
        table.commit(frame(spark, (str(n), "v")))
    opened = []
    one = CommittedTable._commit
    monkeypatch.setattr(CommittedTable, "_commit", lambda self, v: opened.append(v) or one(self, v))
    monkeypatch.setattr(CommittedTable, "log", lambda self: pytest.fail("all records are read"))
    assert table.latest().version == 4 and table.latest(2).version == 2 and opened == [4, 2]
    assert table.versions() == [0, 1, 2, 3, 4] and table.versions(1, 3) == [1, 2, 3]
    assert table.read().count() == 5 and opened == [4, 2, 4]


def test_what_a_write_observed_can_stop_the_commit(spark, place):
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x")))

    def refuse():
        raise ValueError("not these")

    with pytest.raises(ValueError, match="not these"):
        table.commit(frame(spark, ("2", "y")), accept=refuse)
    assert rows(table.read()) == [("1", "x")] and table.last_version() == 0
    table.commit(frame(spark, ("3", "z")), accept=lambda: None)
    assert rows(table.read()) == [("1", "x"), ("3", "z")]


def replaced(spark, place):
    """Versions 0 and 1 appended, 2 replaces both, 3 appended, 4 replaces again, 5 appended."""
    table = CommittedTable(spark, place())
    table.commit(frame(spark, ("1", "x"), ("2", "x")))
    table.commit(frame(spark, ("3", "x")))
    table.commit(frame(spark, ("2", "x"), ("3", "new"), columns="a STRING, b STRING"), replace=True)
    table.commit(frame(spark, ("4", "x")))
    table.commit(frame(spark, ("2", "x"), ("4", "new"), ("5", "x")), replace=True)
    table.commit(frame(spark, ("6", "x")))
    return table


def test_a_feed_over_a_replace_tells_what_went(spark, place):
    table = replaced(spark, place)
    feed = rows(table.changes(1, 2), "_change_type", "a", "b", "_commit_version")
    assert feed == [("delete", "1", "x", 2), ("delete", "2", "x", 2), ("insert", "2", "x", 2), ("insert", "3", "new", 2)]
    keyed = rows(table.changes(2, 3, keys=["a"]), "_change_type", "a", "b", "_commit_version")
    assert keyed == [
        ("delete", "1", "x", 2), ("insert", "4", "x", 3), ("update_postimage", "3", "new", 2), ("update_preimage", "3", "x", 2),
    ]
    assert rows(table.changes(1, 1), "_change_type", "a") == [("insert", "3")]
    stamps = {r["commit_version"]: r["committed_at"] for r in table.log().collect()}
    assert {r["_commit_timestamp"] for r in table.changes(1, 2).collect()} == {stamps[2]}


@pytest.mark.parametrize("keys", [(), ("a",)])
def test_a_feed_applied_gives_the_table(spark, place, keys):
    table = replaced(spark, place)
    for first in range(7):
        for last in range(first, 6):
            have = [tuple(r) for r in table.read(first - 1).collect()] if first else []
            for r in table.changes(first, last, keys).orderBy("_commit_version").collect():
                row = (r["a"], r["b"])
                have.remove(row) if r["_change_type"] in ("delete", "update_preimage") else have.append(row)
            assert sorted(have) == rows(table.read(last))


def test_a_feed_without_a_replace_moves_no_rows(spark, place):
    table = CommittedTable(spark, place())
    for n in range(3):
        table.commit(frame(spark, (str(n), "v")))
    assert "Exchange" not in table.changes(1, 2, keys=["a"])._jdf.queryExecution().executedPlan().toString()
