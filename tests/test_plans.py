import os

import pytest

from headrace.operators.mirror import mirror_files
from headrace.plans.daily import mirror_pending, run_daily
from headrace.plans.export import export_changes, full_reload, pending_range
from headrace.plans.ingest import ingest
from headrace.sources import catalog
from headrace.sources.committed import CommittedTable
from tests.conftest import rows
from tests.test_files import add_file


def tables(spark, place):
    return CommittedTable(spark, place("lake")), CommittedTable(spark, place("target"))


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a STRING")


def test_first_export_takes_everything_then_only_what_is_new(spark, place):
    lake, target = tables(spark, place)
    assert export_changes(lake, target) is None
    lake.commit(text(spark, "1"))
    first = export_changes(lake, target)
    assert (first.first, first.last, first.rows) == (0, 0, 1)
    assert export_changes(lake, target) is None and pending_range(lake, target.exported_through()) is None
    lake.commit(text(spark, "2"))
    lake.commit(text(spark, "3", "4"))
    second = export_changes(lake, target)
    assert (second.first, second.last, second.rows) == (1, 2, 3)
    assert rows(target.read()) == [("1",), ("2",), ("3",), ("4",)]
    assert target.columns() == ["a"]


def test_rows_of_a_failed_export_go_out_with_the_next(spark, place):
    lake, target = tables(spark, place)
    lake.commit(text(spark, "1"))
    failing = CommittedTable(spark, target.location)

    def refuse(*_):
        raise RuntimeError("database down")

    failing.append = refuse
    with pytest.raises(RuntimeError):
        export_changes(lake, failing)
    lake.commit(text(spark, "2"))
    assert export_changes(lake, target).rows == 2
    assert rows(target.read()) == [("1",), ("2",)]


def test_an_export_repeated_after_a_crash_adds_nothing(spark, place):
    lake, target = tables(spark, place)
    lake.commit(text(spark, "1"))
    export_changes(lake, target)
    target.append(lake.changes(0, 0).select("a"), 0)
    assert rows(target.read()) == [("1",)]


def test_full_reload_replaces(spark, place):
    lake, target = tables(spark, place)
    lake.commit(text(spark, "1", "2"))
    export_changes(lake, target)
    assert full_reload(text(spark, "9"), target) == 1
    assert rows(target.read()) == [("9",)]


def mixed_folder(spark, place):
    folder = place("source")
    paths = [
        add_file(spark.sql("SELECT 1L AS A, 'x' AS b"), folder, "one"),
        add_file(spark.range(5), folder, "two"),
        add_file(spark.range(7), folder, "three"),
    ]
    return folder, [f"file:{path}" for path in paths]


def test_mirror_keeps_each_files_own_columns_and_types(spark, place):
    _, paths = mixed_folder(spark, place)
    out = place("mirror")
    report = mirror_files(spark, paths, out)
    assert rows(report, "source_file", "status", "row_count") == [
        ("one.parquet", "ok", 1), ("three.parquet", "ok", 7), ("two.parquet", "ok", 5),
    ]
    assert spark.read.parquet(f"{out}/source_file=one.parquet").dtypes == [("A", "bigint"), ("b", "string")]
    assert spark.read.parquet(f"{out}/source_file=two.parquet").dtypes == [("id", "bigint")]


def test_mirror_replaces_an_older_copy_and_leaves_the_others(spark, place):
    folder, paths = mixed_folder(spark, place)
    out = place("mirror")
    mirror_files(spark, paths, out)
    add_file(spark.range(2), folder, "two")
    assert rows(mirror_files(spark, paths[1:2], out), "row_count") == [(2,)]
    assert spark.read.parquet(f"{out}/source_file=two.parquet").count() == 2
    assert spark.read.parquet(f"{out}/source_file=three.parquet").count() == 7


def test_mirror_reports_missing_and_broken_files(spark, place):
    folder, paths = mixed_folder(spark, place)
    with open(f"{folder}/broken.parquet", "w") as broken:
        broken.write("not parquet")
    asked = [*paths, f"file:{folder}/broken.parquet", f"file:{folder}/gone.parquet"]
    report = rows(mirror_files(spark, asked, place("mirror")), "source_file", "status", "row_count")
    assert report == [
        ("broken.parquet", "failed", 0), ("gone.parquet", "missing", 0), ("one.parquet", "ok", 1),
        ("three.parquet", "ok", 7), ("two.parquet", "ok", 5),
    ]


def test_mirror_finds_the_file_whose_rows_cannot_be_read(spark, place):
    """Footers in order, one data page damaged: only that file fails."""
    folder = place("source")
    paths = [add_file(spark.range(1000 * (n + 1)), folder, f"f{n}") for n in range(4)]
    with open(paths[2], "r+b") as damaged:
        damaged.seek(8)
        damaged.write(os.urandom(400))
    report = mirror_files(spark, [f"file:{path}" for path in paths], place("mirror"))
    assert rows(report, "source_file", "status", "row_count") == [
        ("f0.parquet", "ok", 1000), ("f1.parquet", "ok", 2000), ("f2.parquet", "failed", 0), ("f3.parquet", "ok", 4000),
    ]


def test_daily_chain(spark, place):
    lake, target = tables(spark, place)
    mirrored, out = CommittedTable(spark, place("log")), place("mirror")
    folder, _ = mixed_folder(spark, place)

    def run():
        return tuple(run_daily(spark, folder, lake, mirrored, out, target).first())

    assert run() == (3, -1, 0, 3, 0, 13)
    assert run() == (0, 0, 0, 0, 0, 0)
    add_file(spark.range(4), folder, "four")
    assert run() == (1, 0, 1, 1, 0, 4)
    assert target.read().count() == 17


def test_a_file_not_mirrored_stays_pending(spark, place):
    lake, target = tables(spark, place)
    mirrored, out = CommittedTable(spark, place("log")), place("mirror")
    folder, _ = mixed_folder(spark, place)
    ingest(spark, folder, lake)
    os.rename(f"{folder}/two.parquet", f"{folder}/two.away")
    assert tuple(run_daily(spark, folder, lake, mirrored, out, target).first())[3:5] == (2, 1)
    os.rename(f"{folder}/two.away", f"{folder}/two.parquet")
    assert tuple(run_daily(spark, folder, lake, mirrored, out, target).first())[3:5] == (1, 0)


def test_a_failing_step_ends_the_run_and_the_next_makes_up_for_it(spark, place):
    lake, target = tables(spark, place)
    mirrored, out = CommittedTable(spark, place("log")), place("mirror")
    folder, _ = mixed_folder(spark, place)
    failing = CommittedTable(spark, target.location)
    failing.exported_through = lambda: 1 / 0
    with pytest.raises(ZeroDivisionError):
        run_daily(spark, folder, lake, mirrored, out, failing)
    assert tuple(run_daily(spark, folder, lake, mirrored, out, target).first()) == (0, 0, 0, 0, 0, 13)


def test_sql_over_named_sources(spark, place):
    lake, relational = tables(spark, place)
    lake.commit(text(spark, "1", "2"))
    relational.commit(spark.createDataFrame([("2", "two")], "a STRING, name STRING"))
    catalog.register(spark, {"lake_t": lake.read()})
    out = catalog.query(
        spark, "SELECT name FROM lake_t JOIN rel_t USING (a)", {"rel_t": relational.read()}
    )
    assert rows(out) == [("two",)]


def test_names_with_blanks_and_signs(spark, place):
    folder = place("source")
    paths = [add_file(spark.range(n + 1), folder, name) for n, name in enumerate(["a b", "c=d", "e%20f", "g+h"])]
    lake, target = tables(spark, place)
    summary = run_daily(spark, folder, lake, CommittedTable(spark, place("log")), place("mirror"), target)
    assert tuple(summary.first()) == (4, -1, 0, 4, 0, 10)
    out = place("mirror")
    report = mirror_files(spark, [f"file:{path}" for path in paths], out)
    assert rows(report, "source_file", "row_count") == [
        ("a b.parquet", 1), ("c=d.parquet", 2), ("e%20f.parquet", 3), ("g+h.parquet", 4),
    ]
    assert spark.read.parquet(out).count() == 10


def test_a_later_file_of_a_name_replaces_the_earlier(spark, place):
    one, two = place("x"), place("y")
    paths = [f"file:{add_file(spark.range(n), folder, 'm')}" for folder, n in ((one, 3), (two, 2))]
    out = place("mirror")
    assert rows(mirror_files(spark, paths, out), "path", "status", "row_count") == sorted(
        [(paths[0], "ok", 3), (paths[1], "ok", 2)]
    )
    assert spark.read.parquet(f"{out}/source_file=m.parquet").count() == 2
    mirror_files(spark, paths[::-1], out)
    assert spark.read.parquet(f"{out}/source_file=m.parquet").count() == 3
    empty = f"file:{add_file(spark.range(0), place('z'), 'm')}"
    assert rows(mirror_files(spark, [*paths, empty], out), "row_count") == [(0,), (2,), (3,)]
    assert spark.read.parquet(f"{out}/source_file=m.parquet").count() == 0


def test_an_earlier_file_stays_where_the_later_cannot_be_copied(spark, place):
    paths = [add_file(spark.range(1000), place(f"f{n}"), "m") for n in range(2)]
    with open(paths[1], "r+b") as damaged:
        damaged.seek(8)
        damaged.write(os.urandom(400))
    out = place("mirror")
    report = mirror_files(spark, [f"file:{path}" for path in paths], out)
    assert sorted(rows(report, "status", "row_count")) == [("failed", 0), ("ok", 1000)]
    assert spark.read.parquet(f"{out}/source_file=m.parquet").count() == 1000


def test_a_folder_that_is_gone_is_missing_not_an_error(spark, place):
    folder, paths = mixed_folder(spark, place)
    gone = f"file:{folder}-gone/one.parquet"
    report = rows(mirror_files(spark, [*paths, gone], place("mirror")), "path", "status")
    assert dict(report) == {**dict.fromkeys(paths, "ok"), gone: "missing"}


def test_later_deliveries_of_a_name_win_in_the_daily_chain(spark, place):
    lake, target = tables(spark, place)
    mirrored, out = CommittedTable(spark, place("log")), place("mirror")
    first, second = place("b"), place("a")  # path order is not the order of arrival
    add_file(spark.range(3), first, "m")
    add_file(spark.range(5), second, "m")
    ingest(spark, first, lake)
    ingest(spark, second, lake)
    assert rows(mirror_pending(spark, lake, mirrored, out), "row_count") == [(3,), (5,)]
    assert spark.read.parquet(f"{out}/source_file=m.parquet").count() == 5


def test_an_export_over_a_replace_equals_the_table(spark, place):
    lake, target = tables(spark, place)
    lake.commit(text(spark, "1", "2"))
    assert export_changes(lake, target).rows == 2
    lake.overwrite(text(spark, "2"))
    assert export_changes(lake, target).rows == 1
    assert rows(target.read()) == rows(lake.read()) == [("2",)]
    assert export_changes(lake, target) is None
    lake.commit(text(spark, "3"))
    lake.overwrite(text(spark, "8"))
    lake.commit(text(spark, "9"))
    assert (export_changes(lake, target).rows, rows(target.read())) == (2, [("8",), ("9",)])
    lake.commit(text(spark, "10"))
    assert (export_changes(lake, target).rows, rows(target.read())) == (1, [("10",), ("8",), ("9",)])


def test_an_export_goes_on_from_a_full_reload(spark, place):
    lake, target = tables(spark, place)
    for value in "123":
        lake.commit(text(spark, value))
    full_reload(lake.read(), target, through=lake.last_version())
    lake.commit(text(spark, "4"))
    assert export_changes(lake, target).rows == 1
    assert rows(target.read()) == [("1",), ("2",), ("3",), ("4",)]
