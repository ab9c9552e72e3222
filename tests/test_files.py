import os
import time

import pytest
from pyspark.sql import functions as F

from headrace.plans.ingest import ingest, new_files
from headrace.sources import files, footers
from headrace.sources.committed import CommittedTable
from tests.conftest import rows


def add_file(df, folder, name):
    """One Parquet file of this name in a flat folder."""
    import glob
    import shutil

    staging = f"{folder}-staging-{name}"
    df.coalesce(1).write.mode("overwrite").parquet(staging)
    os.makedirs(folder, exist_ok=True)
    shutil.copy(glob.glob(f"{staging}/part-*.parquet")[0], f"{folder}/{name}.parquet")
    return f"{folder}/{name}.parquet"


def names(paths):
    return [path.rsplit("/", 1)[1] for path in paths]


def test_by_halves_isolates_what_fails():
    def attempt(group):
        if any(n in (3, 8) for n in group):
            raise RuntimeError("bad")
        return sum(group)

    out = files.by_halves(list(range(10)), attempt, lambda e: True)
    assert [g for g, r in out if isinstance(r, RuntimeError)] == [[3], [8]]
    assert sorted(n for g, _ in out for n in g) == list(range(10))
    assert files.by_halves([], attempt, lambda e: True) == []
    with pytest.raises(RuntimeError):
        files.by_halves([3], attempt, lambda e: False)


def test_only_matching_files_of_the_folder_itself(spark, place):
    folder = place()
    add_file(spark.range(1), folder, "b")
    add_file(spark.range(1), folder, "a")
    open(f"{folder}/notes.txt", "w").close()
    add_file(spark.range(1), f"{folder}/deeper", "c")
    assert sorted(names(r["path"] for r in files.list_files(spark, folder).collect())) == ["a.parquet", "b.parquet"]


def test_empty_folder_has_nothing_new(spark, place):
    folder = place()
    os.makedirs(folder)
    lake = CommittedTable(spark, place("lake"))
    done = ingest(spark, folder, lake)
    assert (done.version_before, done.version_after, done.files, done.has_new_data) == (-1, -1, [], False)


def test_new_files_come_in_path_order_once(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    add_file(spark.range(2), folder, "m2")
    add_file(spark.range(1), folder, "m1")
    assert names(new_files(spark, folder, lake)) == ["m1.parquet", "m2.parquet"]
    first = ingest(spark, folder, lake)
    assert first.has_new_data and names(first.files) == ["m1.parquet", "m2.parquet"]
    assert not ingest(spark, folder, lake).has_new_data
    add_file(spark.range(4), folder, "m0")
    again = ingest(spark, folder, lake)
    assert names(again.files) == ["m0.parquet"] and (again.version_before, again.version_after) == (0, 1)
    assert lake.read().count() == 7


def test_a_late_file_with_an_old_time_is_taken(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    add_file(spark.range(1), folder, "new")
    ingest(spark, folder, lake)
    old = add_file(spark.range(5), folder, "old")
    month_ago = time.time() - 30 * 86400
    os.utime(old, (month_ago, month_ago))
    assert names(ingest(spark, folder, lake).files) == ["old.parquet"]


def test_a_file_rewritten_at_its_path_is_not_read_again(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    add_file(spark.range(3), folder, "f")
    ingest(spark, folder, lake)
    add_file(spark.range(9), folder, "f")
    assert not ingest(spark, folder, lake).has_new_data
    assert lake.read().count() == 3


def test_one_version_per_file_on_request(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    for n in range(3):
        add_file(spark.range(n + 1), folder, f"f{n}")
    done = ingest(spark, folder, lake, files_per_commit=1)
    assert done.version_after == 2
    counts = {r["commit_version"]: r["row_count"] for r in lake.log().collect()}
    assert counts == {0: 1, 1: 2, 2: 3}


def test_files_whose_types_and_names_differ(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    frames = [
        spark.sql("SELECT 1L AS Key, 'a' AS Name"),
        spark.sql("SELECT 2L AS key, 'b' AS name"),
        spark.sql("SELECT 3.5D AS key, true AS flag"),
        spark.sql("SELECT DATE'2024-01-02' AS key"),
        spark.sql("SELECT 4L AS key, 'd' AS name"),
    ]
    for n, df in enumerate(frames):
        add_file(df, folder, f"f{n}")
    ingest(spark, folder, lake)
    assert rows(lake.read(), "key", "name", "flag") == [
        ("1", "a", None), ("2", "b", None), ("2024-01-02", None, None), ("3.5", None, "true"), ("4", "d", None),
    ]


def test_names_equal_after_lowering_are_an_error(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        add_file(spark.sql("SELECT 1 AS a, 2 AS A"), folder, "f")
        with pytest.raises(ValueError, match="differ only in case"):
            ingest(spark, folder, lake)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert lake.last_version() == -1


def test_a_broken_file_stops_the_run_and_stays_new(spark, place):
    folder, lake = place(), CommittedTable(spark, place("lake"))
    add_file(spark.range(3), folder, "a")
    with open(f"{folder}/b.parquet", "w") as out:
        out.write("this is not parquet")
    with pytest.raises(Exception):  # noqa: B017
        ingest(spark, folder, lake, files_per_commit=1)
    assert lake.read().count() == 3
    assert names(new_files(spark, folder, lake)) == ["b.parquet"]


def test_not_processed_is_by_full_path(spark):
    listing = spark.createDataFrame([("/a/x",), ("/b/x",), ("/a/y",)], "path STRING")
    processed = spark.createDataFrame([("/a/x",), ("/c/z",)], "path STRING")
    assert [r["path"] for r in files.not_processed(listing, processed).collect()] == ["/a/y", "/b/x"]


def test_read_table_merges_columns(spark, place):
    path = place()
    spark.range(1).withColumn("b", F.lit("x")).write.parquet(path)
    spark.range(1).withColumn("c", F.lit("y")).write.mode("append").parquet(path)
    assert sorted(files.read_table(spark, f"file://{path}").columns) == ["b", "c", "id"]
    csv = place()
    spark.range(2).write.option("header", True).csv(csv)
    assert files.read_table(spark, csv, "csv", header="true").count() == 2


def test_text_of_nested_values_depends_on_the_own_file_only(spark, place):
    folder = place()
    frames = {
        "narrow": spark.sql("SELECT named_struct('a', 1) AS s, array(named_struct('x', 1)) AS l"),
        "wide": spark.sql("SELECT named_struct('a', 1, 'b', 2) AS s, array(named_struct('x', 1, 'y', 2)) AS l"),
        "again": spark.sql("SELECT named_struct('a', 1) AS s, array(named_struct('x', 1)) AS l"),
        "flat": spark.sql("SELECT 7 AS s"),
    }
    paths = [add_file(df, folder, name) for name, df in frames.items()]
    alone = sorted((r["s"] for path in paths for r in files.read_as_text(spark, [path]).collect()), key=str)
    together = files.read_as_text(spark, paths)
    assert sorted((r["s"] for r in together.collect()), key=str) == alone == ["7", "{1, 2}", "{1}", "{1}"]
    assert sorted((r["l"] for r in together.collect()), key=lambda v: v or "") == [None, "[{1, 2}]", "[{1}]", "[{1}]"]


def test_footers_are_read_in_one_job(spark, place):
    folder = place()
    paths = [add_file(spark.range(n + 1).withColumn(f"c{n % 3}", F.lit(1)), folder, f"f{n:02}") for n in range(9)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        groups, errors = footers.by_schema(spark, paths)
    finally:
        spark.sparkContext.setJobGroup("none", "none")
    # one pass over all footers (dealt out first), and one footer for each distinct schema
    assert len(tracker.getJobIdsForGroup("footers")) <= 2 + len(groups)
    assert errors == {} and [len(g.files) for g in groups] == [3, 3, 3]
    assert {path: n for g in groups for path, n in g.files.items()} == {path: i + 1 for i, path in enumerate(paths)}
    assert [g.schema.names for g in groups] == [["id", f"c{n}"] for n in range(3)]


def test_footers_of_stores_that_only_spark_can_open(spark, place):
    folder = place()
    paths = [add_file(spark.range(2), folder, "a"), add_file(spark.range(3), folder, "b")]
    asked = [footers._asked(spark, path) for path in paths]
    assert len({row[1] for row in asked}) == 1 and [row[2] for row in asked] == [2, 3]
    assert footers._footer("nowhere://store/x") == ("nowhere://store/x", None, None, footers.UNREACHED)
    groups, errors = footers.by_schema(spark, [*paths, f"{folder}/gone.parquet", "nowhere://store/x"])
    assert [len(g.files) for g in groups] == [2] and len(errors) == 2
    assert "PATH_NOT_FOUND" in errors[f"{folder}/gone.parquet"]
    assert footers.by_schema(spark, []) == ([], {})
