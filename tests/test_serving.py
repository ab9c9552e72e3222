from decimal import Decimal

import pytest

from headrace.functions.columns import normalise
from headrace.operators import serving
from headrace.operators.serving import ServingTable
from headrace.sources.committed import CommittedTable
from tests.conftest import rows

BATCH = [(10, "k1", "b1", 1.5), (11, "k2", "b2", 2.5), (12, "k3", None, None)]
STREAM = [("90", "k4", "s4"), ("91", "k5", None)]


def batch(spark, content=BATCH):
    return spark.createDataFrame(content, "Id INT, Key STRING, Only_Batch STRING, Fare DOUBLE")


def stream(spark, content=STREAM):
    return spark.createDataFrame(content, "id STRING, key STRING, only_stream STRING")


def test_merge_keeps_common_columns_and_nulls_the_rest(spark, place):
    table = ServingTable(spark, place())
    result = table.merge(batch(spark), stream(spark)).first()
    assert tuple(result)[:4] == ("SUCCESS", 3, 2, 5) and result["exec_time"] >= 0
    out = table.read()
    assert out.columns == ["id", "fare", "key", "only_batch", "only_stream", "data_source"]
    assert rows(out.drop("id")) == sorted(
        [(None, k, None, None, "batch") for k in ("k1", "k2", "k3")]
        + [(None, k, None, None, "stream") for k in ("k4", "k5")],
        key=repr,
    )
    assert {t for n, t in out.dtypes if n != "id"} == {"string"}


def test_ids_are_dense_batch_first_and_restart(spark, place):
    table = ServingTable(spark, place())
    for _ in range(2):
        table.merge(batch(spark), stream(spark))
        ids = {r["data_source"]: [] for r in table.read().collect()}
        for r in table.read().collect():
            ids[r["data_source"]].append(r["id"])
        assert sorted(ids["batch"]) == [1, 2, 3] and sorted(ids["stream"]) == [4, 5]


def test_the_unstored_view_has_the_same_rows(spark, place):
    table = ServingTable(spark, place())
    table.merge(batch(spark), stream(spark))
    assert rows(serving.merged_rows(batch(spark), stream(spark))) == rows(table.read().drop("id"))


def test_log_has_a_row_per_run(spark, place):
    table = ServingTable(spark, place())
    assert table.merge_log().collect() == []
    table.merge(batch(spark), stream(spark))
    table.merge(batch(spark), spark.createDataFrame([("x",)], "other STRING"))
    log = sorted(table.merge_log().collect(), key=lambda r: r["id"])
    assert [r["id"] for r in log] == [1, 2]
    assert tuple(log[0])[2:5] == (3, 2, 5) and log[0]["status"] == "SUCCESS"
    assert isinstance(log[0]["execution_seconds"], Decimal) and log[0]["run_time"] is not None
    assert tuple(log[1])[2:6] == (None, None, None, None) and log[1]["run_time"] is not None
    assert dict(table.merge_log().dtypes)["execution_seconds"] == "decimal(10,2)"


def test_a_failed_merge_says_so_and_keeps_the_old_rows(spark, place):
    table = ServingTable(spark, place())
    table.merge(batch(spark), stream(spark))
    before = rows(table.read())
    nothing_shared = spark.createDataFrame([("1", "z")], "id STRING, other STRING")
    failed = table.merge(batch(spark), nothing_shared).first()
    assert tuple(failed) == ("FAILED: no common columns", 0, 0, 0, Decimal("0.00"))
    breaking = stream(spark).selectExpr("id", "CASE WHEN key = 'k5' THEN raise_error('lost') ELSE key END AS key")
    failed = table.merge(batch(spark), breaking).first()
    assert failed["status"].startswith("FAILED: ") and "lost" in failed["status"]
    assert rows(table.read()) == before


def test_names_equal_but_for_case_are_common(spark, place):
    table = ServingTable(spark, place())
    upper = spark.createDataFrame([("1", "v")], "ID STRING, KEY STRING")
    assert table.merge(upper, stream(spark)).first()["status"] == "SUCCESS"
    assert rows(table.read(), "key") == [("k4",), ("k5",), ("v",)]


def test_create_gives_an_empty_table(spark, place):
    table = ServingTable(spark, place())
    table.create(["Id", "B", "a"], ["id", "a", "c"])
    assert table.read().columns == ["id", "a", "b", "c", "data_source"] and table.read().count() == 0


def committed(spark, path, *frames):
    table = CommittedTable(spark, path)
    for df in frames:
        table.commit(df)
    return table


def text(df):
    # one file, so that rows keep their order and ids can be named
    return normalise(df).coalesce(1)


def test_stream_commits_follow_the_snapshot(spark, place):
    table = ServingTable(spark, place())
    history = committed(spark, place(), text(batch(spark)))
    arriving = committed(spark, place(), text(stream(spark)))
    table.create(history.columns(), arriving.columns())
    table.merge(history, arriving)
    assert rows(table.read(), "id", "key")[-1] == (5, "k5")

    added = table.append_stream(arriving, arriving.commit(text(stream(spark, [("1", "k6", "s"), ("2", "k7", "s")]))))
    assert rows(added, "id", "key", "only_stream", "data_source") == [
        (6, "k6", None, "stream"), (7, "k7", None, "stream"),
    ]
    later = arriving.commit(text(stream(spark, [("3", "k8", "s")])))
    table.append_stream(arriving, later)
    table.append_stream(arriving, later)  # an interrupted micro-batch comes again
    assert [(r["id"], r["key"]) for r in table.read().orderBy("id").collect()][5:] == [
        (6, "k6"), (7, "k7"), (8, "k8"),
    ]

    result = table.merge(history, arriving).first()
    assert tuple(result)[:4] == ("SUCCESS", 3, 5, 8)
    assert sorted(r["id"] for r in table.read().collect()) == list(range(1, 9))
    assert rows(table.read(), "key") == [(f"k{n}",) for n in range(1, 9)]


def test_a_commit_between_reading_and_switching_is_not_lost(spark, place):
    """A merge that reached commit 0 only must leave commit 1 visible through the live part."""
    table = ServingTable(spark, place())
    history = committed(spark, place(), text(batch(spark)))
    arriving = committed(spark, place(), text(stream(spark)))
    table.create(history.columns(), arriving.columns())
    table.append_stream(arriving, arriving.latest())
    old = CommittedTable(spark, arriving.location)
    old.latest = lambda version=None: CommittedTable.latest(old, 0)
    table.append_stream(arriving, arriving.commit(text(stream(spark, [("5", "k9", "s")]))))
    table.merge(history, old)
    assert rows(table.read(), "id", "key") == [(1, "k1"), (2, "k2"), (3, "k3"), (4, "k4"), (5, "k5"), (6, "k9")]


def test_append_needs_a_serving_table(spark, place):
    arriving = committed(spark, place(), text(stream(spark)))
    with pytest.raises(ValueError, match="create or merge"):
        ServingTable(spark, place()).append_stream(arriving, arriving.latest())


def test_domain_violations(spark):
    df = spark.createDataFrame([("batch",), ("stream",), ("other",), (None,)], "data_source STRING")
    assert rows(serving.domain_violations(df)) == [("other",)]


def test_origin_filter_reads_one_partition(spark, place):
    table = ServingTable(spark, place())
    table.merge(batch(spark), stream(spark))
    plan = table.read().where("data_source = 'stream'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_source" in plan


def test_rows_of_another_origin_never_become_visible(spark, place):
    table, aside = ServingTable(spark, place()), CommittedTable(spark, place())
    columns = "data_source STRING, k STRING, id STRING"
    good = [("batch", "1", "7"), ("stream", "2", "8"), (None, "3", "9")]
    given = spark.createDataFrame([*good, ("other", "4", "1"), ("", "5", "1")], columns)
    assert table.load(spark.createDataFrame(good[:1], columns)) == 0
    with pytest.raises(ValueError, match="2 rows have an origin"):
        table.load(given)
    assert rows(table.read(), "id", "k", "data_source") == [(1, "1", "batch")]
    assert table.load(given, aside) == 2
    assert sorted(r["id"] for r in table.read().collect()) == [1, 2, 3]
    assert rows(table.read(), "k", "data_source") == [("1", "batch"), ("2", "stream"), ("3", None)]
    assert rows(aside.read(), "k", "data_source") == [("4", "other"), ("5", "")]
