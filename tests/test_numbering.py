import pytest
from pyspark.sql import functions as F

from headrace.operators import numbering
from headrace.operators.numbering import number_rows


def stored(spark, path, n, files):
    spark.range(n).repartition(files).select(F.col("id").alias("k")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    ("listed", "limit"), [(1000, 0), (2, 10**9), (2, 0)], ids=["listed", "ranged, broadcast", "ranged, shuffled"]
)
def test_ids_are_dense_and_follow_the_scans(spark, place, monkeypatch, listed, limit):
    monkeypatch.setattr(numbering, "LISTED_FILES", listed)
    scans = {"first": stored(spark, place(), 1000, 7), "second": stored(spark, place(), 300, 3)}
    numbered, counts = number_rows(scans, broadcast_bytes=limit)
    assert counts == {"first": 1000, "second": 300}
    first = numbered["first"].collect()
    assert sorted(r["id"] for r in first) == list(range(1, 1001))
    assert sorted(r["k"] for r in first) == list(range(1000))
    assert sorted(r["id"] for r in numbered["second"].collect()) == list(range(1001, 1301))


def test_ids_do_not_depend_on_how_files_are_split(spark, place):
    path = place()
    stored(spark, path, 5000, 3)
    by_k = []
    for size in ("134217728", "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            numbered, _ = number_rows({"s": spark.read.parquet(path)}, start=10)
            by_k.append({r["k"]: r["id"] for r in numbered["s"].collect()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert by_k[0] == by_k[1] and min(by_k[0].values()) == 10


def test_empty_and_renamed_scans(spark, place):
    empty, full = stored(spark, place(), 0, 1), stored(spark, place(), 5, 2)
    scans = {"empty": empty, "full": full.select(F.col("k").cast("string").alias("a.b"))}
    numbered, counts = number_rows(scans)
    assert counts == {"empty": 0, "full": 5} and numbered["empty"].collect() == []
    assert numbered["full"].columns == ["id", "a.b"]
    assert sorted(r["id"] for r in numbered["full"].collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("listed", [1000, 1])
def test_rows_are_not_shuffled(spark, place, monkeypatch, listed):
    monkeypatch.setattr(numbering, "LISTED_FILES", listed)
    scan = stored(spark, place(), 100, 2)
    numbered, _ = number_rows({"s": scan})
    plan = numbered["s"]._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in rows_side and "Exchange hashpartitioning" not in rows_side


def test_ids_are_the_same_for_any_number_of_files(spark, place, monkeypatch):
    path = place()
    stored(spark, path, 2000, 40)
    found = []
    for listed in (1000, 3):
        monkeypatch.setattr(numbering, "LISTED_FILES", listed)
        scan = spark.read.parquet(path)
        numbered, _ = number_rows({"s": scan})
        in_place = scan.select("k", "_metadata.file_path", "_metadata.row_index").collect()
        assert {r["k"]: r["id"] for r in numbered["s"].collect()} == {
            r["k"]: n for n, r in enumerate(sorted(in_place, key=lambda r: (r["file_path"], r["row_index"])), 1)
        }
        found.append({r["k"]: r["id"] for r in numbered["s"].collect()})
    assert found[0] == found[1]
