import random

from pyspark.sql import functions as F

from headrace.operators import counts, keys
from headrace.sources.committed import CommittedTable
from tests.conftest import rows


def skewed(spark, seed):
    """A third of all rows share one key; some keys are null."""
    pick = random.Random(seed)
    made = [("hot" if n % 3 == 0 else pick.choice([None, *map(str, range(40))]),) for n in range(600)]
    return made, spark.createDataFrame(made, "k STRING")


def test_key_sets_against_python(spark):
    (left_rows, left), (right_rows, right) = skewed(spark, 1), skewed(spark, 2)
    right = right.where("k IS NULL OR k > '2'")
    right_rows = [r for r in right_rows if r[0] is None or r[0] > "2"]
    assert rows(keys.in_both(left, right, ["k"])) == sorted(set(left_rows) & set(right_rows), key=repr)
    assert rows(keys.in_either(left, right, ["k"])) == sorted(set(left_rows) | set(right_rows), key=repr)


def test_keys_are_reduced_before_their_only_shuffle(spark):
    left, right = skewed(spark, 1)[1], skewed(spark, 2)[1]
    plan = keys.in_both(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_max" in below and "Join" not in plan


def test_distinct_list(spark):
    df = spark.createDataFrame(
        [("g", "b"), ("g", "a"), ("g", "b"), ("h", None), ("h", "c"), (None, "d")], "g STRING, v STRING"
    )
    assert rows(keys.distinct_list(df, "v", ["g"], name="all")) == [("g", "a, b"), ("h", "c"), (None, "d")]
    assert rows(keys.distinct_list(df, "v")) == [("a, b, c, d",)]


def test_top_keeps_no_full_sort(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), "id")
    best = keys.top(df, [F.desc("a"), F.asc("id")], 3)
    assert [tuple(r) for r in best.collect()] == [(6, 6), (6, 13), (6, 20)]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def test_report_and_sample(spark, place):
    table = CommittedTable(spark, place())
    assert rows(counts.table_report(table)) == [(0, 0, None, None)]
    table.commit(spark.range(20).selectExpr("CAST(id AS STRING) AS a"), files=["f1", "f2"])
    table.commit(spark.range(5).selectExpr("CAST(id AS STRING) AS a"), files=["f3"])
    assert rows(counts.table_report(table)) == [(25, 3, 0, 1)]
    assert [r["a"] for r in counts.sample(table, ["a"], 3).collect()] == ["0", "0", "1"]
    assert rows(counts.row_count(table.read())) == [(25,)]
