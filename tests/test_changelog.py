import json
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headrace.operators import changelog
from headrace.operators.changelog import keyed_changes
from tests.conftest import rows

values = st.one_of(st.none(), st.sampled_from("xyz"))
snapshot = st.dictionaries(st.integers(0, 8), st.tuples(values, values), max_size=9)
bag = st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from(["x", "y"])), max_size=12)


def keyed(spark, content):
    return spark.createDataFrame([(k, *v) for k, v in content.items()], "k INT, a STRING, b STRING")


@settings(max_examples=12, deadline=None)
@given(snapshot, snapshot)
def test_keyed_changes_against_python(spark, before, after):
    expected = []
    for k in before.keys() | after.keys():
        old = (k, *before[k]) if k in before else None
        new = (k, *after[k]) if k in after else None
        if old != new:
            expected.append(("c" if old is None else "d" if new is None else "u", old, new))
    got = changelog.keyed_changes(keyed(spark, before), keyed(spark, after), ["k"]).collect()
    seen = [(r["op"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"])) for r in got]
    assert sorted(seen, key=repr) == sorted(expected, key=repr)


def test_applying_the_changes_gives_the_new_snapshot(spark):
    before, after = {1: ("x", None), 2: ("y", "z"), 3: ("x", "x")}, {2: ("y", "y"), 3: ("x", "x"), 4: (None, None)}
    state = {k: (k, *v) for k, v in before.items()}
    for r in changelog.keyed_changes(keyed(spark, before), keyed(spark, after), ["k"]).collect():
        if r["before"]:
            assert state.pop(r["before"]["k"]) == tuple(r["before"])
        if r["after"]:
            state[r["after"]["k"]] = tuple(r["after"])
    assert state == {k: (k, *v) for k, v in after.items()}


def test_a_repeated_changed_key_is_an_error(spark):
    one = spark.createDataFrame([(1, "a")], "k INT, a STRING")
    two = spark.createDataFrame([(1, "b"), (1, "c")], "k INT, a STRING")
    copies = spark.createDataFrame([(1, "b"), (1, "b")], "k INT, a STRING")
    for after in (two, copies):
        with pytest.raises(Exception, match="more than once"):
            changelog.keyed_changes(one, after, ["k"]).collect()
    assert changelog.keyed_changes(two, two, ["k"]).collect() == []


def test_different_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="same columns"):
        changelog.row_changes(spark.range(1), spark.range(1).withColumnRenamed("id", "x"))


@settings(max_examples=12, deadline=None)
@given(bag, bag, st.sampled_from([1, 2, 1000]))
def test_row_changes_against_python(spark, before, after, per_task):
    schema = "a STRING, b STRING"
    old, new = Counter(before), Counter(after)
    expected = [("d", row, None) for row in (old - new).elements()]
    expected += [("c", None, row) for row in (new - old).elements()]
    frames = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    got = changelog.row_changes(*frames, copies_per_task=per_task).collect()
    seen = [(r["op"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"])) for r in got]
    assert sorted(seen, key=repr) == sorted(expected, key=repr)


def test_many_copies_of_one_row_are_shared_among_tasks(spark):
    many = spark.range(9000).selectExpr("'hot' AS a")
    none = spark.createDataFrame([], "a STRING")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = changelog.row_changes(none, many, copies_per_task=100)
        per_task = [r["count"] for r in out.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == 9000 and len(per_task) > 1


def test_messages(spark):
    after = spark.createDataFrame([(1, None)], "k INT, a STRING")
    text = changelog.as_messages(changelog.created(after)).first()["value"]
    event = json.loads(text)
    assert event.pop("ts_ms") > 1_700_000_000_000
    assert event == {"op": "c", "before": None, "after": {"k": 1, "a": None}}
    assert changelog.topic_name("test", "public", "serving") == "test.public.serving"


def test_created_keeps_all_rows(spark):
    assert rows(changelog.created(spark.range(3)).select("op", "after.id")) == [("c", 0), ("c", 1), ("c", 2)]


def test_a_null_key_equals_nothing(spark):
    before = spark.createDataFrame([(None, "a"), (None, "same"), (1, "x"), (None, "b")], "k LONG, v STRING")
    after = spark.createDataFrame([(None, "A"), (None, "same"), (1, "y"), (None, "A")], "k LONG, v STRING")
    got = [(r["op"], r["before"] and r["before"]["v"], r["after"] and r["after"]["v"]) for r in keyed_changes(before, after, ["k"]).collect()]
    assert sorted(got, key=str) == [("c", None, "A"), ("c", None, "A"), ("d", "a", None), ("d", "b", None), ("u", "x", "y")]
    two = ["k", "v"]
    got = [r["op"] for r in keyed_changes(before, after, two).collect()]
    assert sorted(got) == ["c", "c", "c", "d", "d", "d"]
