import json

import pytest
from pyspark.sql import functions as F

from headrace.functions.columns import normalise
from headrace.operators.changelog import row_changes
from headrace.operators.rebuilds import rebuild_changes
from headrace.operators.serving import ServingTable
from headrace.plans.lambda_view import LambdaView
from headrace.sources.committed import CommittedTable
from headrace.streaming import topics
from headrace.streaming.tables import StreamToTable, table_sink
from tests.conftest import rows
from tests.test_envelope import message, values


def send(spark, topic, *texts):
    values(spark, *texts).coalesce(1).write.mode("append").parquet(topic)


def topic_folder(spark, place):
    folder = place("topic")
    values(spark).write.parquet(folder)
    return folder


def test_pass_through_copies_unchanged_and_resumes(spark, place):
    first, second, check = topic_folder(spark, place), place("out"), place("check")

    def run():
        source = topics.folder_source(spark, first)
        topics.pass_through(topics.folder_sink(source, second), check, once=True)
        return sorted(str(r["value"]) for r in spark.read.schema("value STRING").parquet(second).collect())

    send(spark, first, "a", "not json", "a", None)
    assert run() == ["None", "a", "a", "not json"]
    assert run() == ["None", "a", "a", "not json"]
    send(spark, first, "b")
    assert run() == ["None", "a", "a", "b", "not json"]


def test_table_grows_with_declared_columns_and_sets_rejects_aside(spark, place):
    topic, check = topic_folder(spark, place), place("check")
    table, rejects = CommittedTable(spark, place()), CommittedTable(spark, place())

    def run():
        sink = table_sink(topics.folder_source(spark, topic), StreamToTable(table, rejects=rejects))
        topics.run(sink, check, once=True)

    send(spark, topic, message({"K": "1"}), message({"K": "2"}))
    run()
    assert rows(table.read()) == [("1",), ("2",)] and rejects.last_version() == -1
    send(spark, topic, message({"K": "3", "new": "x"}), "not json")
    run()
    assert table.columns() == ["k", "new"]
    assert rows(table.read()) == [("1", None), ("2", None), ("3", "x")]
    assert rows(rejects.read()) == [("not json",)]
    send(spark, topic, "only", "junk")
    run()
    assert rows(table.read()) == [("1", None), ("2", None), ("3", "x")] and rejects.read().count() == 3


def test_spellings_of_one_name_are_one_column(spark, place):
    topic, check = topic_folder(spark, place), place("check")
    table = CommittedTable(spark, place())

    def run():
        topics.run(table_sink(topics.folder_source(spark, topic), StreamToTable(table)), check, once=True)

    send(spark, topic, message({"K": "1"}), message({"k": "2"}))
    run()
    send(spark, topic, message({"k": "3", "V": "x"}), message({"K": "4", "v": "y"}))
    run()
    assert table.columns() == ["k", "v"]
    assert rows(table.read()) == [("1", None), ("2", None), ("3", "x"), ("4", "y")]


def test_a_batch_without_new_names_is_read_once(spark, place):
    """Known names: the write itself counts rejects and finds nothing new, so there is no other pass."""
    table, rejects = CommittedTable(spark, place()), CommittedTable(spark, place())
    step = StreamToTable(table, rejects=rejects)
    step(values(spark, message({"k": "1"})), 0)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    step(values(spark, message({"k": "2"}), message({"k": "3"})).mapInPandas(counted, "value STRING"), 1)
    assert read.value == 2 and rows(table.read()) == [("1",), ("2",), ("3",)]
    step(values(spark, message({"k": "4", "n": "x"})).mapInPandas(counted, "value STRING"), 2)
    assert read.value == 4 and table.columns() == ["k", "n"] and rejects.last_version() == -1


def test_one_file_per_micro_batch_gives_a_commit_each(spark, place):
    topic, table = topic_folder(spark, place), CommittedTable(spark, place())
    for n in range(3):
        send(spark, topic, message({"k": str(n)}))
    source = topics.folder_source(spark, topic, files_per_batch=1)
    topics.run(table_sink(source, StreamToTable(table)), place("check"), once=True)
    assert rows(table.read()) == [("0",), ("1",), ("2",)]
    assert table.log().count() >= 3


def test_a_repeated_micro_batch_changes_nothing(spark, place):
    view = LambdaView(spark, place())
    view.batch.commit(normalise(spark.range(3).withColumn("k", F.lit("b"))))
    view.serving.create(view.batch.columns(), ["k"])
    step = StreamToTable(view.stream, rejects=view.rejects, serving=view.serving, changelog=view.changelog)
    batch = values(spark, message({"k": "s1"}), message({"k": "s2"}), "junk")
    step(batch, 0)
    state = rows(view.read()), rows(view.stream.read()), rows(view.rejects.read()), view.changelog.read().count()
    step(batch, 0)
    assert (rows(view.read()), rows(view.stream.read()), rows(view.rejects.read()), view.changelog.read().count()) == state
    assert state[3] == 2


class Crash(Exception):
    pass


def test_a_micro_batch_that_broke_off_is_completed_on_restart(spark, place):
    topic, check, location = topic_folder(spark, place), place("check"), place("view")
    send(spark, topic, message({"k": "s1"}), message({"k": "s2"}))
    view = LambdaView(spark, location)
    view.serving.create(["id", "k"], ["k"])

    def crash(*_):
        raise Crash("executor gone")

    step = StreamToTable(view.stream, serving=view.serving, also=crash)
    with pytest.raises(Exception, match="executor gone"):
        topics.run(table_sink(topics.folder_source(spark, topic), step), check, once=True)
    step = StreamToTable(view.stream, serving=view.serving)
    topics.run(table_sink(topics.folder_source(spark, topic), step), check, once=True)
    assert rows(view.stream.read()) == [("s1",), ("s2",)]
    assert rows(view.read(), "k") == [("s1",), ("s2",)]


def test_the_view_stays_current(spark, place):
    topic = topic_folder(spark, place)
    view = LambdaView(spark, place())
    view.batch.commit(normalise(spark.createDataFrame([("1", "b1", "x")], "Id STRING, K STRING, extra STRING")))
    view.serving.create(view.batch.columns(), ["k", "other"])
    assert tuple(view.rebuild().first())[:4] == ("SUCCESS", 1, 0, 1)  # nothing streamed yet
    assert [tuple(r) for r in view.read().collect()] == [(1, None, "b1", None, "batch")]

    send(spark, topic, message({"k": "s1", "other": "o"}))
    view.follow(topics.folder_source(spark, topic), once=True)
    assert rows(view.read(), "k", "data_source") == [("b1", "batch"), ("s1", "stream")]
    assert tuple(view.rebuild().first())[:4] == ("SUCCESS", 1, 1, 2)
    send(spark, topic, message({"k": "s2", "other": "o"}))
    view.follow(topics.folder_source(spark, topic), once=True)
    got = [(r["id"], r["k"], r["data_source"]) for r in view.read().orderBy("id").collect()]
    assert got == [(1, "b1", "batch"), (2, "s1", "stream"), (3, "s2", "stream")]
    assert view.read().columns == ["id", "extra", "k", "other", "data_source"]

    events = [json.loads(r["value"]) for r in view.changelog.read().collect()]
    assert sorted((e["op"], e["before"], e["after"]["id"], e["after"]["k"]) for e in events) == [
        ("c", None, 2, "s1"), ("c", None, 3, "s2"),
    ]


def test_serving_table_alone_can_be_reopened(spark, place):
    location = place()
    ServingTable(spark, location).create(["a"], ["a"])
    assert ServingTable(spark, location).read().columns == ["id", "a", "data_source"]


class Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, *args, *sorted(kwargs.items())))
            return self

        return call


class KafkaLess:
    def __init__(self):
        self.readStream = Recorder()


def test_kafka_source_settings():
    """The Kafka package is not installed here, so only what Spark is asked for can be checked."""
    spark = KafkaLess()
    topics.kafka_source(spark, "broker:9092", "trips", maxOffsetsPerTrigger="1000")
    assert spark.readStream.calls == [
        ("format", "kafka"),
        ("option", "kafka.bootstrap.servers", "broker:9092"),
        ("option", "subscribe", "trips"),
        ("option", "startingOffsets", "latest"),
        ("options", ("maxOffsetsPerTrigger", "1000")),
        ("load",),
        ("selectExpr", "CAST(value AS STRING) AS value"),
    ]


def test_kafka_sink_settings():
    class Messages:
        writeStream, write = Recorder(), Recorder()

        def selectExpr(self, *columns):
            assert columns == ("CAST(value AS BINARY) AS value",)
            return self

    topics.kafka_sink(Messages(), "broker:9092", "out")
    expected = [("format", "kafka"), ("option", "kafka.bootstrap.servers", "broker:9092"), ("option", "topic", "out")]
    assert Messages.writeStream.calls == expected
    topics.publish(Messages(), "broker:9092", "out")
    assert Messages.write.calls == [*expected, ("save",)]


def test_a_rebuild_compares_only_commits_that_differ(spark, place):
    topic, view = topic_folder(spark, place), LambdaView(spark, place())
    tables = {"batch": view.batch, "stream": view.stream}

    def changes(keys=()):
        return rebuild_changes(view.serving, view.serving.snapshots.latest(), tables, keys)

    def told(keys=()):
        sides = [F.col(f"{side}.k") for side in ("before", "after")]
        return sorted((tuple(r) for r in changes(keys).select("op", *sides).collect()), key=repr)

    view.batch.commit(spark.createDataFrame([("1", "a"), ("2", "b")], "k STRING, v STRING"))
    view.serving.create(["k", "v"], ["k", "v"])
    view.serving.merge(view.batch, view.stream)
    send(spark, topic, message({"k": "9", "v": "s"}))
    view.follow(topics.folder_source(spark, topic), once=True)
    # appended history, live rows taken up: the appended rows alone, and nothing is shuffled
    view.batch.commit(spark.createDataFrame([("3", "c"), ("3", "c")], "k STRING, v STRING"))
    view.serving.merge(view.batch, view.stream)
    for keys in ((), ("k",)):
        assert told(keys) == [("c", None, "3"), ("c", None, "3")]
        assert "Exchange" not in changes(keys)._jdf.queryExecution().executedPlan().toString()
    # a stream commit that was never served live
    view.stream.commit(spark.createDataFrame([("10", "t")], "k STRING, v STRING"))
    view.serving.merge(view.batch, view.stream)
    assert told() == [("c", None, "10")]
    # history replaced: only its rows are compared
    view.batch.overwrite(spark.createDataFrame([("1", "a"), ("2", "B")], "k STRING, v STRING"))
    view.serving.merge(view.batch, view.stream)
    assert told() == [("c", None, "2"), ("d", "2", None), ("d", "3", None), ("d", "3", None)]
    whole = row_changes(view.serving.read_before(view.serving.snapshots.latest()).drop("id"), view.read().drop("id"))
    assert sorted(r["op"] for r in whole.collect()) == ["c", "d", "d", "d"]
    # other common columns: all rows are compared, and those that lack the new one are the same
    view.batch.commit(spark.createDataFrame([("5", "n")], "k STRING, w STRING"))
    view.stream.commit(spark.createDataFrame([("11", "t", "w")], "k STRING, v STRING, w STRING"))
    view.serving.merge(view.batch, view.stream)
    assert told() == [("c", None, "11"), ("c", None, "5")]


def test_ids_of_live_rows_need_one_number(spark, place):
    view = LambdaView(spark, place())
    view.batch.commit(spark.createDataFrame([("b",)], "k STRING"))
    view.serving.create(["k"], ["k"])
    view.rebuild()
    step = StreamToTable(view.stream, serving=view.serving)
    for n in range(4):
        step(values(spark, *(message({"k": f"{n}{i}"}) for i in range(n + 1))), n)
        if n == 1:
            view.rebuild()
    step(values(spark, *(message({"k": f"3{i}"}) for i in range(4))), 3)  # the last one comes again
    plan = view.read()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "LocalTableScan" not in plan
    got = [(r["id"], r["k"][0]) for r in view.read().orderBy("id").collect()]
    assert got == [(1, "b"), (2, "0"), (3, "1"), (4, "1")] + [(n, "2") for n in (5, 6, 7)] + [(n, "3") for n in range(8, 12)]


def test_a_rebuild_publishes_what_it_changed(spark, place):
    topic, view = topic_folder(spark, place), LambdaView(spark, place())
    view.batch.commit(spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "k STRING, v STRING"))
    view.serving.create(["k", "v"], ["k", "v"])
    send(spark, topic, message({"k": "9", "v": "s"}))
    view.follow(topics.folder_source(spark, topic), once=True)
    view.rebuild(keys=["k"])
    view.batch.overwrite(spark.createDataFrame([("1", "a"), ("2", "B"), ("4", "d")], "k STRING, v STRING"))
    view.rebuild(keys=["k"])
    view.rebuild(keys=[])

    def published(version):
        found = [json.loads(r["value"]) for r in view.rebuild_changelog.scan(version, version).collect()]
        return sorted((e["op"], (e["before"] or {}).get("v"), (e["after"] or {}).get("v")) for e in found)

    # the first version is the declared table
    assert published(1) == [("c", None, "a"), ("c", None, "b"), ("c", None, "c")]
    assert sorted(published(2), key=str) == [("c", None, "d"), ("d", "c", None), ("u", "b", "B")]
    assert published(3) == []


def test_a_view_starts_from_history_alone(spark, place):
    topic, view = topic_folder(spark, place), LambdaView(spark, place())
    assert view.rebuild().first()["status"] == "FAILED: no common columns"
    view.batch.commit(spark.createDataFrame([("1", "a")], "k STRING, v STRING"))
    assert tuple(view.rebuild().first())[:4] == ("SUCCESS", 1, 0, 1)
    send(spark, topic, message({"k": "9", "v": "s"}))
    view.follow(topics.folder_source(spark, topic), once=True)
    assert rows(view.read(), "id", "k", "data_source") == [(1, "1", "batch"), (2, "9", "stream")]
    assert rows(view.read().where("data_source = 'stream'"), "v") == [("s",)]


def test_no_change_event_is_lost(spark, place):
    view = LambdaView(spark, place())
    view.batch.commit(spark.createDataFrame([("1",)], "k STRING"))
    view.rebuild()
    step = StreamToTable(view.stream, rejects=view.rejects, serving=view.serving, changelog=view.changelog)
    batch = values(spark, message({"k": "s1"}), message({"k": "s2"}))
    step(batch, 0)
    out = rows(view.changelog.read())
    view.rebuild()
    step(batch, 0)  # repeated after a merge has taken its rows up
    assert rows(view.changelog.read()) == out and len(out) == 2

    # stored, but the stream broke off before the events were out, and a merge came first
    StreamToTable(view.stream, rejects=view.rejects, serving=view.serving)(values(spark, message({"k": "s3"})), 1)
    view.rebuild()
    step(values(spark, message({"k": "s3"})), 1)
    late = [json.loads(r["value"])["after"] for r in view.changelog.scan(1, 1).collect()]
    assert [(r["id"], r["k"]) for r in late] == [(None, "s3")]

    # a rebuild that broke off after the switch
    published = view.rebuild_changelog.read().count()
    view.batch.overwrite(spark.createDataFrame([("2",)], "k STRING"))
    view.serving.merge(view.batch, view.stream, {"publish": "[]"})
    assert view.rebuild_changelog.read().count() == published
    view.rebuild()
    assert view.rebuild_changelog.read().count() == published + 2
