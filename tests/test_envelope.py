import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from headrace.functions import envelope
from tests.conftest import rows

BAD = ["not json", "", "{}", '{"a": 1}', '{"schema": null, "payload": {"a": "1"}}', "[1]", "null", None,
       '{"schema": {"fields": [{"field": "a", "type": "string"}]}, "payload": "text"}']


def message(payload, *fields):
    declared = [{"field": name, "type": "string"} for name in fields or payload]
    return json.dumps({"schema": {"type": "struct", "name": "t", "fields": declared}, "payload": payload})


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_encode_is_the_declared_shape(spark):
    df = spark.sql("SELECT 1 AS a, 'q\"é' AS b, CAST(NULL AS STRING) AS c")
    sent = json.loads(envelope.encode(df, "trips").first()["value"])
    assert sent == {
        "schema": {
            "type": "struct",
            "name": "trips",
            "fields": [{"field": n, "type": "string"} for n in "abc"],
        },
        "payload": {"a": "1", "b": 'q"é', "c": None},
    }


def test_round_trip(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    assert rows(envelope.decode(envelope.encode(df, "t"), ["k", "v"])) == rows(df)


def test_extra_and_missing_fields(spark):
    df = values(spark, message({"a": "1", "b": "2"}, "a"), message({"b": "3"}, "a", "b"))
    assert rows(envelope.decode(df, ["a", "b"])) == [("1", "2"), (None, "3")]


def test_rejects_and_decode_share_out_all_messages(spark):
    good = [message({"a": str(i)}) for i in range(5)]
    df = values(spark, *good, *BAD)
    assert sorted(r["a"] for r in envelope.decode(df, ["a"]).collect()) == [str(i) for i in range(5)]
    left = [r["value"] for r in envelope.rejects(df).collect()]
    assert sorted(map(str, left)) == sorted(map(str, BAD))


def test_survey(spark):
    good = [message({"a": "1"}), message({"a": "2", "c": "3"}), message({"b": "1"})]
    assert envelope.survey(values(spark, *good)) == (["a", "b", "c"], True)
    assert envelope.survey(values(spark, *good, "not json")) == (["a", "b", "c"], False)
    assert envelope.survey(values(spark, "not json")) == ([], False)


def test_each_message_is_parsed_once(spark, place):
    path = place()
    values(spark, message({"a": "1"})).write.parquet(path)
    df = spark.read.schema("value STRING").parquet(path)
    observed = envelope.decode_observed(df, ["a", "b"], Observation())
    for out in (envelope.decode(df, ["a", "b"]), envelope.rejects(df), observed):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_names_that_differ_in_case_are_one_column(spark):
    texts = [message({"K": "1"}), message({"k": "2"}), message({"K": "3", "k": "4"}), message({"K": None, "k": "5"}), "junk"]
    seen = Observation()
    rows_ = envelope.decode_observed(values(spark, *texts, message({"k": "6", "new": "x"})), ["K", "k", "v"], seen)
    assert rows_.columns == ["k", "v"]
    assert sorted(r["k"] for r in rows_.collect()) == ["1", "2", "3", "5", "6"]
    assert seen.get == {"undeclared": [["new"]], "unreadable": 1}
    assert sorted(r["K"] or "" for r in envelope.decode(values(spark, *texts), ["K", "k"]).toDF("K", "l").collect()) == ["", "", "1", "3"]


def test_odd_names(spark):
    text = message({"a.b": "1", "c`d": "2", "": "3"})
    got = envelope.decode_observed(values(spark, text), ["a.b", "c`d", ""], Observation())
    assert [tuple(r) for r in got.collect()] == [("1", "2", "3")]
