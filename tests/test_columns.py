import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headrace.functions import columns as C
from tests.conftest import rows

names = st.lists(st.text("aAbBcC_.`é ", min_size=1, max_size=4), min_size=1, max_size=6)


@given(names)
def test_lowered_keeps_order_or_reports_a_collision(given_names):
    expected = [n.lower() for n in given_names]
    if len(set(expected)) < len(expected):
        with pytest.raises(ValueError, match="differ only in case"):
            C.lowered(given_names)
    else:
        assert C.lowered(given_names) == expected


@given(names, names)
def test_common_is_within_all_and_neither_has_the_id(left, right):
    def distinct(many):
        return list({n.lower(): n for n in many}.values())

    left, right = distinct(left) + ["ID"], distinct(right) + ["Id"]
    common, union = C.common_columns(left, right), C.all_columns(left, right)
    assert set(common) == {n.lower() for n in left} & {n.lower() for n in right} - {"id"} - {"ID".lower()}
    assert set(common) <= set(union) and common == sorted(common) and union == sorted(union)
    assert "id" not in union


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("aAbB.` ", min_size=1, max_size=4), min_size=1, max_size=4, unique_by=str.lower))
def test_normalise_handles_any_name(spark, given_names):
    df = spark.range(2).select(*(F.lit(i).alias(n) for i, n in enumerate(given_names)))
    out = C.normalise(df)
    assert out.columns == [n.lower() for n in given_names]
    assert {f.dataType for f in out.schema} == {T.StringType()}
    assert out.collect()[0] == tuple(str(i) for i in range(len(given_names)))


def test_cast_follows_sparks_text_format(spark):
    df = spark.sql(
        "SELECT array(1, null, 2) AS A, named_struct('x', 1, 'y', null) AS S, map('k', 1) AS M, "
        "CAST(1.50 AS DECIMAL(5,2)) AS D, 12.0D AS F, X'6162' AS B, CAST(NULL AS INT) AS N"
    )
    assert C.normalise(df).first() == ("[1, null, 2]", "{1, null}", "{k -> 1}", "1.50", "12.0", "ab", None)


def test_lowercase_and_cast_alone(spark):
    df = spark.sql("SELECT 1 AS Ab, 'x' AS cD")
    assert C.lowercase_columns(df).dtypes == [("ab", "int"), ("cd", "string")]
    assert C.to_string(df).dtypes == [("Ab", "string"), ("cD", "string")]


def test_normalise_is_one_projection(spark, place):
    path = place()
    spark.range(3).write.parquet(path)
    plan = C.normalise(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") == 1


def test_serving_schema_is_id_sorted_union_and_origin():
    schema = C.serving_schema(["Id", "B", "a"], ["iD", "c", "A"])
    assert schema.simpleString() == "struct<id:bigint,a:string,b:string,c:string,data_source:string>"
    with pytest.raises(ValueError, match="data_source"):
        C.serving_schema(["a", "data_source"], ["a"])


def test_widened_adds_new_columns_and_refuses_another_type():
    known = T.StructType().add("a", "string")
    assert C.widened(known, T.StructType().add("b", "string").add("a", "string")).names == ["a", "b"]
    with pytest.raises(ValueError, match="changes type"):
        C.widened(known, T.StructType().add("a", "long"))


def test_aligned_fills_absent_columns_with_null(spark):
    df = spark.sql("SELECT 'x' AS a, 'y' AS extra")
    out = C.aligned(df, T.StructType().add("z", "long").add("a", "string"))
    assert rows(out) == [(None, "x")]
    assert out.dtypes == [("z", "bigint"), ("a", "string")]
