import re

from pyspark.sql import functions as F

from headrace.functions import trips as T


def source(spark, n, parts=4):
    return spark.range(0, n, 1, parts).select("id", F.lit("2024-05-06 07:08:09").cast("timestamp_ntz").alias("ts"))


def test_fields_sets_and_ranges(spark):
    df = T.trips(source(spark, 2000), "id", "ts", seed=1)
    assert df.columns == T.FIELDS and len(T.FIELDS) == 25
    assert {t for _, t in df.dtypes} == {"string"}
    got = df.toPandas()
    for name in T.FIELDS:
        if name in T.DATETIMES:
            assert set(got[name]) == {"2024-05-06 07:08:09"}
        elif name in T.CODES:
            assert set(got[name]) == set(T.CODES[name])
        else:
            low, high = map(float, T.RANGES.get(name, T.OTHER_RANGE))
            assert all(re.fullmatch(r"\d+\.\d{6}", v) for v in got[name])
            numbers = got[name].astype(float)
            assert low <= numbers.min() and numbers.max() < high
            # uniform: the mean of 2,000 draws lies near the middle
            assert abs(numbers.mean() - (low + high) / 2) < (high - low) * 0.05


def test_draws_depend_on_seed_and_key_only(spark):
    one = T.trips(source(spark, 200, 1), "id", "ts", seed=7)
    many = T.trips(source(spark, 200, 8).repartition(5), "id", "ts", seed=7)
    other = T.trips(source(spark, 200, 1), "id", "ts", seed=8)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.exceptAll(other).count() == 200


def test_rate_stream_gives_trips(spark, place):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 20).load()
    stream = T.trips(rate, "value", "timestamp")
    out, check = place(), place()
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination(60)
    query.stop()
    got = spark.read.parquet(out)
    assert got.columns == T.FIELDS and got.count() >= 20
