"""Inputs of the registered queries: the given tables, cut along their own values.

Every cut covers its whole table. Dates part history from recent rows, as monthly source files and a
live stream would; segments, priorities and statuses mark rows as changed, new or wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Years at which the order history is cut into three source files with different schemas.
SECOND_FILE, THIRD_FILE = "1997-01-01", "1999-01-01"
# Orders from here on arrive by stream, earlier ones by batch.
RECENT = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _since(day: str) -> Column:
    return F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz")


def source_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of source files: mixed-case names, a changed type, new and dropped columns."""
    orders = table(spark, sf_dir, "orders")
    first = orders.where(~_since(SECOND_FILE))
    second = orders.where(_since(SECOND_FILE) & ~_since(THIRD_FILE))
    third = orders.where(_since(THIRD_FILE))
    return [
        first.select(
            F.col("o_orderkey").alias("O_OrderKey"),
            F.col("o_custkey").alias("O_CustKey"),
            F.col("o_totalprice").alias("O_TotalPrice"),
        ),
        second.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"),
        third.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_orderpriority"),
    ]


def batch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historic orders, with a row id of their own."""
    orders = table(spark, sf_dir, "orders").where(~_since(RECENT))
    return orders.select(
        F.col("o_orderkey").alias("Id"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent orders, with other columns."""
    orders = table(spark, sf_dir, "orders").where(_since(RECENT))
    return orders.select(
        F.col("o_orderkey").alias("id"), "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


def change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed with every kind of change; the kind follows the order's priority."""
    kinds = F.create_map(
        F.lit("1-URGENT"), F.lit("insert"),
        F.lit("2-HIGH"), F.lit("update_preimage"),
        F.lit("3-MEDIUM"), F.lit("update_postimage"),
        F.lit("4-NOT SPECIFIED"), F.lit("delete"),
    )
    return table(spark, sf_dir, "orders").select(
        "*",
        F.coalesce(kinds[F.col("o_orderpriority")], F.lit("insert")).alias("_change_type"),
        (F.year("o_orderdate") - 1995).cast("bigint").alias("_commit_version"),
        F.col("o_orderdate").alias("_commit_timestamp"),
    )


def customers_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")


def customers_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machinery customers have come, furniture ones gone, automobile ones are renamed."""
    renamed = F.when(F.col("c_mktsegment") == "AUTOMOBILE", "VEHICLES").otherwise(F.col("c_mktsegment"))
    kept = table(spark, sf_dir, "customer").where("c_mktsegment <> 'FURNITURE'")
    return kept.withColumn("c_mktsegment", renamed)


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
