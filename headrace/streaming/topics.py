"""Topics of text messages: Kafka in production, a folder of Parquet files anywhere else.

Both give and take one ``value STRING`` column without key or event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

VALUE_SCHEMA = "value STRING"


def kafka_source(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """Message values as text. The start applies to a new query only; later its checkpoint decides."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def kafka_sink(messages: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    return (
        messages.selectExpr("CAST(value AS BINARY) AS value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a finished set of messages, such as the changelog of a merge."""
    (
        messages.selectExpr("CAST(value AS BINARY) AS value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def folder_source(
    spark: SparkSession, folder: str, schema: str = VALUE_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Files far older than the newest one would be passed over by default.
    return reader.option("maxFileAge", "36500d").parquet(folder)


def folder_sink(messages: DataFrame, folder: str) -> DataStreamWriter:
    return messages.writeStream.format("parquet").option("path", folder)


def run(writer: DataStreamWriter, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Start a query; with ``once`` it takes in everything that is there, then ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    if not once:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def pass_through(writer: DataStreamWriter, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Copy messages from one topic to another, unchanged and without state.

    ``writer`` is a sink built directly on a source: ``kafka_sink(kafka_source(...), ...)``.
    """
    return run(writer, checkpoint, once)
