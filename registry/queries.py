"""One callable per registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.functions import envelope
from headrace.functions.columns import normalise
from headrace.functions.trips import messages, trips
from headrace.operators import changelog, counts, keys, serving
from headrace.operators.changefeed import exportable
from headrace.operators.mirror import mirror_files
from headrace.plans.daily import run_daily
from headrace.plans.export import export_changes, full_reload
from headrace.plans.ingest import ingest
from headrace.plans.lambda_view import LambdaView
from headrace.session import scratch
from headrace.sources import catalog
from headrace.sources.committed import CommittedTable
from headrace.sources.files import list_files, not_processed, read_as_text, read_table
from headrace.streaming import topics
from headrace.streaming.tables import StreamToTable, table_sink
from registry import inputs
from registry.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# -- names and types ------------------------------------------------------------------------------

NORMALISED = [
    "lineitem", "orders", "events", "customer", "supplier", "part", "nation", "region",
    "documents", "pages", "benchmark", "labels", "conversations",
]


def _normalised(name: str) -> Query:
    return lambda spark, sf_dir: read_as_text(spark, [f"{sf_dir}/{name}.parquet"])


for _name in NORMALISED:
    QUERIES[f"normalize_{_name}"] = _normalised(_name)


# -- lake -----------------------------------------------------------------------------------------


def _ingested_parts(spark: SparkSession, sf_dir: str) -> tuple[str, CommittedTable]:
    """A source folder that receives three deliveries, each ingested when it is there."""
    source = scratch(spark, "source")
    lake = CommittedTable(spark, scratch(spark, "lake"))
    for part in inputs.source_parts(spark, sf_dir):
        part.write.mode("append").parquet(source)
        ingest(spark, source, lake)
    return source, lake


@registered
def lake_append_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested_parts(spark, sf_dir)[1].read()


@registered
def lake_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given files that share some column names and not others, as one commit."""
    lake = CommittedTable(spark, scratch(spark, "lake"))
    ingest(spark, sf_dir, lake, "{documents,benchmark,labels,conversations}.parquet")
    return lake.read()


@registered
def change_feed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _ingested_parts(spark, sf_dir)[1]
    return exportable(lake.changes(1, 2))


@registered
def change_feed_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _ingested_parts(spark, sf_dir)[1]
    return lake.changes(0).drop("_commit_timestamp")


@registered
def change_feed_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exportable(inputs.change_rows(spark, sf_dir))


@registered
def pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files delivered after the last ingest."""
    source = scratch(spark, "source")
    lake = CommittedTable(spark, scratch(spark, "lake"))
    first, *later = inputs.source_parts(spark, sf_dir)
    first.write.parquet(source)
    ingest(spark, source, lake)
    for part in later:
        part.write.mode("append").parquet(source)
    pending = not_processed(list_files(spark, source), lake.source_files())
    return read_as_text(spark, [row["path"] for row in pending.select("path").collect()])


@registered
def lake_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = CommittedTable(spark, scratch(spark, "lake"))
    ingest(spark, sf_dir, lake, files_per_commit=1)
    return counts.table_report(lake)


@registered
def lake_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows with the smallest keys, as text."""
    return counts.sample(_ingested_parts(spark, sf_dir)[1], ["o_orderkey"])


@registered
def lake_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.row_count(_ingested_parts(spark, sf_dir)[1].read())


# -- export, reload, mirror -----------------------------------------------------------------------


@registered
def export_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delivery is ingested and its rows alone are appended to the target."""
    source = scratch(spark, "source")
    lake = CommittedTable(spark, scratch(spark, "lake"))
    target = CommittedTable(spark, scratch(spark, "relational"))
    for part in inputs.source_parts(spark, sf_dir):
        part.write.mode("append").parquet(source)
        ingest(spark, source, lake)
        export_changes(lake, target)
    return target.read()


def _corrected_lake(spark: SparkSession, sf_dir: str) -> tuple[CommittedTable, CommittedTable]:
    """A lake of all orders, exported; then filled ones lose their price and pending ones go, by a replace."""
    lake = CommittedTable(spark, scratch(spark, "lake"))
    target = CommittedTable(spark, scratch(spark, "relational"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    lake.commit(normalise(orders))
    export_changes(lake, target)
    free = F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(F.col("o_totalprice"))
    lake.overwrite(normalise(orders.where("o_orderstatus <> 'P'").withColumn("o_totalprice", free)))
    return lake, target


@registered
def change_feed_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replace did, by key: rows gone, and both sides of rows that changed."""
    lake = _corrected_lake(spark, sf_dir)[0]
    return lake.changes(1, keys=["o_orderkey"]).drop("_commit_timestamp")


@registered
def export_after_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that was exported to before holds just what the replaced table holds."""
    lake, target = _corrected_lake(spark, sf_dir)
    export_changes(lake, target)
    return target.read()


@registered
def full_reload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table replaces whatever the target held before."""
    target = CommittedTable(spark, scratch(spark, "relational"))
    target.overwrite(normalise(table(spark, sf_dir, "customer")))
    full_reload(normalise(read_table(spark, f"{sf_dir}/orders.parquet")), target)
    return target.read()


@registered
def mirror_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All given files, each mirrored with its own types."""
    paths = [row["path"] for row in list_files(spark, sf_dir).collect()]
    return mirror_files(spark, paths, scratch(spark, "mirror")).drop("path")


@registered
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_daily(
        spark,
        sf_dir,
        CommittedTable(spark, scratch(spark, "lake")),
        CommittedTable(spark, scratch(spark, "mirrored")),
        scratch(spark, "mirror"),
        CommittedTable(spark, scratch(spark, "relational")),
    )


@registered
def daily_chain_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delivery goes through the whole chain, up to the merge with what was streamed."""
    view = _streamed_view(spark, sf_dir)
    source, mirror = scratch(spark, "source"), scratch(spark, "mirror")
    lake, mirrored = (CommittedTable(spark, scratch(spark, name)) for name in ("lake", "mirrored"))
    for part in inputs.source_parts(spark, sf_dir):
        part.write.mode("append").parquet(source)
        run_daily(spark, source, lake, mirrored, mirror, view.batch, merge=lambda: view.rebuild(keys=None))
    return view.read().drop("id")


def _streamed_view(spark: SparkSession, sf_dir: str) -> LambdaView:
    """Recent orders have arrived as messages; there is no history yet."""
    view = LambdaView(spark, scratch(spark, "view"))
    stream = inputs.stream_orders(spark, sf_dir)
    view.serving.create(stream.columns, stream.columns)
    topic = scratch(spark, "topic")
    envelope.encode(stream, "orders").write.parquet(topic)
    view.follow(topics.folder_source(spark, topic), once=True)
    return view


# -- serving --------------------------------------------------------------------------------------


def _merged(spark: SparkSession, sf_dir: str) -> tuple[serving.ServingTable, DataFrame]:
    merged = serving.ServingTable(spark, scratch(spark, "serving"))
    result = merged.merge(inputs.batch_orders(spark, sf_dir), inputs.stream_orders(spark, sf_dir))
    return merged, result


@registered
def serving_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)[0].read().drop("id")


@registered
def serving_merge_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without storing them, where no ids are needed."""
    return serving.merged_rows(inputs.batch_orders(spark, sf_dir), inputs.stream_orders(spark, sf_dir))


@registered
def serving_merge_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)[1].drop("exec_time")


@registered
def serving_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.origin_counts(_merged(spark, sf_dir)[0].read())


@registered
def serving_ids_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _merged(spark, sf_dir)[0].read()
    return rows.groupBy("data_source").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("id").alias("ids"),
    )


@registered
def serving_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    origin = F.when(status == "F", "batch").when(status == "O", "other")
    return serving.domain_violations(
        normalise(table(spark, sf_dir, "orders")).withColumn("data_source", origin)
    )


@registered
def serving_checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that carry an origin by their status: those of another origin never become visible."""
    status = F.col("o_orderstatus")
    origin = F.when(status == "F", "batch").when(status == "O", "other").otherwise("stream")
    merged = serving.ServingTable(spark, scratch(spark, "serving"))
    rows = table(spark, sf_dir, "orders").withColumn("data_source", origin)
    merged.load(rows, CommittedTable(spark, scratch(spark, "violations")))
    return merged.read().drop("id")


@registered
def keys_in_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stream = inputs.batch_orders(spark, sf_dir), inputs.stream_orders(spark, sf_dir)
    return keys.in_both(batch, stream, ["o_custkey"])


@registered
def keys_in_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, stream = inputs.batch_orders(spark, sf_dir), inputs.stream_orders(spark, sf_dir)
    return keys.in_either(batch, stream, ["o_custkey"])


@registered
def priorities_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return keys.distinct_list(orders, "o_orderpriority", ["o_orderstatus"], name="priorities")


@registered
def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_first = [F.desc("o_orderdate"), F.asc("o_orderkey")]
    return keys.top(table(spark, sf_dir, "orders"), newest_first, 10)


# -- messages and streams -------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An envelope per event; error events come as text that is not one."""
    events = table(spark, sf_dir, "events")
    columns = inputs.EVENT_COLUMNS
    good = envelope.encode(events.where("event_type <> 'error'").select(*columns), "events")
    bad = events.where("event_type = 'error'").select(
        F.concat(F.lit("not json "), F.col("event_id").cast("string")).alias("value")
    )
    return good.unionByName(bad)


def _message_topic(spark: SparkSession, sf_dir: str) -> str:
    topic = scratch(spark, "topic")
    _messages(spark, sf_dir).write.parquet(topic)
    return topic


@registered
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.encode(table(spark, sf_dir, "events").select(*inputs.EVENT_COLUMNS), "events")


@registered
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.decode(_messages(spark, sf_dir), inputs.EVENT_COLUMNS)


@registered
def envelope_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.rejects(_messages(spark, sf_dir))


@registered
def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events from one topic to another."""
    given = table(spark, sf_dir, "events")
    out = scratch(spark, "topic")
    source = topics.folder_source(spark, f"{sf_dir}/events.parquet*", given.schema)
    topics.pass_through(topics.folder_sink(source, out), scratch(spark, "checkpoint"), once=True)
    return spark.read.schema(given.schema).parquet(out)


@registered
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through one topic to the next and into a table; unreadable ones are set aside."""
    return _streamed_to_table(spark, _message_topic(spark, sf_dir))[0]


@registered
def stream_names_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose producers spell the same fields differently, in one micro-batch."""
    events = table(spark, sf_dir, "events")
    plain, shout = events.where("event_type <> 'error'"), events.where("event_type = 'error'")
    shouted = shout.toDF(*(name.upper() for name in shout.columns))
    topic = scratch(spark, "topic")
    envelope.encode(plain, "events").unionByName(envelope.encode(shouted, "events")).write.parquet(topic)
    stored = CommittedTable(spark, scratch(spark, "stream"))
    topics.run(table_sink(topics.folder_source(spark, topic), StreamToTable(stored)), scratch(spark, "checkpoint"), once=True)
    return stored.read()


@registered
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that the same stream set aside."""
    return _streamed_to_table(spark, _message_topic(spark, sf_dir))[1]


def _streamed_to_table(spark: SparkSession, first: str) -> tuple[DataFrame, DataFrame]:
    second = scratch(spark, "topic")
    copied = topics.folder_sink(topics.folder_source(spark, first), second)
    topics.pass_through(copied, scratch(spark, "checkpoint"), once=True)
    stored = CommittedTable(spark, scratch(spark, "stream"))
    rejects = CommittedTable(spark, scratch(spark, "rejects"))
    sink = table_sink(topics.folder_source(spark, second), StreamToTable(stored, rejects=rejects))
    topics.run(sink, scratch(spark, "checkpoint"), once=True)
    return stored.read(), rejects.read()


def _followed_view(spark: SparkSession, sf_dir: str) -> LambdaView:
    """History by batch and a first merge; then recent orders arrive as messages."""
    view = LambdaView(spark, scratch(spark, "view"))
    batch, stream = inputs.batch_orders(spark, sf_dir), inputs.stream_orders(spark, sf_dir)
    view.batch.append(normalise(batch), 0)
    view.serving.create(view.batch.columns(), stream.columns)
    view.serving.merge(view.batch, spark.createDataFrame([], normalise(stream).schema))
    topic = scratch(spark, "topic")
    envelope.encode(stream, "orders").write.parquet(topic)
    view.follow(topics.folder_source(spark, topic), once=True)
    return view


@registered
def stream_autosync_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _followed_view(spark, sf_dir).read().drop("id")


@registered
def lambda_view_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full merge after streaming: the same rows, now all in the snapshot, ids from 1."""
    view = _followed_view(spark, sf_dir)
    view.rebuild()
    return view.read().groupBy("data_source").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count_distinct("o_orderkey").alias("orders"),
    )


@registered
def changelog_autosync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published while the stream was followed."""
    published = _followed_view(spark, sf_dir).changelog.read()
    return published.select(
        F.get_json_object("value", "$.op").alias("op"),
        F.get_json_object("value", "$.before").alias("before"),
        F.get_json_object("value", "$.after.o_orderkey").alias("o_orderkey"),
        F.get_json_object("value", "$.after.o_totalprice").alias("o_totalprice"),
        F.get_json_object("value", "$.after.data_source").alias("data_source"),
    )


@registered
def changelog_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a full merge changed after history was corrected: pending orders gone, filled ones free."""
    view = _followed_view(spark, sf_dir)
    history = inputs.batch_orders(spark, sf_dir).where("o_orderstatus <> 'P'")
    free = F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(F.col("o_totalprice"))
    full_reload(normalise(history.withColumn("o_totalprice", free)), view.batch)
    view.rebuild(keys=["o_orderkey"])
    published = view.rebuild_changelog.read()
    return published.select(
        F.get_json_object("value", "$.op").alias("op"),
        F.get_json_object("value", "$.before.o_orderkey").alias("before_key"),
        F.get_json_object("value", "$.before.o_totalprice").alias("before_price"),
        F.get_json_object("value", "$.after.o_orderkey").alias("after_key"),
        F.get_json_object("value", "$.after.o_totalprice").alias("after_price"),
    )


# -- changelog ------------------------------------------------------------------------------------


def _flat(changes: DataFrame) -> DataFrame:
    columns = changes.schema["before"].dataType.names
    return changes.select(
        "op",
        *(F.col(f"before.{name}").alias(f"before_{name}") for name in columns),
        *(F.col(f"after.{name}").alias(f"after_{name}") for name in columns),
    )


@registered
def changelog_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = inputs.customers_before(spark, sf_dir), inputs.customers_after(spark, sf_dir)
    return _flat(changelog.keyed_changes(before, after, ["c_custkey"]))


@registered
def changelog_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without keys: nation and segment only, so that equal rows are many."""
    columns = ["c_nationkey", "c_mktsegment"]
    before = inputs.customers_before(spark, sf_dir).select(*columns)
    after = inputs.customers_after(spark, sf_dir).select(*columns)
    return _flat(changelog.row_changes(before, after))


@registered
def changelog_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = inputs.customers_before(spark, sf_dir), inputs.customers_after(spark, sf_dir)
    changes = changelog.keyed_changes(normalise(before), normalise(after), ["c_custkey"])
    return changelog.as_messages(changes, F.lit("2024-01-01 00:00:00").cast("timestamp"))


# -- synthetic trips, federated SQL ---------------------------------------------------------------


@registered
def synthetic_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event, at the event's time."""
    return trips(table(spark, sf_dir, "events"), "event_id", "ts", seed=42)


@registered
def synthetic_trip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips sent as messages, from topic to topic and into the stream table."""
    topic = scratch(spark, "topic")
    messages(table(spark, sf_dir, "events"), "event_id", "ts", seed=42).write.parquet(topic)
    return _streamed_to_table(spark, topic)[0]


@registered
def federated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake orders with relational customers; orders are reduced to one row per customer first."""
    lake = CommittedTable(spark, scratch(spark, "lake"))
    ingest(spark, sf_dir, lake, "orders.parquet")
    relational = CommittedTable(spark, scratch(spark, "relational"))
    full_reload(normalise(table(spark, sf_dir, "customer")), relational)
    sources = {"lake_orders": lake.read(), "relational_customer": relational.read()}
    return catalog.query(
        spark,
        """
        SELECT c_mktsegment, count(*) AS customers, sum(n) AS orders
        FROM (SELECT o_custkey, count(*) AS n FROM lake_orders GROUP BY o_custkey)
        JOIN relational_customer ON c_custkey = o_custkey
        GROUP BY c_mktsegment
        """,
        sources,
    )
