"""Reference SQL (DuckDB) for the registered queries, over the same tables."""

from __future__ import annotations

from registry.inputs import EVENT_COLUMNS, RECENT, SECOND_FILE, THIRD_FILE
from registry.queries import NORMALISED

ORACLE: dict[str, str] = {}

for _name in NORMALISED:
    ORACLE[f"normalize_{_name}"] = f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {_name}"

_FIRST = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus,
       CAST(NULL AS VARCHAR) AS o_orderpriority, 0 AS part
FROM orders WHERE o_orderdate < TIMESTAMP '{SECOND_FILE}'"""
_SECOND = f"""
SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(o_totalprice AS VARCHAR),
       o_orderstatus, NULL, 1
FROM orders WHERE o_orderdate >= TIMESTAMP '{SECOND_FILE}' AND o_orderdate < TIMESTAMP '{THIRD_FILE}'"""
_THIRD = f"""
SELECT CAST(o_orderkey AS VARCHAR), CAST(CAST(o_custkey AS DOUBLE) AS VARCHAR), NULL, NULL,
       o_orderpriority, 2
FROM orders WHERE o_orderdate >= TIMESTAMP '{THIRD_FILE}'"""
_PARTS = f"({_FIRST} UNION ALL {_SECOND} UNION ALL {_THIRD})"

ORACLE["lake_append_schema_merge"] = f"SELECT * EXCLUDE (part) FROM {_PARTS}"
ORACLE["change_feed_range"] = f"SELECT * EXCLUDE (part) FROM {_PARTS} WHERE part BETWEEN 1 AND 2"
ORACLE["change_feed_first_run"] = (
    "SELECT * EXCLUDE (part), 'insert' AS _change_type, CAST(part AS BIGINT) AS _commit_version "
    f"FROM {_PARTS}"
)
ORACLE["pending_rows"] = f"SELECT * EXCLUDE (part) FROM {_PARTS} WHERE part > 0"
ORACLE["export_append"] = f"SELECT * EXCLUDE (part) FROM {_PARTS}"
ORACLE["lake_sample"] = f"SELECT * EXCLUDE (part) FROM {_PARTS} ORDER BY o_orderkey LIMIT 10"
ORACLE["lake_row_count"] = f"SELECT count(*) AS row_count FROM {_PARTS}"
ORACLE["lake_mixed_files"] = """
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (
    SELECT * FROM documents
    UNION ALL BY NAME SELECT * FROM benchmark
    UNION ALL BY NAME SELECT * FROM labels
    UNION ALL BY NAME SELECT * FROM conversations)"""
_ALL = [*NORMALISED, "embeddings"]
_ALL_ROWS = " + ".join(f"(SELECT count(*) FROM {name})" for name in _ALL)
ORACLE["lake_report"] = f"""
SELECT {_ALL_ROWS} AS row_count, CAST({len(_ALL)} AS BIGINT) AS file_count,
       CAST(0 AS BIGINT) AS first_version, CAST({len(_ALL) - 1} AS BIGINT) AS last_version"""
ORACLE["change_feed_mixed_types"] = """
SELECT * FROM orders WHERE o_orderpriority NOT IN ('2-HIGH', '4-NOT SPECIFIED')"""
ORACLE["full_reload_roundtrip"] = "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM orders"
ORACLE["mirror_row_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{name}.parquet' AS source_file, 'ok' AS status, count(*) AS row_count FROM {name}"
    for name in _ALL
)
ORACLE["daily_run"] = f"""
SELECT CAST({len(_ALL)} AS BIGINT) AS new_files, CAST(-1 AS BIGINT) AS version_before,
       CAST(0 AS BIGINT) AS version_after, CAST({len(_ALL)} AS BIGINT) AS mirrored_files,
       CAST(0 AS BIGINT) AS unmirrored_files, {_ALL_ROWS} AS exported_rows"""
_CORRECTED = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS VARCHAR) AS o_totalprice
FROM orders WHERE o_orderstatus <> 'P'"""
ORACLE["export_after_replace"] = _CORRECTED
_AS_IT_WAS = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, {kind} AS _change_type, CAST(1 AS BIGINT) AS _commit_version
FROM orders WHERE o_orderstatus = '{status}'"""
ORACLE["change_feed_replaced"] = f"""
{_AS_IT_WAS.format(kind="'delete'", status="P")}
UNION ALL {_AS_IT_WAS.format(kind="'update_preimage'", status="F")}
UNION ALL SELECT *, 'update_postimage', 1 FROM ({_CORRECTED}) WHERE o_orderstatus = 'F'"""

_BATCH = f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{RECENT}')"
_STREAM = f"(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{RECENT}')"


def _serving_side(rows: str, origin: str) -> str:
    return f"""
SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(NULL AS VARCHAR) AS o_orderdate,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority,
       CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       '{origin}' AS data_source
FROM {rows}"""


_SERVING = f"{_serving_side(_BATCH, 'batch')} UNION ALL {_serving_side(_STREAM, 'stream')}"
for _name in ("serving_merge", "serving_merge_view", "stream_autosync_serving"):
    ORACLE[_name] = _SERVING
_COUNTS = f"""(SELECT count(*) FROM {_BATCH}) AS batch_rows, (SELECT count(*) FROM {_STREAM}) AS stream_rows,
       (SELECT count(*) FROM orders) AS total_rows"""
ORACLE["serving_merge_counts"] = f"SELECT {_COUNTS}"
ORACLE["serving_merge_result"] = f"SELECT 'SUCCESS' AS status, {_COUNTS}"
ORACLE["serving_ids_dense"] = f"""
SELECT 'batch' AS data_source, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS ids
FROM {_BATCH}
UNION ALL
SELECT 'stream', (SELECT count(*) FROM {_BATCH}) + 1, (SELECT count(*) FROM orders), count(*)
FROM {_STREAM}"""
ORACLE["lambda_view_rebuilt"] = f"""
SELECT 'batch' AS data_source, count(*) AS row_count, CAST(1 AS BIGINT) AS first_id,
       count(*) AS last_id, count(DISTINCT o_orderkey) AS orders
FROM {_BATCH}
UNION ALL
SELECT 'stream', count(*), (SELECT count(*) FROM {_BATCH}) + 1, (SELECT count(*) FROM orders),
       count(DISTINCT o_orderkey)
FROM {_STREAM}"""
ORACLE["serving_domain_violations"] = """
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (
    SELECT *, 'other' AS data_source FROM orders WHERE o_orderstatus = 'O')"""
ORACLE["serving_checked_load"] = """
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (
    SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'batch' ELSE 'stream' END AS data_source
    FROM orders WHERE o_orderstatus <> 'O' OR o_orderstatus IS NULL)"""
_LAKE_SIDE = f"""
SELECT o_custkey, o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice,
       'batch' AS data_source
FROM {_PARTS}"""
ORACLE["daily_chain_merged"] = f"""
{_LAKE_SIDE}
UNION ALL
SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderpriority, NULL,
       CAST(o_totalprice AS VARCHAR), 'stream'
FROM {_STREAM}"""
ORACLE["keys_in_both"] = f"SELECT o_custkey FROM {_BATCH} INTERSECT SELECT o_custkey FROM {_STREAM}"
ORACLE["keys_in_either"] = f"SELECT o_custkey FROM {_BATCH} UNION SELECT o_custkey FROM {_STREAM}"
ORACLE["priorities_listed"] = """
SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY o_orderstatus"""
ORACLE["latest_orders"] = "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10"

_FIELDS = ",".join(f'{{"field":"{name}","type":"string"}}' for name in EVENT_COLUMNS)
_HEAD = '{"schema":{"type":"struct","name":"events","fields":[' + _FIELDS + ']},"payload":'
_PAIRS = ", ".join(f"'{name}', CAST({name} AS VARCHAR)" for name in EVENT_COLUMNS)
_AS_TEXT = ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in EVENT_COLUMNS)
ORACLE["envelope_encode"] = (
    f"SELECT '{_HEAD}' || CAST(json_object({_PAIRS}) AS VARCHAR) || '}}' AS value FROM events"
)
ORACLE["envelope_decode"] = f"SELECT {_AS_TEXT} FROM events WHERE event_type <> 'error'"
ORACLE["envelope_rejects"] = """
SELECT 'not json ' || CAST(event_id AS VARCHAR) AS value FROM events WHERE event_type = 'error'"""
ORACLE["stream_passthrough"] = "SELECT * FROM events"
ORACLE["stream_to_table"] = ORACLE["envelope_decode"]
ORACLE["stream_names_merged"] = f"SELECT {_AS_TEXT} FROM events"
ORACLE["stream_rejects"] = ORACLE["envelope_rejects"]

ORACLE["changelog_autosync"] = f"""
SELECT 'c' AS op, CAST(NULL AS VARCHAR) AS before, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, 'stream' AS data_source
FROM {_STREAM}"""

ORACLE["changelog_rebuild"] = f"""
SELECT 'd' AS op, CAST(o_orderkey AS VARCHAR) AS before_key, CAST(o_totalprice AS VARCHAR) AS before_price,
       CAST(NULL AS VARCHAR) AS after_key, CAST(NULL AS VARCHAR) AS after_price
FROM {_BATCH} WHERE o_orderstatus = 'P'
UNION ALL
SELECT 'u', CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS VARCHAR), CAST(o_orderkey AS VARCHAR), '0.0'
FROM {_BATCH} WHERE o_orderstatus = 'F'"""

_BEFORE = "SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'"
_AFTER = """
SELECT * REPLACE (CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'VEHICLES' ELSE c_mktsegment END
                  AS c_mktsegment)
FROM customer WHERE c_mktsegment <> 'FURNITURE'"""
_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _sides(columns: list[str]) -> str:
    return ", ".join(f"{side}.{name} AS {alias}_{name}" for side, alias in
                     (("b", "before"), ("a", "after")) for name in columns)


_CHANGED = f"""
FROM ({_BEFORE}) b FULL OUTER JOIN ({_AFTER}) a ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL
   OR (a.c_name, a.c_nationkey, a.c_acctbal, a.c_mktsegment)
      IS DISTINCT FROM (b.c_name, b.c_nationkey, b.c_acctbal, b.c_mktsegment)"""
_OP = "CASE WHEN b.c_custkey IS NULL THEN 'c' WHEN a.c_custkey IS NULL THEN 'd' ELSE 'u' END"
ORACLE["changelog_diff"] = f"SELECT {_OP} AS op, {_sides(_CUSTOMER)} {_CHANGED}"


def _json_row(side: str) -> str:
    pairs = ", ".join(f"'{name}', CAST({side}.{name} AS VARCHAR)" for name in _CUSTOMER)
    return f"CASE WHEN {side}.c_custkey IS NULL THEN 'null' ELSE CAST(json_object({pairs}) AS VARCHAR) END"


ORACLE["changelog_messages"] = f"""
SELECT '{{"op":"' || {_OP} || '","before":' || {_json_row("b")} || ',"after":' || {_json_row("a")}
       || ',"ts_ms":1704067200000}}' AS value
{_CHANGED}"""

_PAIR = "c_nationkey, c_mktsegment"
ORACLE["changelog_multiset"] = f"""
SELECT 'd' AS op, c_nationkey AS before_c_nationkey, c_mktsegment AS before_c_mktsegment,
       CAST(NULL AS INTEGER) AS after_c_nationkey, CAST(NULL AS VARCHAR) AS after_c_mktsegment
FROM (SELECT {_PAIR} FROM ({_BEFORE}) EXCEPT ALL SELECT {_PAIR} FROM ({_AFTER}))
UNION ALL
SELECT 'c', NULL, NULL, c_nationkey, c_mktsegment
FROM (SELECT {_PAIR} FROM ({_AFTER}) EXCEPT ALL SELECT {_PAIR} FROM ({_BEFORE}))"""

ORACLE["federated_join"] = """
SELECT c_mktsegment, count(DISTINCT c_custkey) AS customers, count(*) AS orders
FROM orders JOIN customer ON c_custkey = o_custkey
GROUP BY c_mktsegment"""


# Synthetic trips: draws are 32-bit pieces of md5(seed-key-block), four per hash.
def _trip_columns(seed: int) -> str:
    from headrace.functions import trips

    columns, n = [], 0
    for name in trips.FIELDS:
        if name in trips.DATETIMES:
            columns.append(f"strftime(ts, '%Y-%m-%d %H:%M:%S') AS {name}")
            continue
        block, place = divmod(n, 4)
        n += 1
        digest = f"md5('{seed}-' || CAST(event_id AS VARCHAR) || '-{block}')"
        draw = f"CAST('0x' || substr({digest}, {8 * place + 1}, 8) AS BIGINT)"
        if name in trips.CODES:
            codes = "[" + ", ".join(f"'{code}'" for code in trips.CODES[name]) + "]"
            columns.append(f"({codes})[{draw} % {len(trips.CODES[name])} + 1] AS {name}")
            continue
        low, high = trips.RANGES.get(name, trips.OTHER_RANGE)
        value = f"(({draw} * CAST(({high} - {low}) * 1000000 AS BIGINT)) // 4294967296"
        value += f" + CAST({low} * 1000000 AS BIGINT))"
        columns.append(
            f"CAST({value} // 1000000 AS VARCHAR) || '.' || "
            f"lpad(CAST({value} % 1000000 AS VARCHAR), 6, '0') AS {name}"
        )
    return ",\n       ".join(columns)


ORACLE["synthetic_trips"] = f"SELECT {_trip_columns(42)}\nFROM events"
ORACLE["synthetic_trip_stream"] = ORACLE["synthetic_trips"]
