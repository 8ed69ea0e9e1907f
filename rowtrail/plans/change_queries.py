"""Queries over the row feeds (F1 to F6): reading, parsing, history, search, reconciliation."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.functions import jsonvalue, lsn, names
from rowtrail.operators import changes, history, reconcile, settings, wire
from rowtrail.plans import feeds
from rowtrail.plans.catalog import query, with_ctes
from rowtrail.session import run_folder
from rowtrail.sources import feeds as sources
from rowtrail.sources import storage
from rowtrail.streaming import history as streams

_HEAD = f'["{feeds.TENANT}","{feeds.SOURCE}","{feeds.INCARNATION}","dbo",'
_ENVELOPE = (
    "'{\"op\":\"' || op || '\",\"before\":' || coalesce(before_json, 'null') || ',\"after\":' || coalesce(after_json, 'null') || "
    "',\"source\":{\"db\":\"shop\",\"schema\":\"dbo\",\"table\":\"' || table_name || '\",\"commit_lsn\":\"' || commit_lsn || "
    "'\",\"change_lsn\":\"' || change_lsn || '\",\"event_serial_no\":' || event_serial_no || ',\"ts_ms\":' || ts_ms || '}}'"
)


def _order_image(status: str) -> str:
    return (
        "'{\"o_custkey\":' || o_custkey || ',\"o_orderkey\":' || o_orderkey || ',\"o_orderpriority\":\"' || o_orderpriority || "
        f"'\",\"o_orderstatus\":\"' || {status} || '\",\"o_totalprice\":\"' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '\"}}'"
    )


_LSN_F1 = "printf('%08x:%08x:%04x', 39 + o_orderkey // 65536, o_orderkey % 65536, {})"
_HISTORY = ", ".join(changes.HISTORY_COLUMNS)
_SUMMARY = ", ".join(history.SUMMARY_COLUMNS)


def _events(rows: str, table: str) -> str:
    """History columns for a feed's steps."""
    return f"""
      SELECT *, sha256('{_HEAD}"{table}","' || commit_lsn || '","' || change_lsn || '",' || event_serial_no || ',"' || operation || '",' || record_key || ']') AS event_id,
        make_timestamp(ts_ms * 1000) AS occurred_at, make_timestamp(ts_ms * 1000 + 5000000) AS captured_at, {_ENVELOPE} AS value,
        'capture-T1-shop.shop.dbo.{table}' AS destination
      FROM ({rows})"""


_TRAPS = {
    "flag": "CASE eid % 4 WHEN 1 THEN 'null' WHEN 2 THEN 'false' WHEN 3 THEN '0' END",
    "note": "CASE eid % 3 WHEN 0 THEN 'null' WHEN 1 THEN '\"\"' ELSE '\"12\"' END",
    "score": "CASE eid % 2 WHEN 0 THEN '12' ELSE '\"12\"' END",
}


def _traps(eid: str) -> str:
    return ", ".join(f"{text.replace('eid', eid)} AS {{0}}_{name}" for name, text in _TRAPS.items())


_EVENT_FIELDS = ["event_type", "flag", "note", "score", "value"]
CTES = {
    "f1": _events(f"""
      SELECT *, 'dbo' AS schema_name, 'T1' AS tenant_id, 'shop' AS source_id, '{{"o_orderkey":' || o_orderkey || '}}' AS record_key,
        CASE step WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op, 'orders' AS table_name,
        CASE step WHEN 1 THEN 'INSERT' WHEN 2 THEN 'UPDATE' ELSE 'DELETE' END AS operation,
        CASE step WHEN 2 THEN {_order_image("'O'")} WHEN 3 THEN {_order_image("o_orderstatus")} END AS before_json,
        CASE step WHEN 1 THEN {_order_image("'O'")} WHEN 2 THEN {_order_image("o_orderstatus")} END AS after_json,
        CASE step WHEN 2 THEN '["o_orderstatus"]' ELSE '["o_custkey","o_orderkey","o_orderpriority","o_orderstatus","o_totalprice"]' END AS changed_properties,
        {_LSN_F1.format("3 * step")} AS commit_lsn, {_LSN_F1.format("3 * step - 1")} AS change_lsn,
        CAST(CASE step WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS event_serial_no, epoch_us(o_orderdate) // 1000 + 1000 * step AS ts_ms
      FROM orders, (VALUES (1), (2), (3)) s(step)
      WHERE step = 1 OR (step = 2 AND o_orderstatus <> 'O') OR (step = 3 AND o_orderkey % 10 = 0)""", "orders"),
    "chain": """
      SELECT event_id AS eid, ts, user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
        lag(event_id) OVER w AS peid, lag(event_type) OVER w AS ptype, CAST(CAST(lag(value) OVER w AS DECIMAL(18,2)) AS VARCHAR) AS pamount
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "states": f"""
      SELECT *, CASE WHEN peid IS NULL THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op,
        '"' || event_type || '"' AS n_event_type, '"' || amount || '"' AS n_value, {_traps("eid").format("n")},
        CASE WHEN peid IS NOT NULL THEN '"' || ptype || '"' END AS b_event_type, CASE WHEN peid IS NOT NULL THEN '"' || pamount || '"' END AS b_value,
        {", ".join(f"CASE WHEN peid IS NOT NULL THEN {text.replace('eid', 'peid')} END AS b_{name}" for name, text in _TRAPS.items())}
      FROM chain""",
    "fields": f"""
      SELECT *, {", ".join(f"CASE WHEN op <> 'd' THEN n_{f} END AS a_{f}" for f in _EVENT_FIELDS)} FROM states""",
    "f2": "",
}
for _side in ("b", "a"):
    CTES["fields"] = CTES["fields"].replace(
        " FROM states", f", '{{\"event_type\":' || {_side if _side == 'b' else 'n'}_event_type || ',\"value\":' || {_side if _side == 'b' else 'n'}_value || "
        f"coalesce(',\"flag\":' || {_side if _side == 'b' else 'n'}_flag, '') || ',\"note\":' || {_side if _side == 'b' else 'n'}_note || "
        f"',\"score\":' || {_side if _side == 'b' else 'n'}_score || '}}' AS {_side}_image FROM states")
CTES["f2"] = _events(f"""
      SELECT *, 'dbo' AS schema_name, 'T1' AS tenant_id, 'shop' AS source_id, 'events' AS table_name,
        '{{"bucket":' || user_id % 10 || ',"user_id":' || user_id || '}}' AS record_key,
        CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' ELSE 'DELETE' END AS operation,
        b_image AS before_json, CASE WHEN op <> 'd' THEN a_image END AS after_json,
        '[' || array_to_string(list_filter([{", ".join(f"CASE WHEN b_{f} IS DISTINCT FROM a_{f} THEN '\"{f}\"' END" for f in _EVENT_FIELDS)}], lambda x: x IS NOT NULL), ',') || ']' AS changed_properties,
        printf('%08x:%08x:%04x', 64, eid, 3) AS commit_lsn, printf('%08x:%08x:%04x', 64, eid, 2) AS change_lsn,
        CAST(CASE op WHEN 'u' THEN 2 ELSE 1 END AS BIGINT) AS event_serial_no, epoch_us(ts) // 1000 AS ts_ms
      FROM fields""", "events")
_F2 = ["chain", "states", "fields", "f2"]


def _sql(body: str, *wanted: str) -> str:
    chosen = [c for w in wanted for c in (_F2 if w == "f2" else [w])]
    return with_ctes(CTES, chosen, body)


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.parse_change_feed(feeds.orders_changes(spark, sf_dir), feeds.shop_source(spark))


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.parse_change_feed(feeds.events_changes(spark, sf_dir), feeds.shop_source(spark))


#: The feeds of the stored history, by the stream that writes each.
_STREAMS = {"orders": order_history, "events": event_history}
#: The stored history of an application and its tables, with the streams that are in it.
_STORED: dict[tuple[str, str], tuple[str, set[str]]] = {}


def _stored(spark: SparkSession, sf_dir: str, *streams: str) -> DataFrame:
    """One history table that both feeds are written to, each once per application, before the first query that reads it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED or not storage.path_exists(spark, _STORED[key][0]):
        _STORED[key] = (run_folder(spark, "history"), set())
    path, there = _STORED[key]
    for stream in streams:
        if stream not in there:
            storage.append_history(_STREAMS[stream](spark, sf_dir), path, 0, stream)
            there.add(stream)
    return storage.read_history(spark, path)


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds' history as a table in storage: what searches read."""
    return _stored(spark, sf_dir, *_STREAMS)


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "orders").filter((F.col("stream_id") == "orders") & (F.col("table_name") == "orders"))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events").filter((F.col("stream_id") == "events") & (F.col("table_name") == "events"))


_FEED_SQL = _sql("SELECT record_key AS key, value, destination FROM f1", "f1")


def _stored_feed(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = run_folder(spark, name)
    feeds.orders_changes(spark, sf_dir).write.parquet(folder)
    return folder


@query("read_change_feed", _FEED_SQL)
def _(spark, sf_dir):
    return sources.read_change_feed(spark, _stored_feed(spark, sf_dir, "feed")).select("key", "value", "destination")


def _drain(stream: DataFrame, spark: SparkSession) -> DataFrame:
    out = run_folder(spark, "drained")
    started = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(spark, "checkpoint")).trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.parquet(out)


@query("stream_change_feed", _FEED_SQL)
def _(spark, sf_dir):
    stream = sources.stream_change_feed(spark, _stored_feed(spark, sf_dir, "feed"))
    return _drain(stream, spark).select("key", "value", "destination")


@query("bounded_ingest", _sql("SELECT operation, count(*) AS record_count, true AS bounded FROM f1 GROUP BY operation", "f1"))
def _(spark, sf_dir):
    """Twelve files under a bound of a third of their bytes: no batch holds half of the records."""
    folder, out = run_folder(spark, "feed"), run_folder(spark, "batches")
    feeds.orders_changes(spark, sf_dir).repartition(12, F.xxhash64("value")).write.parquet(folder)
    sizes = spark.read.parquet(folder).select("_metadata.file_path", "_metadata.file_size").distinct()
    bound = sizes.agg(F.sum("file_size")).first()[0] // 3
    bounded = sources.stream_change_feed(spark, folder, max_bytes=bound)
    started = (
        bounded.writeStream.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
        .option("checkpointLocation", run_folder(spark, "checkpoint")).trigger(availableNow=True).start())
    started.awaitTermination()
    arrived = spark.read.parquet(out)
    most = arrived.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    op = changes.map_operation(F.get_json_object("value", "$.op"))
    counted = arrived.groupBy(op.alias("operation")).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.withColumn("bounded", most * 2 < arrived.agg(F.count(F.lit(1))).scalar())


@query("change_table_to_envelope", _FEED_SQL)
def _(spark, sf_dir):
    rows = feeds.orders_change_table(spark, sf_dir)
    return sources.change_table_to_envelope(rows, ["o_orderkey"], feeds.DATABASE, feeds.SCHEMA, "orders", f"{feeds.CONNECTOR}.shop.dbo.orders")


@query("change_table_replaced_rows", """
  SELECT '{"o_orderkey":' || o_orderkey || '}' AS key, 'd' AS op, true AS has_before, false AS has_after, 1 AS serial FROM orders
  UNION ALL SELECT '{"o_orderkey":' || o_orderkey || '}', 'c', false, true, 1 FROM orders""")
def _(spark, sf_dir):
    """Every order deleted and inserted again at one position."""
    orders = feeds.table(spark, sf_dir, "orders")
    place = lsn.lsn_bytes(lsn.make_lsn(F.lit(39), F.col("o_orderkey"), F.lit(1)))
    rows = orders.select(
        place.alias("start_lsn"), place.alias("seqval"), F.explode(F.array(F.lit(1), F.lit(2))).alias("operation"), F.lit(0).cast("bigint").alias("ts_ms"), "o_orderkey", "o_orderstatus")
    found = sources.change_table_to_envelope(rows, ["o_orderkey"], feeds.DATABASE, feeds.SCHEMA, "orders", f"{feeds.CONNECTOR}.shop.dbo.orders")
    read = jsonvalue.parse(F.col("value"))
    return found.select(
        "key", F.get_json_object("value", "$.op").alias("op"), *[jsonvalue.object_at(read, f"$.{side}").isNotNull().alias(f"has_{side}") for side in ("before", "after")],
        F.get_json_object("value", "$.source.event_serial_no").cast("int").alias("serial"))


@query("include_tables", _sql("""
  SELECT record_key AS key, 'shop' AS database, 'dbo' AS schema_name, 'orders' AS table_name, op FROM f1
  UNION ALL SELECT '{"singleton_id":1}', 'shop', 'dbo', 'Capture_Heartbeat', 'u' FROM events WHERE event_id % 100 = 0""", "f1"))
def _(spark, sf_dir):
    mixed = feeds.orders_changes(spark, sf_dir).unionByName(feeds.events_changes(spark, sf_dir)).unionByName(feeds.heartbeat_changes(spark, sf_dir))
    located = mixed.select(
        "key", F.get_json_object("value", "$.source.db").alias("database"), F.get_json_object("value", "$.source.schema").alias("schema_name"),
        F.get_json_object("value", "$.source.table").alias("table_name"), F.get_json_object("value", "$.op").alias("op"))
    only_orders = feeds.shop_source(spark).withColumn("tables", F.array(F.lit(feeds.ORDERS)))
    return settings.include_tables(located, only_orders).select("key", "database", "schema_name", "table_name", "op")


@query("normalize_values", _sql("""
  SELECT o_orderkey, base64(unhex(replace(commit_lsn, ':', ''))) AS start_lsn, operation, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice
  FROM f1 UNION ALL SELECT o_orderkey, base64(unhex(replace(commit_lsn, ':', ''))), 'BEFORE', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) FROM f1 WHERE operation = 'UPDATE'""", "f1"))
def _(spark, sf_dir):
    kind = F.col("operation")
    named = F.when(kind == 1, "DELETE").when(kind == 2, "INSERT").when(kind == 3, "BEFORE").otherwise("UPDATE")
    return sources.normalize_values(feeds.orders_change_table(spark, sf_dir)).select("o_orderkey", "start_lsn", named.alias("operation"), "o_totalprice")


_START = "00000027:00001000:0000"


@query("start_at_activation", _sql(f"SELECT event_id, commit_lsn FROM f1 WHERE commit_lsn > '{_START}'", "f1"))
def _(spark, sf_dir):
    return sources.start_at_activation(stored_orders(spark, sf_dir), _START).select("event_id", "commit_lsn")


#: A sixteenth of the positions lose their first digits.
_BROKEN = "CASE WHEN substring(commit_lsn, 17, 1) = '3' THEN substring(commit_lsn, 5) ELSE commit_lsn END"


@query("start_at_activation_broken", _sql(f"""
  SELECT event_id, {_BROKEN} AS commit_lsn, CASE WHEN length({_BROKEN}) < 22 THEN 'INVALID_SOURCE_POSITION' END AS error_code
  FROM f1 WHERE commit_lsn > '{_START}' OR length({_BROKEN}) < 22""", "f1"))
def _(spark, sf_dir):
    damaged = stored_orders(spark, sf_dir).withColumn("commit_lsn", F.expr(_BROKEN))
    return sources.start_at_activation(damaged, _START).select("event_id", "commit_lsn", "error_code")


_F1_HISTORY_SQL = _sql(f"SELECT {_HISTORY} FROM f1", "f1")


def _saved_twice(spark: SparkSession, sf_dir: str) -> str:
    """History written from the feed with replays, and then delivered once more as a second batch."""
    path = run_folder(spark, "history")
    source = feeds.shop_source(spark)
    storage.save_events(changes.parse_change_feed(feeds.replayed_changes(spark, sf_dir), source), path, 0)
    storage.save_events(order_history(spark, sf_dir), path, 1)
    return path


@query("append_history", _F1_HISTORY_SQL)
def _(spark, sf_dir):
    return storage.read_history(spark, _saved_twice(spark, sf_dir)).select(*changes.HISTORY_COLUMNS)


def _wire_text(column: str) -> str:
    return f"coalesce('\"' || replace(replace({column}, '\\', '\\\\'), '\"', '\\\"') || '\"', 'null')"


def _wire_body() -> str:
    parts = []
    for column, name in wire.WIRE_NAMES.items():
        if column in ("occurred_at", "captured_at"):
            text = f"'\"' || strftime({column}, '%Y-%m-%dT%H:%M:%S.%fZ') || '\"'"
        elif column == "event_serial_no":
            text = "event_serial_no"
        else:
            text = _wire_text(column)
        parts.append(f"'\"{name}\":' || {text}")
    return f"'{{\"version\":1,\"incarnation\":\"{feeds.INCARNATION}\",\"event\":{{' || " + " || ',' || ".join(parts) + " || '}}'"


_WIRE_SQL = _sql(f"SELECT event_id, {_wire_body()} AS body FROM f1", "f1")


@query("publish_wire", _WIRE_SQL)
def _(spark, sf_dir):
    path = run_folder(spark, "wire")
    storage.publish_wire(order_history(spark, sf_dir), feeds.shop_source(spark), path, 0)
    storage.publish_wire(order_history(spark, sf_dir), feeds.shop_source(spark), path, 0)
    return spark.read.parquet(path).select("event_id", "body")


@query("publish_wire_two_streams", _WIRE_SQL)
def _(spark, sf_dir):
    """Batch 0 of two streams in one place, the second one written twice."""
    path = run_folder(spark, "wire")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    # Parsed once, and kept while both streams publish from it.
    events = order_history(spark, sf_dir).persist()
    try:
        for part in (0, 1, 1):
            storage.publish_wire(events.filter(half == part), feeds.shop_source(spark), path, 0, f"stream-{part}")
    finally:
        events.unpersist()
    return spark.read.parquet(path).select("event_id", "body")


@query("publish_wire_after_compaction", _WIRE_SQL)
def _(spark, sf_dir):
    """The history is saved, the writer is lost before it publishes, months are brought together, and the batch runs again."""
    path, published = run_folder(spark, "history"), run_folder(spark, "wire")
    # Parsed once and kept, as a stream keeps its batch until it is published.
    with storage.at_rest(order_history(spark, sf_dir), path, 0, "stream") as batch:
        storage.save_events(batch, path, 0, "stream")
        storage.compact_history(spark, path, dt.date(2100, 1, 1))
        delivered = storage.save_events(batch, path, 0, "stream")
        storage.publish_wire(delivered.select(*changes.HISTORY_COLUMNS), feeds.shop_source(spark), published, 0, "stream")
    return spark.read.parquet(published).select("event_id", "body")


_CUTOFF = dt.datetime(1996, 1, 1, tzinfo=dt.timezone.utc)
_CUTOFF_SQL = "TIMESTAMP '1996-01-01 00:00:00'"
_PRUNED = f"SELECT event_id FROM f1 WHERE occurred_at < {_CUTOFF_SQL} ORDER BY occurred_at, event_id LIMIT 500"


@query("retention_prune_write", _sql(f"SELECT event_id, occurred_at FROM f1 WHERE event_id NOT IN ({_PRUNED})", "f1"))
def _(spark, sf_dir):
    path = _saved_twice(spark, sf_dir)
    storage.retention_prune_write(spark, path, feeds.TENANT, _CUTOFF, 500)
    return storage.read_history(spark, path).select("event_id", "occurred_at")


_CLOSED = dt.date(1997, 1, 1)


@query("history_compact", _sql(f"SELECT {_HISTORY}, occurred_at < DATE '{_CLOSED}' AS compacted FROM f1", "f1"))
def _(spark, sf_dir):
    """Three batches of two streams; closed months are brought together, written to once more, and brought together again."""
    path = run_folder(spark, "history")
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    # Parsed once, and kept while the batches are saved from it.
    with storage.at_rest(order_history(spark, sf_dir), path, 0, "feed") as events:
        for part, stream in enumerate(("a", "a", "b")):
            storage.save_events(events.filter(third <= part), path, part, stream)
            storage.compact_history(spark, path, _CLOSED)
    return storage.read_history(spark, path).select(*changes.HISTORY_COLUMNS, (F.col("stream_id") == storage.COMPACTED).alias("compacted"))


@query("retention_prune_fleet", _sql(f"""
  SELECT event_id, tenant_id, occurred_at FROM (
    SELECT event_id, 'T' || o_orderkey % 3 AS tenant_id, occurred_at, row_number() OVER (PARTITION BY o_orderkey % 3, occurred_at < {_CUTOFF_SQL} ORDER BY occurred_at, event_id) AS rank FROM f1)
  WHERE occurred_at >= {_CUTOFF_SQL} OR rank > 200""", "f1"))
def _(spark, sf_dir):
    """One pass over three tenants, each with a limit of its own."""
    path = run_folder(spark, "history")
    tenant = F.concat(F.lit("T"), (F.get_json_object("record_key", "$.o_orderkey").cast("bigint") % 3).cast("string"))
    storage.append_history(order_history(spark, sf_dir).withColumn("tenant_id", tenant), path, 0)
    storage.retention_prune_write(spark, path, None, _CUTOFF, 200)
    return storage.read_history(spark, path).select("event_id", "tenant_id", "occurred_at")


@query("unwrap_payload", _sql("""
  SELECT record_key AS key, '{"after":' || coalesce(after_json, 'null') || ',"before":' || coalesce(before_json, 'null') || ',"op":"' || op ||
    '","source":{"change_lsn":"' || change_lsn || '","commit_lsn":"' || commit_lsn || '","db":"shop","event_serial_no":' || event_serial_no ||
    ',"schema":"dbo","table":"orders","ts_ms":' || ts_ms || '}}' AS value FROM f1""", "f1"))
def _(spark, sf_dir):
    feed = feeds.orders_changes(spark, sf_dir)
    wrapped = F.get_json_object("key", "$.o_orderkey").cast("bigint") % 2 == 0

    def wrap(column):
        return F.when(wrapped, F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), F.col(column), F.lit("}"))).otherwise(F.col(column)).alias(column)

    return changes.unwrap_payload(feed.select(wrap("key"), wrap("value")))


@query("map_operation", _sql("SELECT commit_lsn, op, operation FROM f2", "f2"))
def _(spark, sf_dir):
    op = F.get_json_object("value", "$.op")
    return feeds.events_changes(spark, sf_dir).select(F.get_json_object("value", "$.source.commit_lsn").alias("commit_lsn"), op.alias("op"), changes.map_operation(op).alias("operation"))


@query("parse_change_feed", _F1_HISTORY_SQL)
def _(spark, sf_dir):
    return order_history(spark, sf_dir)


@query("parse_typed_changes", _sql(f"SELECT {_HISTORY} FROM f2", "f2"))
def _(spark, sf_dir):
    return event_history(spark, sf_dir)


@query("parse_wrapped_changes", _F1_HISTORY_SQL)
def _(spark, sf_dir):
    feed = feeds.orders_changes(spark, sf_dir)
    wrapped = [F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), F.col(c), F.lit("}")).alias(c) for c in ("key", "value")]
    return changes.parse_change_feed(feed.select(*wrapped, "destination", "captured_at"), feeds.shop_source(spark))


@query("canonical_key", _sql("SELECT '{\"user_id\":' || user_id || ',\"bucket\":' || user_id % 10 || '}' AS key, record_key FROM f2", "f2"))
def _(spark, sf_dir):
    return changes.canonical_key(feeds.events_changes(spark, sf_dir)).select("key", "record_key")


@query("changed_properties", _sql("SELECT event_id, changed_properties FROM f2", "f2"))
def _(spark, sf_dir):
    return changes.changed_properties(event_history(spark, sf_dir).drop("changed_properties")).select("event_id", "changed_properties")


_NUMBERS = ["12", "12.0", '"12"', "1e3", "1000.0"]


def _number(index: str, forms: list[str]) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{form}'" for i, form in enumerate(forms)) + " END"


_READ_NUMBERS = ["12", "12.0", '"12"', "1000.0", "1000.0"]
_BEFORE, _AFTER = (f"CAST({part} % 5 AS INT)" for part in ("event_id", "floor(event_id / 5)"))


def _number_images(spark, sf_dir):
    images = {"before_json": _number(_BEFORE, _NUMBERS), "after_json": _number(_AFTER, _NUMBERS)}
    return feeds.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), *[F.expr(f"""'{{"id":' || {text} || ',"at":1}}'""").alias(name) for name, text in images.items()])


@query("canonical_key_numbers", f"""
  SELECT event_id, '{{"at":' || event_id || ',"id":' || {_number(_BEFORE, _READ_NUMBERS)} || '}}' AS record_key FROM events""")
def _(spark, sf_dir):
    keys = feeds.table(spark, sf_dir, "events").select("event_id", F.expr(f"""'{{"id":' || {_number(_BEFORE, _NUMBERS)} || ',"at":' || event_id || '}}'""").alias("key"))
    return changes.canonical_key(keys).select("event_id", "record_key")


@query("changed_properties_numbers", f"""
  SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN {_number(_BEFORE, _READ_NUMBERS)} = {_number(_AFTER, _READ_NUMBERS)} THEN '[]' ELSE '["id"]' END AS changed_properties FROM events""")
def _(spark, sf_dir):
    return changes.changed_properties(_number_images(spark, sf_dir)).select("event_id", "changed_properties")


@query("field_changes_numbers", f"""
  SELECT CAST(event_id AS VARCHAR) AS event_id, 'id' AS field, {_number(_BEFORE, _READ_NUMBERS)} AS before_value, {_number(_AFTER, _READ_NUMBERS)} AS after_value
  FROM events WHERE {_number(_BEFORE, _READ_NUMBERS)} <> {_number(_AFTER, _READ_NUMBERS)}""")
def _(spark, sf_dir):
    return history.field_changes(_number_images(spark, sf_dir), changed_only=True).select("event_id", "field", "before_value", "after_value")


#: Numbers below the top level, in the forms they come in and the one form each is read as.
_NESTED = ["[1]", "[1.0]", "[1e0]", '{"k":1}', '{"k":1.0}', '{"k":[{"z":1.50,"s":"1.0"}]}', '{"k":[{"s":"1.0","z":1.5}]}', "12345678901234567.88", "12345678901234567.89"]
_READ_NESTED = ["[1]", "[1.0]", "[1.0]", '{"k":1}', '{"k":1.0}', '{"k":[{"s":"1.0","z":1.5}]}', '{"k":[{"s":"1.0","z":1.5}]}', "12345678901234567.88", "12345678901234567.89"]
_NESTED_BEFORE, _NESTED_AFTER = (f"CAST({part} % 9 AS INT)" for part in ("event_id", "floor(event_id / 9)"))


def _nested_images(spark, sf_dir):
    images = {"before_json": _number(_NESTED_BEFORE, _NESTED), "after_json": _number(_NESTED_AFTER, _NESTED)}
    return feeds.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), *[F.expr(f"""'{{"id":' || {text} || ',"at":1}}'""").alias(name) for name, text in images.items()])


@query("canonical_key_nested_numbers", f"""
  SELECT event_id, '{{"at":' || event_id || ',"id":' || {_number(_NESTED_BEFORE, _READ_NESTED)} || '}}' AS record_key FROM events""")
def _(spark, sf_dir):
    keys = feeds.table(spark, sf_dir, "events").select("event_id", F.expr(f"""'{{"id":' || {_number(_NESTED_BEFORE, _NESTED)} || ',"at":' || event_id || '}}'""").alias("key"))
    return changes.canonical_key(keys).select("event_id", "record_key")


@query("changed_properties_nested_numbers", f"""
  SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN {_number(_NESTED_BEFORE, _READ_NESTED)} = {_number(_NESTED_AFTER, _READ_NESTED)} THEN '[]' ELSE '["id"]' END AS changed_properties FROM events""")
def _(spark, sf_dir):
    return changes.changed_properties(_nested_images(spark, sf_dir)).select("event_id", "changed_properties")


@query("field_changes_nested_numbers", f"""
  SELECT CAST(event_id AS VARCHAR) AS event_id, 'id' AS field, {_number(_NESTED_BEFORE, _READ_NESTED)} AS before_value, {_number(_NESTED_AFTER, _READ_NESTED)} AS after_value
  FROM events WHERE {_number(_NESTED_BEFORE, _READ_NESTED)} <> {_number(_NESTED_AFTER, _READ_NESTED)}""")
def _(spark, sf_dir):
    return history.field_changes(_nested_images(spark, sf_dir), changed_only=True).select("event_id", "field", "before_value", "after_value")


@query("changed_name_union", _sql("""
  SELECT event_id, CASE WHEN b_flag IS NULL AND a_flag IS NULL THEN '["event_type","note","score","value"]'
    ELSE '["event_type","flag","note","score","value"]' END AS all_properties FROM f2""", "f2"))
def _(spark, sf_dir):
    return changes.changed_name_union(event_history(spark, sf_dir)).select("event_id", "all_properties")


@query("row_images", _sql("SELECT event_id, before_json, after_json FROM f2", "f2"))
def _(spark, sf_dir):
    return event_history(spark, sf_dir).select("event_id", "before_json", "after_json")


@query("event_identity", _sql("SELECT event_id, commit_lsn, operation FROM f2", "f2"))
def _(spark, sf_dir):
    return event_history(spark, sf_dir).select("event_id", "commit_lsn", "operation")


@query("occurred_at", _sql("SELECT commit_lsn, occurred_at FROM f2", "f2"))
def _(spark, sf_dir):
    millis = F.get_json_object("value", "$.source.ts_ms").cast("bigint")
    return feeds.events_changes(spark, sf_dir).select(
        F.get_json_object("value", "$.source.commit_lsn").alias("commit_lsn"), changes.occurred_at(millis).alias("occurred_at"))


@query("wire_encode", _WIRE_SQL)
def _(spark, sf_dir):
    return wire.wire_encode(order_history(spark, sf_dir), feeds.shop_source(spark))


_DECODED = ["event_id", "source_id", "schema_name", "operation", "occurred_at", "captured_at", "record_key", "before_json", "after_json", "changed_properties", "commit_lsn", "change_lsn"]


@query("wire_decode", _sql(f"""
  SELECT {", ".join(_DECODED)}, CASE eid % 10 WHEN 3 THEN 9 ELSE event_serial_no END AS event_serial_no, CASE eid % 10 WHEN 4 THEN 'T2' ELSE tenant_id END AS tenant_id,
    CASE eid % 10 WHEN 2 THEN 'Capture_Heartbeat' ELSE table_name END AS table_name, CASE WHEN eid % 10 < 7 THEN 'INVALID_BROKER_EVENT' END AS error_code
  FROM (SELECT * REPLACE (CASE WHEN eid % 10 <> 5 THEN occurred_at END AS occurred_at, CASE WHEN eid % 10 <> 6 THEN captured_at END AS captured_at) FROM f2)""", "f2"))
def _(spark, sf_dir):
    source = feeds.shop_source(spark)
    encoded = wire.wire_encode(event_history(spark, sf_dir), source)
    # The second part of a position is the event number; seven of ten bodies are tampered with in different ways.
    block = F.get_json_object("body", "$.event.commitLsn")
    number = F.conv(F.substring(block, 10, 8), 16, 10).cast("bigint") % 10
    body = F.col("body")
    damaged = (
        F.when(number == 0, F.replace(body, F.lit('"version":1'), F.lit('"version":2')))
        .when(number == 1, F.replace(body, F.lit(feeds.INCARNATION), F.lit("another")))
        .when(number == 2, F.replace(body, F.lit('"tableName":"events"'), F.lit('"tableName":"Capture_Heartbeat"')))
        .when(number == 3, F.regexp_replace(body, '"eventSerialNo":[0-9]+', '"eventSerialNo":9'))
        .when(number == 4, F.replace(body, F.lit('"tenantId":"T1"'), F.lit('"tenantId":"T2"')))
        .when(number == 5, F.regexp_replace(body, '"occurredAt":"[^"]*"', '"occurredAt":"yesterday"'))
        .when(number == 6, F.regexp_replace(body, '"capturedAt":"[^"]*"', '"capturedAt":null'))
        .otherwise(body))
    return wire.wire_decode(encoded.select("event_id", damaged.alias("body")), source)


@query("wire_subscribe", _F1_HISTORY_SQL)
def _(spark, sf_dir):
    """Two overlapping batches of wire bodies, read as a stream into a history of the subscriber's own."""
    source, published, path = feeds.shop_source(spark), run_folder(spark, "wire"), run_folder(spark, "history")
    half = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for batch, part in enumerate((half < 3, half > 1)):
        storage.publish_wire(order_history(spark, sf_dir).filter(part), source, published, batch)
    bodies = spark.readStream.schema("event_id string, body string, stream_id string, batch_id bigint").option("maxFilesPerTrigger", 8).parquet(published)
    streams.wire_subscribe(bodies, source, path, run_folder(spark, "checkpoint"), available_now=True).awaitTermination()
    return storage.read_history(spark, path).select(*changes.HISTORY_COLUMNS)


def _kind_sql(value: str) -> str:
    return (f"CASE WHEN {value} IS NULL THEN 'absent' WHEN {value} = 'null' THEN 'null' WHEN {value} LIKE '\"%' THEN 'string' "
            f"WHEN {value} IN ('true','false') THEN 'boolean' ELSE 'number' END")


_FIELD_ROWS = " UNION ALL ".join(
    f"SELECT event_id, '{f}' AS field, {_kind_sql('b_' + f)} AS before_kind, b_{f} AS before_value, {_kind_sql('a_' + f)} AS after_kind, a_{f} AS after_value, "
    f"b_{f} IS DISTINCT FROM a_{f} AS changed FROM f2 WHERE b_{f} IS NOT NULL OR a_{f} IS NOT NULL" for f in _EVENT_FIELDS)


@query("field_changes", _sql(_FIELD_ROWS, "f2"))
def _(spark, sf_dir):
    return history.field_changes(stored_events(spark, sf_dir))


@query("field_changes_filtered", _sql(f"SELECT * FROM ({_FIELD_ROWS}) WHERE changed AND field LIKE '%o%'", "f2"))
def _(spark, sf_dir):
    return history.field_changes(stored_events(spark, sf_dir), changed_only=True, name_like="O")


@query("event_summary", _sql(f"SELECT {_SUMMARY} FROM f1", "f1"))
def _(spark, sf_dir):
    return history.event_summary(stored_orders(spark, sf_dir), feeds.TENANT)


@query("event_detail", _sql(f"SELECT {_SUMMARY}, before_json, after_json FROM f1", "f1"))
def _(spark, sf_dir):
    return history.event_detail(stored_orders(spark, sf_dir), feeds.TENANT)


@query("qualified_names", _sql("""
  SELECT schema_name || '.' || table_name AS qualified_name, schema_name, table_name, count(*) AS event_count FROM
    (SELECT schema_name, table_name FROM f1 UNION ALL SELECT schema_name, table_name FROM f2) GROUP BY ALL""", "f1", "f2"))
def _(spark, sf_dir):
    both = stored_history(spark, sf_dir).select("schema_name", "table_name")
    named = both.select(names.qualified(F.col("schema_name"), F.col("table_name")).alias("qualified_name"))
    return named.groupBy("qualified_name").agg(F.count(F.lit(1)).alias("event_count")).select(
        "qualified_name", names.split_qualified(F.col("qualified_name")).alias("p"), "event_count").select("qualified_name", "p.*", "event_count")


def _damaged(spark, sf_dir):
    return feeds.damaged_changes(spark, sf_dir)


@query("drop_tombstones", "SELECT event_id FROM events WHERE event_id % 50 <> 1")
def _(spark, sf_dir):
    return changes.drop_tombstones(_damaged(spark, sf_dir)).select("event_id")


@query("drop_connector_heartbeats", "SELECT event_id FROM events WHERE event_id % 50 <> 3")
def _(spark, sf_dir):
    return changes.drop_connector_heartbeats(_damaged(spark, sf_dir), feeds.damaged_source(spark)).select("event_id")


_VERDICTS = """
  SELECT event_id, CASE event_id % 50 WHEN 2 THEN 'INVALID_EVENT_JSON' WHEN 4 THEN 'INVALID_SOURCE_ENVELOPE' WHEN 5 THEN 'UNEXPECTED_SOURCE_OPERATION'
    WHEN 6 THEN 'INVALID_SOURCE_ENVELOPE' WHEN 7 THEN 'UNEXPECTED_SOURCE_TABLE' WHEN 8 THEN 'INVALID_EVENT_JSON' WHEN 9 THEN 'SOURCE_KEY_MISSING'
    WHEN 10 THEN 'INVALID_SOURCE_ENVELOPE' WHEN 11 THEN 'INVALID_SOURCE_POSITION' WHEN 12 THEN 'SOURCE_COORDINATES_MISSING'
    WHEN 13 THEN 'INVALID_INTERNAL_HEARTBEAT' WHEN 15 THEN 'SOURCE_ROW_IMAGE_MISSING' END AS error_code,
    CASE event_id % 50 WHEN 1 THEN 'TOMBSTONE' WHEN 3 THEN 'CONNECTOR_HEARTBEAT' WHEN 14 THEN 'BEFORE_ACTIVATION' END AS drop_reason FROM events"""


@query("validate_envelope", _VERDICTS)
def _(spark, sf_dir):
    return changes.validate_envelope(_damaged(spark, sf_dir), feeds.damaged_source(spark)).select("event_id", "error_code", "drop_reason")


@query("quarantined_history", _sql("SELECT event_id, commit_lsn FROM f2 WHERE eid % 50 = 0 OR eid % 50 > 15", "f2"))
def _(spark, sf_dir):
    return changes.parse_change_feed(_damaged(spark, sf_dir), feeds.damaged_source(spark), on_error="quarantine").select("event_id", "commit_lsn")


@query("route_source", """
  SELECT event_id, 'T1' AS tenant_id, 'shop' AS source_id, 'dbo' AS schema_name, CASE event_id % 50 WHEN 13 THEN 'Capture_Heartbeat' ELSE 'events' END AS table_name
  FROM events WHERE event_id % 50 NOT IN (1, 2, 6, 7)""")
def _(spark, sf_dir):
    return changes.route_source(_damaged(spark, sf_dir), feeds.damaged_source(spark)).select("event_id", "tenant_id", "source_id", "schema_name", "table_name")


@query("suppress_heartbeat", "SELECT event_id, CASE event_id % 50 WHEN 13 THEN 'INVALID_INTERNAL_HEARTBEAT' END AS error_code FROM events")
def _(spark, sf_dir):
    beats = feeds.heartbeat_changes(spark, sf_dir).withColumn("event_id", F.lit(None).cast("bigint"))
    return changes.suppress_heartbeat(_damaged(spark, sf_dir).unionByName(beats), feeds.damaged_source(spark)).select("event_id", "error_code")


@query("activation_boundary", _sql(f"""
  SELECT event_id FROM f1 WHERE commit_lsn > '{_START}' UNION ALL SELECT event_id FROM f2""", "f1", "f2"))
def _(spark, sf_dir):
    both = stored_history(spark, sf_dir).select(*changes.HISTORY_COLUMNS)
    limits = spark.createDataFrame([(feeds.TENANT, feeds.SOURCE, "dbo", "orders", _START)], "tenant_id string, source_id string, schema_name string, table_name string, activation_lsn string")
    return changes.activation_boundary(both, limits).select("event_id")


@query("valid_lsn", """
  SELECT event_id, event_id % 50 NOT IN (1, 2, 11) AS is_valid, CASE WHEN event_id % 50 NOT IN (1, 2, 11) THEN '00000040' || printf('%08x', event_id) || '0002' END AS lsn_hex,
    CASE WHEN event_id % 50 NOT IN (1, 2, 11) THEN printf('%08x:%08x:%04x', 64, event_id, 2) END AS lsn_text
  FROM events""")
def _(spark, sf_dir):
    change = F.col("change_lsn")
    read = F.try_variant_get(jsonvalue.parse(F.col("value")), "$.source.change_lsn", "string").alias("change_lsn")
    return _damaged(spark, sf_dir).select("event_id", read).select("event_id", lsn.valid_lsn(change).alias("is_valid"), lsn.lsn_bytes(change).alias("lsn_hex"), lsn.lsn_text(lsn.lsn_bytes(change)).alias("lsn_text"))


_FROM, _TO = dt.datetime(1996, 3, 1, tzinfo=dt.timezone.utc), dt.datetime(1997, 3, 1, 0, 0, 2, tzinfo=dt.timezone.utc)
_SEARCHED = """FROM f1 WHERE operation = 'UPDATE' AND occurred_at BETWEEN TIMESTAMP '1996-03-01 00:00:00' AND TIMESTAMP '1997-03-01 00:00:02' AND contains(record_key, '1')"""


def _searched(spark, sf_dir):
    both = stored_history(spark, sf_dir)
    return history.history_search(both, feeds.TENANT, "dbo.orders||dbo.absent", "UPDATE", _FROM, _TO, "1")


@query("history_search", _sql(f"SELECT event_id, record_key, occurred_at {_SEARCHED}", "f1"))
def _(spark, sf_dir):
    return _searched(spark, sf_dir).select("event_id", "record_key", "occurred_at")


@query("history_page", _sql(f"SELECT {_SUMMARY}, (SELECT count(*) {_SEARCHED}) AS total_elements {_SEARCHED} ORDER BY occurred_at DESC, event_id DESC LIMIT 25 OFFSET 50", "f1"))
def _(spark, sf_dir):
    return history.history_page(_searched(spark, sf_dir), page=2, size=25)


@query("history_page_after", _sql(f"""
  SELECT {_SUMMARY}, (SELECT count(*) {_SEARCHED}) AS total_elements {_SEARCHED} AND occurred_at < TIMESTAMP '1996-10-01 00:00:00' ORDER BY occurred_at DESC, event_id DESC LIMIT 25""", "f1"))
def _(spark, sf_dir):
    return history.history_page(_searched(spark, sf_dir), size=25, after=(dt.datetime(1996, 10, 1, tzinfo=dt.timezone.utc), ""))


@query("image_path_filter", _sql("""
  SELECT event_id, operation FROM f1 WHERE json_extract_string(before_json, '$.o_orderstatus') = 'P' OR json_extract_string(after_json, '$.o_orderstatus') = 'P'""", "f1"))
def _(spark, sf_dir):
    return history.image_path_filter(stored_orders(spark, sf_dir), "$.o_orderstatus", "P").select("event_id", "operation")


@query("image_path_filter_columns", _sql("""
  SELECT event_id, operation FROM f1 WHERE json_extract_string(before_json, '$.o_orderstatus') = 'P' OR json_extract_string(after_json, '$.o_orderstatus') = 'P'""", "f1"))
def _(spark, sf_dir):
    """The same search by the images' columns."""
    path, stored = run_folder(spark, "images"), stored_orders(spark, sf_dir)
    storage.append_images(stored, path, 0)
    return history.image_path_filter(stored, "$.o_orderstatus", "P", storage.read_images(spark, path)).select("event_id", "operation")


@query("tenant_guard", _sql("SELECT event_id, CASE WHEN operation = 'DELETE' THEN 'MESSAGE_TENANT_MISMATCH' END AS error_code FROM f1", "f1"))
def _(spark, sf_dir):
    foreign = stored_orders(spark, sf_dir).withColumn("tenant_id", F.when(F.col("operation") == "DELETE", "T2").otherwise(F.col("tenant_id")))
    return history.tenant_guard(foreign, feeds.TENANT, feeds.SOURCE).select("event_id", "error_code")


@query("replay_from", _sql("SELECT event_id, commit_lsn FROM f2 WHERE eid > 500 OR (eid = 500 AND event_serial_no > 1)", "f2"))
def _(spark, sf_dir):
    return history.replay_from(stored_events(spark, sf_dir), "00000040:000001f4:0003", "00000040:000001f4:0002", 1).select("event_id", "commit_lsn")


@query("dedupe_events", _sql("SELECT event_id, captured_at FROM f1 WHERE o_orderkey % 3 <> 0", "f1"))
def _(spark, sf_dir):
    batch = changes.parse_change_feed(feeds.replayed_changes(spark, sf_dir), feeds.shop_source(spark))
    held = stored_orders(spark, sf_dir).filter(F.get_json_object("record_key", "$.o_orderkey").cast("bigint") % 3 == 0)
    return history.dedupe_events(batch, held).select("event_id", "captured_at")


def _reconciled(spark, sf_dir):
    """History that lost every seventh order and holds every eleventh twice."""
    stored = stored_orders(spark, sf_dir).withColumn("_k", F.get_json_object("record_key", "$.o_orderkey").cast("bigint"))
    kept = stored.filter(F.col("_k") % 7 != 0)
    held = kept.unionByName(kept.filter(F.col("_k") % 11 == 0))
    rows = reconcile.changes_to_reconcile(feeds.orders_change_table(spark, sf_dir), feeds.TENANT, feeds.SOURCE, "dbo", "orders")
    return reconcile.reconcile_source(rows, held)


_MATCHES = "CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 11 = 0 THEN 2 ELSE 1 END"


@query("reconcile_source", _sql(f"SELECT replace(commit_lsn, ':', '') AS commit_bytes, replace(change_lsn, ':', '') AS change_bytes, operation, CAST({_MATCHES} AS BIGINT) AS matches FROM f1", "f1"))
def _(spark, sf_dir):
    return _reconciled(spark, sf_dir).select("commit_bytes", "change_bytes", "operation", "matches")


@query("reconcile_summary", _sql(f"""
  SELECT 'T1' AS tenant_id, 'shop' AS source_id, 'dbo' AS schema_name, 'orders' AS table_name, count(*) AS expected,
    count(*) FILTER ({_MATCHES} = 0) AS missing, count(*) FILTER ({_MATCHES} > 1) AS duplicated FROM f1""", "f1"))
def _(spark, sf_dir):
    return reconcile.reconcile_summary(_reconciled(spark, sf_dir))


_COUNTS = "SELECT schema_name, table_name, operation, count(*) AS {} FROM (SELECT schema_name, table_name, operation FROM f1 UNION ALL SELECT schema_name, table_name, operation FROM f2) GROUP BY ALL"


@query("event_counts", _sql(_COUNTS.format("event_count"), "f1", "f2"))
def _(spark, sf_dir):
    return history.event_counts(stored_history(spark, sf_dir))


@query("filter_values", _sql("""
  SELECT item, count(*) OVER () > 30 AS has_next FROM (
    SELECT DISTINCT schema_name || '.' || table_name AS item FROM (SELECT schema_name, table_name, tenant_id FROM f1 UNION ALL SELECT schema_name, table_name, tenant_id FROM f2)
    WHERE tenant_id = 'T1' AND contains(lower(schema_name || '.' || table_name), 'dbo.'))
  ORDER BY item LIMIT 30""", "f1", "f2"))
def _(spark, sf_dir):
    return history.filter_values(stored_history(spark, sf_dir), feeds.TENANT, "DBO.")


@query("source_progress", """
  SELECT 'T1' AS tenant_id, 'shop' AS source_id, printf('%08x:%08x:%04x', 64, e, slot) AS commit_lsn, printf('%08x:%08x:%04x', 64, e, slot - 1) AS change_lsn, CAST(serial AS BIGINT) AS event_serial_no
  FROM (SELECT event_id AS e, 6 AS slot, 2 AS serial FROM events WHERE event_id % 100 = 0
        UNION ALL SELECT eid, 3, CASE WHEN peid IS NOT NULL AND event_type <> 'error' THEN 2 ELSE 1 END
        FROM (SELECT event_id AS eid, event_type, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS peid FROM events))
  ORDER BY e DESC, slot DESC LIMIT 1""")
def _(spark, sf_dir):
    feed = feeds.events_changes(spark, sf_dir).unionByName(feeds.heartbeat_changes(spark, sf_dir))
    return changes.source_progress(changes.examine(feed, feeds.shop_source(spark)))


@query("last_event", _sql("SELECT 'T1' AS tenant_id, 'shop' AS source_id, event_id, occurred_at, commit_lsn FROM f2 ORDER BY commit_lsn DESC LIMIT 1", "f2"))
def _(spark, sf_dir):
    return history.last_event(stored_history(spark, sf_dir))


_CHAINED = "(SELECT event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events)"


@query("acceptance_check", _sql(f"""
  SELECT *, row_count = expected_count AND distinct_ids = row_count AS passed FROM (
    SELECT schema_name, table_name, operation, count(*) AS row_count, count(DISTINCT event_id) AS distinct_ids,
      CASE WHEN table_name = 'orders' AND operation = 'INSERT' THEN (SELECT count(*) FROM orders)
        WHEN table_name = 'orders' AND operation = 'UPDATE' THEN (SELECT count(*) FROM orders WHERE o_orderstatus <> 'O')
        WHEN table_name = 'orders' THEN (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0)
        WHEN operation = 'INSERT' THEN (SELECT count(DISTINCT user_id) FROM events)
        WHEN operation = 'UPDATE' THEN (SELECT count(*) FROM {_CHAINED} WHERE place > 1 AND event_type <> 'error')
        ELSE (SELECT count(*) FROM {_CHAINED} WHERE place > 1 AND event_type = 'error') END AS expected_count
    FROM (SELECT {_HISTORY} FROM f1 UNION ALL SELECT {_HISTORY} FROM f2) GROUP BY ALL)""", "f1", "f2"))
def _(spark, sf_dir):
    # What the recipe of each feed promises, counted on the given tables rather than on the history.
    orders = feeds.table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("INSERT"), F.count_if(F.col("o_orderstatus") != "O").alias("UPDATE"), F.count_if(F.col("o_orderkey") % 10 == 0).alias("DELETE"),
    ).select(F.lit("orders").alias("table_name"), F.expr("stack(3, 'INSERT', `INSERT`, 'UPDATE', `UPDATE`, 'DELETE', `DELETE`) AS (operation, expected_count)"))
    first = F.min_by("event_type", F.struct("ts", "event_id"))
    users = feeds.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), (first == "error").cast("int").alias("first_error"))
    counted = users.agg(F.count(F.lit(1)).alias("INSERT"), F.sum(F.col("errors") - F.col("first_error")).alias("DELETE"),
                        F.sum(F.col("n") - 1 - F.col("errors") + F.col("first_error")).alias("UPDATE"))
    events = counted.select(F.lit("events").alias("table_name"), F.expr("stack(3, 'INSERT', `INSERT`, 'UPDATE', `UPDATE`, 'DELETE', `DELETE`) AS (operation, expected_count)"))
    expected = orders.unionByName(events).withColumn("schema_name", F.lit("dbo"))
    return history.acceptance_check(stored_history(spark, sf_dir), expected)


@query("retention_prune", _sql(f"SELECT event_id, occurred_at FROM f1 WHERE event_id IN ({_PRUNED})", "f1"))
def _(spark, sf_dir):
    return history.retention_prune(stored_orders(spark, sf_dir), feeds.TENANT, _CUTOFF, 500).select("event_id", "occurred_at")


@query("position_order", _sql("SELECT commit_lsn, change_lsn, event_serial_no, event_id FROM f1 ORDER BY commit_lsn, change_lsn, event_serial_no", "f1"))
def _(spark, sf_dir):
    return history.position_order(stored_orders(spark, sf_dir)).select("commit_lsn", "change_lsn", "event_serial_no", "event_id")


@query("stream_history", _F1_HISTORY_SQL)
def _(spark, sf_dir):
    folder, path = run_folder(spark, "replays"), run_folder(spark, "history")
    # The first copies are delivered before the replays; files are read in the order in which they came.
    for replayed in (False, True):
        feeds.replayed_changes(spark, sf_dir, replayed).write.mode("append").parquet(folder)
    started = streams.stream_history(
        sources.stream_change_feed(spark, folder, max_files=4), feeds.shop_source(spark), path, run_folder(spark, "checkpoint"),
        wire_path=run_folder(spark, "wire"), available_now=True)
    started.awaitTermination()
    return storage.read_history(spark, path).select(*changes.HISTORY_COLUMNS)


@query("stream_restart_history", _sql("SELECT event_id, operation FROM f1", "f1"))
def _(spark, sf_dir):
    """Two streams with checkpoints of their own write one history; both have a batch 0, and some events reach both."""
    path = run_folder(spark, "history")
    half = F.pmod(F.xxhash64("value", F.lit(1)), F.lit(2))
    for part in (0, 1):
        folder = run_folder(spark, "half")
        feeds.replayed_changes(spark, sf_dir).filter((half == part) | (F.pmod(F.xxhash64("key"), F.lit(5)) == 0)).write.parquet(folder)
        streams.stream_history(
            sources.stream_change_feed(spark, folder), feeds.shop_source(spark), path, run_folder(spark, "checkpoint"), available_now=True).awaitTermination()
    return storage.read_history(spark, path).select("event_id", "operation")


@query("stream_dedupe", _sql("SELECT event_id, operation FROM f1", "f1"))
def _(spark, sf_dir):
    folder = run_folder(spark, "replays")
    # Old events and replays arrive in any of several batches.
    feeds.replayed_changes(spark, sf_dir).repartition(6, F.xxhash64("value")).write.parquet(folder)
    parsed = changes.parse_change_feed(sources.stream_change_feed(spark, folder, max_files=2), feeds.shop_source(spark))
    return _drain(streams.stream_dedupe(parsed).select("event_id", "operation"), spark)


@query("stream_dedupe_bounded", _sql("SELECT event_id, operation FROM f1", "f1"))
def _(spark, sf_dir):
    """State for a second only; all events occurred longer ago than that, and replays come in any of several batches."""
    folder, path = run_folder(spark, "replays"), run_folder(spark, "history")
    feeds.replayed_changes(spark, sf_dir).repartition(6, F.xxhash64("value", "key")).write.parquet(folder)
    parsed = changes.parse_change_feed(sources.stream_change_feed(spark, folder, max_files=2), feeds.shop_source(spark))
    streams.stream_dedupe_bounded(parsed, path, run_folder(spark, "checkpoint"), horizon="1 second", available_now=True).awaitTermination()
    return storage.read_history(spark, path).select("event_id", "operation")


@query("stream_progress", _sql("SELECT 'T1' AS tenant_id, 'shop' AS source_id, commit_lsn, change_lsn, event_serial_no FROM f1 ORDER BY commit_lsn DESC LIMIT 1", "f1"))
def _(spark, sf_dir):
    path = run_folder(spark, "progress")
    progress = streams.stream_progress(sources.stream_change_feed(spark, _stored_feed(spark, sf_dir, "feed"), max_files=4), feeds.shop_source(spark))
    started = (
        progress.writeStream.outputMode("complete").foreachBatch(lambda batch, n: storage.write_snapshot(batch, path, n))
        .option("checkpointLocation", run_folder(spark, "checkpoint")).trigger(availableNow=True).start())
    started.awaitTermination()
    return storage.read_snapshot(spark, path)


def _quarantined(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """History and held records: one source's damaged feed is held whole while the other source's history is written."""
    folder, path, waiting = run_folder(spark, "mixed"), run_folder(spark, "history"), run_folder(spark, "held")
    other = "capture-T2-other"
    bad = feeds.damaged_changes(spark, sf_dir).drop("event_id").withColumn("destination", F.lit(f"{other}.shop.dbo.events"))
    feeds.orders_changes(spark, sf_dir).unionByName(bad).write.parquet(folder)
    second = feeds.shop_source(spark).withColumn("tenant_id", F.lit("T2")).withColumn("source_id", F.lit("other"))
    started = streams.stream_quarantine(
        sources.stream_change_feed(spark, folder), feeds.shop_source(spark).unionByName(second), path, waiting,
        run_folder(spark, "checkpoint"), available_now=True)
    started.awaitTermination()
    return storage.read_history(spark, path), storage.read_snapshot(spark, waiting)


@query("stream_quarantine", _sql("SELECT event_id, operation FROM f1", "f1"))
def _(spark, sf_dir):
    return _quarantined(spark, sf_dir)[0].select("event_id", "operation")


@query("stream_quarantine_held", _sql("""
  SELECT 'history' AS place, count(*) AS records, count(*) FILTER (before_json IS NOT NULL) AS marked FROM f1
  UNION ALL SELECT 'held', count(*), count(*) FILTER (eid % 50 = 1) FROM f2""", "f1", "f2"))
def _(spark, sf_dir):
    """Nothing is skipped: what is not in the history is held, tombstones (counted here as marked) too."""
    stored, held = _quarantined(spark, sf_dir)

    def counted(rows, place, marked):
        return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(marked).alias("marked")).select(F.lit(place).alias("place"), "records", "marked")

    return counted(stored, "history", F.col("before_json").isNotNull()).unionByName(counted(held, "held", F.col("value").isNull()))


@query("stream_quarantine_retry", _sql("SELECT event_id, operation, tenant_id FROM (SELECT event_id, operation, 'T1' AS tenant_id FROM f1 UNION ALL SELECT record_key, operation, 'T2' FROM f1)", "f1"))
def _(spark, sf_dir):
    """A second source waits because its tables are not listed; once they are, the next tick delivers it, without any new file."""
    folder, path, waiting, checkpoint = run_folder(spark, "mixed"), run_folder(spark, "history"), run_folder(spark, "held"), run_folder(spark, "checkpoint")
    orders = feeds.orders_changes(spark, sf_dir)
    orders.unionByName(orders.withColumn("destination", F.lit("capture-T2-other.shop.dbo.orders"))).write.parquet(folder)
    first = feeds.shop_source(spark)
    second = first.withColumn("tenant_id", F.lit("T2")).withColumn("source_id", F.lit("other"))
    for tables in (F.array(F.lit("dbo.absent")), F.col("tables")):
        current = first.unionByName(second.withColumn("tables", tables))
        query = streams.stream_isolated(sources.stream_change_feed(spark, folder), current, path, waiting, checkpoint, retry_seconds=1)
        repaired = storage.path_exists(spark, path)
        deadline = time.time() + 600
        while query.isActive and time.time() < deadline and not (bool(storage.held_connectors(spark, waiting)) != repaired and storage.path_exists(spark, path)):
            query.awaitTermination(1)
        query.stop()
    # Ids of the second tenant differ from the first one's; it is told by its keys.
    named = F.when(F.col("tenant_id") == "T2", F.col("record_key")).otherwise(F.col("event_id"))
    return storage.read_history(spark, path).select(named.alias("event_id"), "operation", "tenant_id")
