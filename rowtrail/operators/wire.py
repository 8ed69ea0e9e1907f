"""Wire form of history events for independent subscribers: ``{version, incarnation, event}``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtrail.functions import identity, jsonvalue, names
from rowtrail.functions.sizing import bounded_broadcast
from rowtrail.operators.changes import HISTORY_COLUMNS
from rowtrail.operators.settings import prepare_sources

WIRE_VERSION = 1
INVALID_WIRE_EVENT = "INVALID_BROKER_EVENT"
UNKNOWN_WIRE_SOURCE = "UNKNOWN_WIRE_SOURCE"

# JSON name of each history column inside the wire event.
WIRE_NAMES = {
    "event_id": "eventId", "tenant_id": "tenantId", "source_id": "sourceId", "schema_name": "schemaName",
    "table_name": "tableName", "operation": "operation", "occurred_at": "occurredAt", "captured_at": "capturedAt",
    "record_key": "recordKey", "before_json": "beforeJson", "after_json": "afterJson",
    "changed_properties": "changedProperties", "commit_lsn": "commitLsn", "change_lsn": "changeLsn",
    "event_serial_no": "eventSerialNo",
}
_INSTANTS = {"occurred_at", "captured_at"}
_WIRE_SCHEMA = "version bigint, incarnation string, event struct<" + ", ".join(
    f"{WIRE_NAMES[c]}: {'bigint' if c == 'event_serial_no' else 'string'}" for c in HISTORY_COLUMNS) + ">"


def wire_encode(history: DataFrame, sources: DataFrame) -> DataFrame:
    """``(event_id, body)`` with nulls written out and instants as ISO text in UTC.

    An event of a source that is not listed stops the job: it must not go missing.
    """
    known = sources.select("tenant_id", "source_id", "incarnation", F.lit(True).alias("_listed")).distinct()
    event = F.struct(*[
        (F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if c in _INSTANTS else F.col(c)).alias(WIRE_NAMES[c])
        for c in HISTORY_COLUMNS])
    body = F.to_json(F.struct(F.lit(WIRE_VERSION).alias("version"), F.col("incarnation"), event.alias("event")), {"ignoreNullFields": "false"})
    return history.join(bounded_broadcast(known), ["tenant_id", "source_id"], "left").select(
        "event_id", F.when(F.col("_listed"), body).otherwise(F.raise_error(F.lit(UNKNOWN_WIRE_SOURCE)).cast("string")).alias("body"))


def wire_decode(wire: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """History columns of each body with ``error_code`` where it cannot be trusted.

    A body must carry this version, its source's incarnation, an allowlisted table (the heartbeat table
    is not one of them), both times, and an id equal to the one its coordinates give.
    """
    read = wire.select("*", F.from_json("body", _WIRE_SCHEMA).alias("_w"))
    opened = read.select(
        "_w.version", F.col("_w.incarnation").alias("_incarnation"),
        *[(F.try_to_timestamp(F.col(f"_w.event.{n}")) if c in _INSTANTS else F.col(f"_w.event.{n}")).alias(c) for c, n in WIRE_NAMES.items()])
    known = prepare_sources(sources, heartbeat_table).select(
        "tenant_id", "source_id", F.struct("incarnation", "tables").alias("src"))
    joined = opened.join(bounded_broadcast(known), ["tenant_id", "source_id"], "left")
    recomputed = identity.event_id(
        F.col("tenant_id"), F.col("source_id"), F.col("src.incarnation"), F.col("schema_name"), F.col("table_name"),
        F.col("commit_lsn"), F.col("change_lsn"), F.col("event_serial_no"), F.col("operation"),
        jsonvalue.canonical(F.col("record_key"), jsonvalue.parse(F.col("record_key")), jsonvalue.parse(jsonvalue.marked(F.col("record_key")))))
    trusted = F.coalesce(
        (F.col("version") == WIRE_VERSION) & (F.col("_incarnation") == F.col("src.incarnation"))
        & F.array_contains("src.tables", names.qualified(F.col("schema_name"), F.col("table_name")))
        & F.col("occurred_at").isNotNull() & F.col("captured_at").isNotNull() & (recomputed == F.col("event_id")), F.lit(False))
    return joined.select(*HISTORY_COLUMNS, F.when(~trusted, INVALID_WIRE_EVENT).alias("error_code"))
