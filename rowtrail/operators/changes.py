"""Change feed to history events: unwrap, validate, route, derive.

``feed`` holds ``key``, ``value`` and ``destination`` (and optionally ``captured_at``). Each value is
parsed once to VARIANT; checks read that, and the costly fields (names that changed, identity) are
computed only for the records that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtrail.functions import identity, jsonvalue, lsn, names
from rowtrail.functions.sizing import bounded_broadcast
from rowtrail.operators.settings import prepare_sources

# Outcomes of a record in the order they are tested.
INVALID_JSON = "INVALID_EVENT_JSON"
INVALID_ENVELOPE = "INVALID_SOURCE_ENVELOPE"
UNEXPECTED_OPERATION = "UNEXPECTED_SOURCE_OPERATION"
UNEXPECTED_TABLE = "UNEXPECTED_SOURCE_TABLE"
KEY_MISSING = "SOURCE_KEY_MISSING"
INVALID_POSITION = lsn.INVALID_POSITION
COORDINATES_MISSING = "SOURCE_COORDINATES_MISSING"
INVALID_HEARTBEAT = "INVALID_INTERNAL_HEARTBEAT"
IMAGE_MISSING = "SOURCE_ROW_IMAGE_MISSING"
DROP_TOMBSTONE = "TOMBSTONE"
DROP_CONNECTOR_HEARTBEAT = "CONNECTOR_HEARTBEAT"
DROP_HEARTBEAT = "HEARTBEAT"
DROP_BEFORE_ACTIVATION = "BEFORE_ACTIVATION"

HISTORY_COLUMNS = [
    "event_id", "tenant_id", "source_id", "schema_name", "table_name", "operation", "occurred_at", "captured_at",
    "record_key", "before_json", "after_json", "changed_properties", "commit_lsn", "change_lsn", "event_serial_no",
]

#: What :func:`history_events` reads of an examined feed, and the connector of a record.
EXAMINED_COLUMNS = [
    "verdict", "_connector", "src", "_op", "_schema", "_table", "_commit", "_change", "_serial", "_millis", "_record_key", "_has_before", "_has_after", "_before_text", "_after_text",
]

# The envelope's source fields.
_SOURCE_TEXTS = {"_db": "db", "_schema": "schema", "_table": "table", "_commit": "commit_lsn", "_change": "change_lsn"}
_SOURCE_NUMBERS = {"_serial": "event_serial_no", "_millis": "ts_ms"}
_SOURCE_FIELDS = [*_SOURCE_TEXTS.values(), *_SOURCE_NUMBERS.values()]
# A value is read twice: as VARIANTs, which tell the kinds of its fields, and as text. Row images are kept
# as text the way the source wrote them (name order, number form).
_KIND_TYPE = "struct<" + ", ".join(f"{name}: variant" for name in _SOURCE_FIELDS) + ">"
# An image needs no fields of its own here: as a struct it is null unless it is an object.
_ENVELOPE_FIELDS = {"op": "variant", "source": _KIND_TYPE, "before": "struct<_: boolean>", "after": "struct<_: boolean>"}
_ENVELOPE_TYPE = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in _ENVELOPE_FIELDS.items()) + ">"
_WRAPPER_TYPE = "struct<schema: variant, payload: variant>"
# All that is read of a value by one pass over its VARIANT, wrapped or not.
_VALUE_TYPE = f"{_ENVELOPE_TYPE[:-1]}, {_WRAPPER_TYPE.removeprefix('struct<')}"
_TEXT_FIELDS = "op: string, before: string, after: string, source: struct<" + ", ".join(f"{name}: string" for name in _SOURCE_FIELDS) + ">"
_TEXT_SCHEMA = f"struct<{_TEXT_FIELDS}, payload: struct<{_TEXT_FIELDS}>>"


def map_operation(op: Column) -> Column:
    """c, u, d to INSERT, UPDATE, DELETE; null for every other letter."""
    return F.when(op == "c", "INSERT").when(op == "u", "UPDATE").when(op == "d", "DELETE")


def occurred_at(epoch_millis: Column) -> Column:
    return F.timestamp_millis(epoch_millis)


def drop_tombstones(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("value").isNotNull())


def drop_connector_heartbeats(feed: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Drop a connector's own heartbeats once their value has parsed (a broken one stays and fails later).

    With ``sources`` only their connectors' heartbeats go; another connector's stays to be reported.
    """
    value = jsonvalue.parse(F.col("value"))
    readable = F.col("value").isNotNull() & ~jsonvalue.malformed(F.col("value"), value)
    heartbeat = F.coalesce(F.startswith(F.col("destination"), F.lit(names.CONNECTOR_HEARTBEAT)), F.lit(False)) & readable
    if sources is None:
        return feed.filter(~heartbeat)
    known = prepare_sources(sources).select(F.col("connector").alias("_known")).distinct()
    return (
        feed.withColumn("_connector", _connector(feed))
        .join(bounded_broadcast(known), F.col("_connector") == F.col("_known"), "left")
        .filter(~(heartbeat & F.col("_known").isNotNull()))
        .drop("_connector", "_known")
    )


def _connector(feed: DataFrame) -> Column:
    """The reader a record came through: named by the feed, or the first part of its destination."""
    if "connector" in feed.columns:
        return F.col("connector")
    destination = F.col("destination")
    after_prefix = F.substring(destination, F.lit(len(names.CONNECTOR_HEARTBEAT) + 1), F.length(destination))
    return F.when(F.startswith(destination, F.lit(names.CONNECTOR_HEARTBEAT)), after_prefix).otherwise(
        F.substring_index(destination, ".", 1))


def unwrap_payload(feed: DataFrame) -> DataFrame:
    """Key and value without their ``schema``/``payload`` wrapper, as JSON text; broken JSON gives null."""
    documents = feed.withColumn("_key", jsonvalue.parse(F.col("key"))).withColumn("_value", jsonvalue.parse(F.col("value")))
    return documents.withColumn("key", F.to_json(jsonvalue.payload(F.col("_key")))).withColumn(
        "value", F.to_json(jsonvalue.payload(F.col("_value")))).drop("_key", "_value")


def _read(feed: DataFrame) -> DataFrame:
    """Parse both documents of each record once."""
    return feed.select(
        "*",
        _connector(feed).alias("_connector"),
        jsonvalue.parse(F.col("key")).alias("_key_read"),
        jsonvalue.parse(F.col("value")).alias("_value_read"),
    )


def _fields(feed: DataFrame) -> DataFrame:
    """The envelope's fields as typed columns, null where missing or of another kind."""
    documents = _read(feed).select(
        "*",
        F.from_json("value", _TEXT_SCHEMA).alias("_text"),
        jsonvalue.malformed(F.col("key"), F.col("_key_read")).alias("_key_malformed"),
        jsonvalue.malformed(F.col("value"), F.col("_value_read")).alias("_value_malformed"),
        F.try_variant_get("_key_read", "$", _WRAPPER_TYPE).alias("_key_top"),
        F.try_variant_get("_value_read", "$", _VALUE_TYPE).alias("_top"),
    )
    wrapped, wrapped_key = [F.col(f"{top}.schema").isNotNull() & F.col(f"{top}.payload").isNotNull() for top in ("_top", "_key_top")]
    own = F.struct(*[F.col(f"_top.{name}") for name in _ENVELOPE_FIELDS])
    text = F.col("_text")
    opened = documents.select(
        *[F.col(c) for c in feed.columns], "_connector", "_key_malformed", "_value_malformed",
        F.when(wrapped_key, F.col("_key_top.payload")).otherwise(F.col("_key_read")).alias("_key"),
        F.when(wrapped, F.try_variant_get("_top.payload", "$", _ENVELOPE_TYPE)).otherwise(own).alias("_value"),
        *[F.when(wrapped, text["payload"][name]).otherwise(text[name]).alias(f"_text_{name}") for name in ("op", "before", "after", "source")],
    )
    parts = opened.select(
        *[F.col(c) for c in opened.columns if c != "_value"],
        jsonvalue.canonical(F.col("key"), F.col("_key"), jsonvalue.payload(jsonvalue.parse(jsonvalue.marked(F.col("key"))))).alias("_record_key"),
        F.col("_value.op").alias("_op_kind"), F.col("_value.source").alias("_kinds"),
        *[F.col(f"_value.{side}").isNotNull().alias(f"_has_{side}") for side in ("before", "after")],
    )
    return parts.select(
        *[F.col(c) for c in parts.columns if c not in ("_op_kind", "_kinds", "_text_op", "_text_source", "_text_before", "_text_after")],
        jsonvalue.text_if_string(F.col("_op_kind"), F.col("_text_op")).alias("_op"),
        *[jsonvalue.text_if_string(F.col(f"_kinds.{name}"), F.col(f"_text_source.{name}")).alias(alias) for alias, name in _SOURCE_TEXTS.items()],
        *[jsonvalue.long_if_number(F.col(f"_kinds.{name}"), F.col(f"_text_source.{name}")).alias(alias) for alias, name in _SOURCE_NUMBERS.items()],
        *[F.when(F.col(f"_has_{side}"), F.col(f"_text_{side}")).alias(f"_{side}_text") for side in ("before", "after")],
    )


def _routed(feed: DataFrame, sources: DataFrame, heartbeat_table: str) -> DataFrame:
    """Typed fields with the source each record belongs to.

    Fields are computed below the join and rules are tested above it, so that a filter on a rule reads
    the finished fields instead of being pushed down and parsing every document again.
    """
    # "src" is one struct so that source columns cannot clash with the feed's.
    known = prepare_sources(sources, heartbeat_table).select(
        F.col("connector").alias("_route"),
        F.struct("tenant_id", "source_id", "database", "captured", "boundaries", "incarnation", "heartbeat_table").alias("src"),
    )
    return _fields(feed).join(bounded_broadcast(known), F.col("_connector") == F.col("_route"), "left").drop("_route")


def _route_rejected() -> Column:
    """The record's database or table is not one its source captures (or no source claims the record)."""
    return ~F.coalesce(
        (F.col("_db") == F.col("src.database")) & F.array_contains("src.captured", _qualified()), F.lit(False))


def _qualified() -> Column:
    return names.qualified(F.col("_schema"), F.col("_table"))


def _is_heartbeat_table() -> Column:
    return F.coalesce(_qualified() == F.col("src.heartbeat_table"), F.lit(False))


def _good_heartbeat() -> Column:
    singleton = jsonvalue.at(F.col("_key"), "$.singleton_id")
    is_one = jsonvalue.is_integral(singleton) & (F.try_variant_get(singleton, "$", "bigint") == 1)
    return F.coalesce(is_one & F.col("_op").isin("c", "u"), F.lit(False))


def _verdict(on_error: str = "report") -> Column:
    """First rule a record meets, null for a good record; ``on_error="fail"`` stops the job at a broken one.

    Drops and errors share one ordered chain, so each rule sees the earlier ones pass.
    """
    def error(code: str) -> Column:
        return F.raise_error(F.lit(code)).cast("string") if on_error == "fail" else F.lit(code)

    boundary = F.try_element_at(F.col("src.boundaries"), _qualified())
    lacks_before = F.col("_op").isin("u", "d") & ~F.col("_has_before")
    lacks_after = F.col("_op").isin("c", "u") & ~F.col("_has_after")
    connector_heartbeat = F.startswith(F.col("destination"), F.lit(names.CONNECTOR_HEARTBEAT)) & F.col("src").isNotNull()
    no_key = F.coalesce(~F.startswith(F.col("_record_key"), F.lit("{")) | (F.col("_record_key") == "{}"), F.lit(True))
    return (
        F.when(F.col("value").isNull(), F.lit(DROP_TOMBSTONE))
        .when(F.col("_value_malformed"), error(INVALID_JSON))
        .when(connector_heartbeat, F.lit(DROP_CONNECTOR_HEARTBEAT))
        .when(F.col("_op").isNull(), error(INVALID_ENVELOPE))
        .when(~F.col("_op").isin("c", "u", "d"), error(UNEXPECTED_OPERATION))
        .when(F.col("_schema").isNull() | F.col("_table").isNull() | F.col("_db").isNull(), error(INVALID_ENVELOPE))
        .when(_route_rejected(), error(UNEXPECTED_TABLE))
        .when(F.col("_key_malformed"), error(INVALID_JSON))
        .when(no_key, error(KEY_MISSING))
        .when(F.col("_commit").isNull() | F.col("_change").isNull(), error(INVALID_ENVELOPE))
        .when(~lsn.valid_lsn(F.col("_commit")) | ~lsn.valid_lsn(F.col("_change")), error(INVALID_POSITION))
        .when(F.col("_serial").isNull() | F.col("_millis").isNull(), error(COORDINATES_MISSING))
        .when(_is_heartbeat_table(), F.when(_good_heartbeat(), F.lit(DROP_HEARTBEAT)).otherwise(error(INVALID_HEARTBEAT)))
        .when(boundary.isNotNull() & (lsn.lsn_bytes(F.col("_commit")) <= lsn.lsn_bytes(boundary)), F.lit(DROP_BEFORE_ACTIVATION))
        .when(lacks_before | lacks_after, error(IMAGE_MISSING))
    )


def _is_drop(verdict: Column) -> Column:
    return verdict.isin(DROP_TOMBSTONE, DROP_CONNECTOR_HEARTBEAT, DROP_HEARTBEAT, DROP_BEFORE_ACTIVATION)


def examine(feed: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE, on_error: str = "report") -> DataFrame:
    """Feed columns, typed fields (underscored) and ``verdict``: null means the record becomes history."""
    return _routed(feed, sources, heartbeat_table).withColumn("verdict", _verdict(on_error))


def validate_envelope(feed: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Every record with ``error_code`` (first broken rule) or ``drop_reason``; both null means it is good."""
    verdict = F.col("verdict")
    return examine(feed, sources, heartbeat_table).select(
        *[F.col(c) for c in feed.columns],
        F.when(~_is_drop(verdict), verdict).alias("error_code"),
        F.when(_is_drop(verdict), verdict).alias("drop_reason"),
    )


def route_source(feed: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Records of a captured table of their source, with the tenant, source and table they belong to."""
    return _routed(feed, sources, heartbeat_table).filter(~_route_rejected()).select(
        *[F.col(c) for c in feed.columns],
        F.col("src.tenant_id").alias("tenant_id"), F.col("src.source_id").alias("source_id"),
        F.col("_schema").alias("schema_name"), F.col("_table").alias("table_name"),
    )


def suppress_heartbeat(feed: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Feed without the internal heartbeat's good rows; its bad rows stay with their error code."""
    return _routed(feed, sources, heartbeat_table).filter(~(_is_heartbeat_table() & _good_heartbeat())).select(
        *[F.col(c) for c in feed.columns], F.when(_is_heartbeat_table(), INVALID_HEARTBEAT).alias("error_code"))


def activation_boundary(events: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Events strictly after their table's activation position; tables without one keep all.

    ``boundaries`` holds one row per ``(tenant_id, source_id, schema_name, table_name)`` with ``activation_lsn``.
    """
    keys = ["tenant_id", "source_id", "schema_name", "table_name"]
    limits = boundaries.select(*keys, lsn.lsn_bytes(F.col("activation_lsn")).alias("_activation"))
    return (
        events.join(bounded_broadcast(limits), keys, "left")
        .filter(~F.coalesce(lsn.lsn_bytes(F.col("commit_lsn")) <= F.col("_activation"), F.lit(False)))
        .select(*[F.col(c) for c in events.columns])
    )


def history_events(examined: DataFrame, captured_at: Column | None = None) -> DataFrame:
    """History rows of the good records of an examined feed."""
    if "captured_at" in examined.columns:
        captured_at = F.col("captured_at")
    elif captured_at is None:
        raise ValueError("the feed carries no captured_at, so one must be given")
    good = examined.filter(F.col("verdict").isNull()).select(
        "*", map_operation(F.col("_op")).alias("operation"), captured_at.alias("_captured_at"))
    derived = jsonvalue.with_differing_names(good, "_changed", "_has_before", "_has_after", "_before_text", "_after_text")
    return derived.select(
        identity.event_id(
            F.col("src.tenant_id"), F.col("src.source_id"), F.col("src.incarnation"), F.col("_schema"), F.col("_table"),
            F.col("_commit"), F.col("_change"), F.col("_serial"), F.col("operation"), F.col("_record_key")).alias("event_id"),
        F.col("src.tenant_id").alias("tenant_id"),
        F.col("src.source_id").alias("source_id"),
        F.col("_schema").alias("schema_name"),
        F.col("_table").alias("table_name"),
        "operation",
        occurred_at(F.col("_millis")).alias("occurred_at"),
        F.col("_captured_at").alias("captured_at"),
        F.col("_record_key").alias("record_key"),
        F.col("_before_text").alias("before_json"),
        F.col("_after_text").alias("after_json"),
        F.to_json("_changed").alias("changed_properties"),
        F.col("_commit").alias("commit_lsn"),
        F.col("_change").alias("change_lsn"),
        F.col("_serial").alias("event_serial_no"),
    )


def parse_change_feed(feed: DataFrame, sources: DataFrame, captured_at: Column | None = None, on_error: str = "fail",
                      heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Change feed to history events.

    ``on_error="fail"`` stops the job at the first broken record, since a record is never skipped.
    ``"quarantine"`` returns the good ones; take the rest from :func:`validate_envelope` and hold them.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    return history_events(examine(feed, sources, heartbeat_table, on_error), captured_at)


def canonical_key(frame: DataFrame, column: str = "key") -> DataFrame:
    return frame.withColumn("record_key", jsonvalue.canonical(F.col(column), jsonvalue.parse(F.col(column)), jsonvalue.parse(jsonvalue.marked(F.col(column)))))


def changed_properties(frame: DataFrame, before: str = "before_json", after: str = "after_json") -> DataFrame:
    """Add the ordered JSON list of names whose typed value differs between two row images."""
    images = frame.withColumn("_b", jsonvalue.is_object(jsonvalue.parse(F.col(before)))).withColumn(
        "_a", jsonvalue.is_object(jsonvalue.parse(F.col(after))))
    compared = jsonvalue.with_differing_names(images, "_changed", "_b", "_a", before, after)
    return compared.withColumn("changed_properties", F.to_json("_changed")).drop("_b", "_a", "_changed")


def changed_name_union(frame: DataFrame, before: str = "before_json", after: str = "after_json") -> DataFrame:
    """Add the ordered JSON list of all names in either image."""
    both = F.array_union(
        jsonvalue.names(jsonvalue.object_at(jsonvalue.parse(F.col(before)), "$")),
        jsonvalue.names(jsonvalue.object_at(jsonvalue.parse(F.col(after)), "$")))
    return frame.withColumn("all_properties", F.to_json(F.sort_array(both)))


def source_progress(examined: DataFrame) -> DataFrame:
    """Greatest position per source, counting suppressed heartbeats and rows at or before an activation."""
    advances = F.col("verdict").isNull() | F.col("verdict").isin(DROP_HEARTBEAT, DROP_BEFORE_ACTIVATION)
    where = F.struct(
        lsn.position(F.col("_commit"), F.col("_change"), F.col("_serial")).alias("place"),
        F.col("_commit").alias("commit_lsn"), F.col("_change").alias("change_lsn"), F.col("_serial").alias("event_serial_no"))
    return (
        examined.filter(advances)
        .groupBy(F.col("src.tenant_id").alias("tenant_id"), F.col("src.source_id").alias("source_id"))
        .agg(F.max(where).alias("last"))
        .select("tenant_id", "source_id", "last.commit_lsn", "last.change_lsn", "last.event_serial_no")
    )
