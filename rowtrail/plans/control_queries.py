"""Queries over saved positions, table schemas and source health (F8 to F11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtrail.functions import lsn
from rowtrail.operators import monitor, positions, schema
from rowtrail.operators import registry as registry_ops
from rowtrail.plans import fleet
from rowtrail.plans.catalog import query
from rowtrail.plans.fleet import BASE_SECONDS, NOW, NOW_SECONDS, NOW_SQL, REG_LIST, replaced, sql
from rowtrail.session import run_folder
from rowtrail.sources import storage
from rowtrail.streaming import history as streams

_BASE = {"tenant_id": fleet.TENANT, "source_id": fleet.SOURCE}
_TABLE = {**_BASE, "schema_name": "'dbo'", "table_name": "name"}
_SAVED = fleet.duck_text(fleet.SAVED)

# ---------------------------------------------------------------- saved positions (F10)

# One stored position per shape, chosen by s % 12; K is the connector, D the database.
_OFFSET_VALUES = [
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":1,"extra":true}',
    '{}',
    '{"snapshot":"INITIAL","snapshot_completed":false}',
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":1}',
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":-1}',
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":null,"event_serial_no":1}',
    '{"snapshot":"INITIAL","snapshot_completed":true,"commit_lsn":"00000027:00000010:0003","change_lsn":null,"event_serial_no":1}',
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":"NULL","event_serial_no":1}',
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":"NULL","event_serial_no":2}',
    '{"commit_lsn":"NULL","change_lsn":"NULL","event_serial_no":1}',
    'not json',
    '{"commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":"1"}',
]
_OFFSET_CODES = [
    None, "SOURCE_REPLAY_COORDINATES_INVALID", "SOURCE_INITIALIZATION_INCOMPLETE", "SOURCE_OFFSET_PARTITION_CHANGED", "SOURCE_REPLAY_COORDINATES_INVALID",
    "SOURCE_REPLAY_COORDINATES_INVALID", None, None, "SOURCE_REPLAY_COORDINATES_INVALID", "INVALID_SOURCE_POSITION", "SOURCE_OFFSETS_CORRUPT",
    "SOURCE_REPLAY_COORDINATES_INVALID",
]


def _choice(column: str, values: list[str | None]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)) + " END"


_VALUE = _choice("s % 12", _OFFSET_VALUES)
_CONNECTOR = "'capture-T' || s || '-S' || s"
_KEY = f"'[\"' || {_CONNECTOR} || '\",{{\"server\":\"' || {_CONNECTOR} || '\",\"database\":\"' || CASE WHEN s % 12 = 3 THEN 'another' ELSE 'db' || s END || '\"}}]'"


def offsets(spark, sf_dir) -> DataFrame:
    """One stored position for most sources, none for every 17th and two for every 19th."""
    ids = fleet.source_keys(spark, sf_dir).filter("s % 17 <> 0").selectExpr("s", "explode(CASE WHEN s % 19 = 0 THEN array(1, 2) ELSE array(1) END) AS n")
    return fleet.spark_columns(ids, {**_BASE, "id": "'o' || s || '-' || n", "offset_key": _KEY, "offset_val": _VALUE})


_COUNTED = "CASE WHEN s % 17 = 0 THEN 0 WHEN s % 19 = 0 THEN 2 ELSE 1 END"
_POSITION_CODE = f"""CASE WHEN s % 8 = 0 AND {_COUNTED} > 0 THEN 'ACTIVATION_MISSING_FOR_EXISTING_OFFSETS' WHEN s % 8 = 0 THEN NULL WHEN s % 6 = 1 THEN 'SOURCE_CONFIGURATION_CHANGED'
  WHEN {_COUNTED} <> 1 THEN 'SOURCE_OFFSETS_MISSING_OR_AMBIGUOUS' ELSE {_choice("s % 12", _OFFSET_CODES)} END"""


@query("saved_position", sql(f"""
  SELECT tenant_id, source_id, CASE WHEN s % 8 <> 0 AND error_code IS NULL THEN '00000027:00000010:0003' END AS saved_commit, error_code
  FROM (SELECT s, 'T' || s AS tenant_id, 'S' || s AS source_id, {_POSITION_CODE} AS error_code FROM src)""", "src"))
def _(spark, sf_dir):
    return positions.saved_position(fleet.activation(spark, sf_dir), offsets(spark, sf_dir), fleet.sources(spark, sf_dir))


@query("single_offset", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, CAST(CASE WHEN s % 8 = 0 THEN 0 ELSE 1 END AS BIGINT) AS activation_rows, CAST({_COUNTED} AS BIGINT) AS offset_rows,
    CASE WHEN s % 8 = 0 THEN 'ACTIVATION_MISSING_FOR_EXISTING_OFFSETS' WHEN {_COUNTED} <> 1 THEN 'SOURCE_OFFSETS_MISSING_OR_AMBIGUOUS' END AS error_code
  FROM src WHERE s % 8 <> 0 OR {_COUNTED} > 0""", "src"))
def _(spark, sf_dir):
    return positions.single_offset(offsets(spark, sf_dir), fleet.activation(spark, sf_dir))


# Pairs of stored positions by h % 10, and whether the second is ahead.
_STEP = '{{"commit_lsn":"00000027:{0}:0003","change_lsn":"{1}","event_serial_no":{2}}}'
_STEPS = [
    (_STEP.format("00000010", "00000027:00000010:0002", 1), _STEP.format("00000010", "00000027:00000010:0002", 1), False),
    (_STEP.format("00000010", "00000027:00000010:0002", 1), _STEP.format("00000010", "00000027:00000010:0002", 2), True),
    (_STEP.format("00000010", "00000027:00000010:0002", 1), _STEP.format("0000000f", "00000027:00000010:0002", 9), False),
    (_STEP.format("00000010", "00000027:00000010:0002", 1), _STEP.format("000000ff", "NULL", 1), True),
    (_STEP.format("00000010", "NULL", 1), _STEP.format("00000010", "00000027:00000010:0002", 0), True),
    (_STEP.format("00000010", "00000027:00000010:0002", 1), _STEP.format("00000010", "NULL", 5), False),
    (None, _STEP.format("00000010", "00000027:00000010:0002", 1), True),
    (None, None, False),
    (_STEP.format("00000010", "00000027:00000010:0002", 1), "not json", False),
    (_STEP.format("00000010", "00000027:00000010:0002", 9), _STEP.format("00000010", "00000027:000000a0:0002", 1), True),
]


@query("offset_advanced", sql(f"SELECT h, {_choice('h % 10', ['true' if a else 'false' for *_, a in _STEPS])} = 'true' AS advanced FROM keys", "keys"))
def _(spark, sf_dir):
    pairs = fleet.spark_columns(fleet.keys(spark, sf_dir), {
        "h": "h", "before_val": _choice("h % 10", [b for b, *_ in _STEPS]), "after_val": _choice("h % 10", [a for _, a, _ in _STEPS])})
    return positions.offset_advanced(pairs).select("h", "advanced")


# Positions to move back by s % 6, their codes, and the target (block 15).
_REWRITES = [
    ('{"zone":"eu","commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":4}', None),
    ('{"snapshot":true,"commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":4}', "SNAPSHOT_OFFSET_NOT_SUPPORTED"),
    ('{"commit_lsn":"00000027:0000000e:0003","change_lsn":"00000027:00000010:0002","event_serial_no":4}', "CHECKPOINT_BEFORE_REPLAY_BOUNDARY"),
    ('{"commit_lsn":"00000027:00000010:0003","change_lsn":"00000027:00000010:0002","event_serial_no":"4"}', "INVALID_OFFSET_SERIAL"),
    ('[]', "INVALID_OFFSET_JSON"),
    ('{"commit_lsn":"00000027:00000010:0003","change_lsn":"NULL","event_serial_no":4}', "INVALID_SOURCE_POSITION"),
]


@query("rewrite_position", sql(f"""
  SELECT 'S' || s AS source_id, {_choice("s % 6", [c for _, c in _REWRITES])} AS error_code, CASE WHEN s % 6 = 0 THEN '00000027:0000000f:0003' END AS commit_lsn,
    CASE WHEN s % 6 = 0 THEN 'eu' END AS zone, CASE WHEN s % 6 = 0 THEN '1' END AS event_serial_no FROM src""", "src"))
def _(spark, sf_dir):
    rows = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {**_BASE, "offset_val": _choice("s % 6", [v for v, _ in _REWRITES])})
    moved = positions.rewrite_position(rows, F.lit("00000027:0000000f:0003"), F.lit("00000027:0000000f:0002"), F.lit(1))
    return moved.select("source_id", "error_code", *[F.get_json_object("replay_val", f"$.{n}").alias(n) for n in ("commit_lsn", "zone", "event_serial_no")])


@query("boundary_evidence", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, CASE s % 8 WHEN 1 THEN 'AMBIGUOUS_HEARTBEAT_BOUNDARY' WHEN 2 THEN 'HEARTBEAT_BOUNDARY_MISSING' WHEN 3 THEN 'INVALID_HEARTBEAT_BOUNDARY'
    WHEN 4 THEN 'INVALID_HEARTBEAT_BOUNDARY' WHEN 5 THEN 'INVALID_HEARTBEAT_BOUNDARY' WHEN 6 THEN 'NEW_TABLE_CHANGES_BEFORE_REPLAY_BOUNDARY' WHEN 7 THEN 'BUSINESS_CHANGE_AT_HEARTBEAT_BOUNDARY' END AS error_code FROM src""", "src"))
def _(spark, sf_dir):
    """Per source a heartbeat pair, a business row just before and a new table's row just after; each shape breaks one thing."""
    shapes = """inline(array_compact(array(
      CASE WHEN s % 8 <> 2 THEN named_struct('role', 'heartbeat', 'operation', CASE WHEN s % 8 = 4 THEN 2 ELSE 3 END, 'singleton_id', 1, 'c', 16, 'q', 2) END,
      named_struct('role', 'heartbeat', 'operation', 4, 'singleton_id', CASE WHEN s % 8 = 3 THEN 2 ELSE 1 END, 'c', 16, 'q', CASE WHEN s % 8 = 5 THEN 9 ELSE 2 END),
      CASE WHEN s % 8 = 1 THEN named_struct('role', 'heartbeat', 'operation', 4, 'singleton_id', 1, 'c', 16, 'q', 7) END,
      named_struct('role', 'new', 'operation', 2, 'singleton_id', 0, 'c', CASE WHEN s % 8 = 6 THEN 16 ELSE 17 END, 'q', 2),
      named_struct('role', 'business', 'operation', 2, 'singleton_id', 0, 'c', CASE WHEN s % 8 = 7 THEN 16 ELSE 15 END, 'q', 1))))"""
    rows = fleet.spark_columns(fleet.source_keys(spark, sf_dir).selectExpr("s", shapes), {
        **_BASE, "role": "role", "operation": "operation", "singleton_id": "singleton_id", "commit": "LSN(39, c, 3)", "change": "LSN(39, c, q)"})
    rows = rows.withColumn("start_lsn", lsn.lsn_bytes(F.col("commit"))).withColumn("seqval", lsn.lsn_bytes(F.col("change")))
    boundary = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {**_BASE, "commit_lsn": "LSN(39, 16, 3)", "change_lsn": "LSN(39, 16, 2)"})
    return positions.boundary_evidence(rows, boundary)


@query("retention_headroom", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id,
    CAST(CASE WHEN s % 10 = 0 OR s % 4 = 0 THEN 20160 * 60 ELSE least(20160 * 60, 20160 * 60 - (s % 100) * 3600) END AS BIGINT) AS headroom_seconds FROM src""", "src"))
def _(spark, sf_dir):
    saved = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        **_BASE, "retention_minutes": "20160", "saved_time": f"CASE WHEN s % 4 <> 0 THEN MS(CAST(1000 AS BIGINT) * ({NOW_SECONDS} - (s % 100) * 3600)) END"})
    captures = fleet.spark_columns(fleet.keys(spark, sf_dir).filter("s % 10 <> 0"), _BASE)
    return positions.retention_headroom(saved, captures, NOW)


# ---------------------------------------------------------------- table schemas (F8, F9)

# The four columns of every fleet table. The reader has the short code, an old capture lacks the note.
def _columns(kind: str) -> str:
    """Columns of one table as an array of structs, as the reader, the newest capture or the source has them."""
    size = "CASE WHEN h % 5 = 0 THEN 10 ELSE 20 END" if kind == "reader" else "20"
    note = {"reader": "h % 6 <> 0 AND h % 9 <> 0", "capture": "h % 9 <> 0", "source": "TRUE"}[kind]
    note_name = "'note'" if kind == "reader" else "'Note'"
    old = {"reader": "TRUE", "capture": "TRUE", "source": "h % 7 <> 3"}[kind]
    identity = "4" if kind != "reader" else "10"

    def column(name: str, data_type: str, length: str, precision: str = "0", scale: str = "0") -> str:
        return f"named_struct('name', {name}, 'type', {data_type}, 'length', {length}, 'precision', {precision}, 'scale', {scale}, 'nullable', true)"

    return f"""array_compact(array({column("'ID'", "'int'", identity, "10")}, {column("'Code'", "'varchar'", size)},
      CASE WHEN {note} THEN {column(note_name, "'nvarchar'", "CASE WHEN h % 2 = 0 THEN -1 ELSE 2147483647 END" if kind == 'source' else '-1')} END,
      CASE WHEN {old} THEN {column("'Amount'", "'decimal'", "9", "CASE WHEN h % 10 = 4 THEN 12 ELSE 19 END" if kind == "reader" else "19", "4")} END))"""


def _column_lists(spark, sf_dir, kind: str) -> DataFrame:
    return fleet.keys(spark, sf_dir).selectExpr(
        *[f"{t} AS {n}" for n, t in _TABLE.items()], f"{_columns(kind)} AS columns")


# Differences from the reader to the capture and from the capture to the source, in their order.
_READER_DIFF = [
    ("h % 5 = 0", "Code", "CHANGED", "varchar(10)", "varchar(20)"),
    ("h % 6 = 0 AND h % 9 <> 0", "Note", "ADDED", None, "nvarchar(max)"),
    ("h % 10 = 4", "Amount", "CHANGED", "decimal(12,4)", "decimal(19,4)"),
]
_SOURCE_DIFF = [
    ("h % 9 = 0", "Note", "ADDED", None, "nvarchar(max)"),
    ("h % 7 = 3", "Amount", "REMOVED", "decimal(19,4)", None),
]


def _literal(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _diff_rows(diff) -> str:
    union = " UNION ALL ".join(
        f"SELECT h, s, name, {i} AS o, '{c}' AS column_name, '{k}' AS kind, {_literal(b)} AS before_type, {_literal(a)} AS after_type FROM keys WHERE {w}"
        for i, (w, c, k, b, a) in enumerate(diff))
    return f"SELECT *, row_number() OVER (PARTITION BY h ORDER BY o) AS position FROM ({union})"


@query("column_diff", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'dbo' AS schema_name, name AS table_name, column_name, kind, before_type, after_type, position
  FROM ({_diff_rows(_SOURCE_DIFF)})""", "keys"))
def _(spark, sf_dir):
    before, after = (schema.explode_columns(_column_lists(spark, sf_dir, k), "columns") for k in ("capture", "source"))
    return schema.column_diff(before, after)


@query("column_diff_reader", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'dbo' AS schema_name, name AS table_name, column_name, kind, before_type, after_type, position
  FROM ({_diff_rows(_READER_DIFF)})""", "keys"))
def _(spark, sf_dir):
    before, after = (schema.explode_columns(_column_lists(spark, sf_dir, k), "columns") for k in ("reader", "capture"))
    return schema.column_diff(before, after)


def _assessable(spark, sf_dir) -> DataFrame:
    """Observations with nested captures: none for every 23rd table, two for every eighth."""
    capture = _columns("capture")
    one = f"named_struct('created_at', timestamp_seconds({BASE_SECONDS} + h), 'name', 'dbo_' || name, 'start_lsn', unhex(replace(LSN(39, h % 32, 1), ':', '')), 'ready', h % 21 <> 0, 'columns', {capture})"
    two = f"named_struct('created_at', timestamp_seconds({BASE_SECONDS} + h + 60), 'name', 'dbo_' || name || '_2', 'start_lsn', unhex(replace(LSN(39, h % 32 + 8, 1), ':', '')), 'ready', true, 'columns', {capture})"
    captures = fleet.spark_text(f"CASE WHEN h % 23 = 0 THEN slice(array({one}), 1, 0) WHEN h % 8 = 0 THEN array({one}, {two}) ELSE array({one}) END")
    return fleet.keys(spark, sf_dir).selectExpr(*[f"{t} AS {n}" for n, t in _TABLE.items()], f"{captures} AS captures", f"{_columns('source')} AS source_columns")


def _reader(spark, sf_dir) -> DataFrame:
    """The reader has recorded nine in ten tables."""
    return fleet.keys(spark, sf_dir).filter("h % 10 <> 9").selectExpr(*[f"{t} AS {n}" for n, t in _TABLE.items()], f"{_columns('reader')} AS reader_columns")


def _json_list(diff, condition: str) -> str:
    entries = ", ".join(
        f"CASE WHEN {w} THEN '{{\"column\":\"{c}\",\"kind\":\"{k}\",\"before\":{'null' if b is None else chr(34) + b + chr(34)},\"after\":{'null' if a is None else chr(34) + a + chr(34)}}}' END"
        for w, c, k, b, a in diff)
    return f"CASE WHEN {condition} THEN array_to_string(list_filter([{entries}], lambda x: x IS NOT NULL), ',') ELSE '' END"


_SINGLE = "h % 23 <> 0 AND h % 8 <> 0"
_ASSESSED = f"""
  SELECT *, CASE WHEN h % 23 = 0 THEN 'CURRENT' WHEN h % 8 = 0 THEN 'REFRESHING' WHEN rd <> '' THEN 'READER_STALE' WHEN sd <> '' THEN 'SOURCE_CHANGED' ELSE 'CURRENT' END AS assessed,
    CASE WHEN rd <> '' OR sd <> '' THEN '{{"source":[' || sd || '],"reader":[' || rd || ']}}' END AS detail
  FROM (SELECT r.*, {_json_list(_READER_DIFF, f"{_SINGLE} AND h % 10 <> 9")} AS rd, {_json_list(_SOURCE_DIFF, _SINGLE)} AS sd FROM reg r)"""


@query("schema_assess", sql(f"SELECT tenant_id, source_id, table_name, assessed AS assessed_state FROM ({_ASSESSED})", "reg"))
def _(spark, sf_dir):
    return schema.schema_assess(_assessable(spark, sf_dir), _reader(spark, sf_dir)).select("tenant_id", "source_id", "table_name", "assessed_state")


@query("schema_detail", sql(f"SELECT tenant_id, source_id, table_name, detail FROM ({_ASSESSED})", "reg"))
def _(spark, sf_dir):
    return schema.schema_assess(_assessable(spark, sf_dir), _reader(spark, sf_dir)).select(
        "tenant_id", "source_id", "table_name", schema.schema_detail(F.col("source_changes"), F.col("reader_changes")).alias("detail"))


def _planned(spark, sf_dir) -> DataFrame:
    assessed = schema.schema_assess(_assessable(spark, sf_dir), _reader(spark, sf_dir))
    return schema.schema_plan(assessed, fleet.registry(spark, sf_dir), fleet.positions(spark, sf_dir), True, NOW)


_PLANNED = f"""
  SELECT *, CASE WHEN NOT capturing THEN NULL
      WHEN h % 23 <> 0 AND h % 8 = 0 THEN CASE WHEN s % 9 <> 0 AND {_SAVED} > printf('%08x:%08x:%04x', 39, h % 32 + 8, 1) AND (refresh_started_at IS NULL OR date_diff('second', refresh_started_at, {NOW_SQL}) >= 120) THEN 'RETIRE' END
      WHEN h % 23 <> 0 AND h % 32 >= 0 AND h % 21 <> 0 AND (refresh_requested_at IS NOT NULL OR (assessed IN ('SOURCE_CHANGED', 'READER_STALE') AND detail IS DISTINCT FROM refresh_detail)) THEN 'CREATE' END AS action
  FROM (SELECT *, active AND state IN ('ACTIVE', 'ONBOARDING') AS capturing FROM ({_ASSESSED}))"""


@query("schema_plan", sql(f"""
  SELECT tenant_id, source_id, schema_name, table_name, assessed AS assessed_state, detail, capturing, action,
    CASE action WHEN 'RETIRE' THEN 'dbo_' || table_name WHEN 'CREATE' THEN 'dbo_' || table_name || '_20240601000000' END AS action_instance FROM ({_PLANNED})""", "reg"))
def _(spark, sf_dir):
    return _planned(spark, sf_dir)


@query("schema_registry_update", sql(replaced(
    {"schema_detail": "detail",
     "schema_state": "CASE WHEN NOT capturing THEN assessed WHEN creates THEN 'REFRESHING' WHEN refresh_error IS NOT NULL AND assessed <> 'CURRENT' THEN 'REFRESH_FAILED' ELSE assessed END",
     "refresh_requested_at": "CASE WHEN capturing AND NOT creates AND assessed <> 'REFRESHING' THEN refresh_requested_at END",
     "refresh_started_at": f"CASE WHEN capturing AND creates THEN {NOW_SQL} ELSE refresh_started_at END", "refresh_detail": "CASE WHEN capturing AND creates THEN detail ELSE refresh_detail END",
     "refresh_error": "CASE WHEN capturing AND creates THEN NULL ELSE refresh_error END"}, "TRUE",
    f"""(SELECT p.* REPLACE (CASE WHEN ack THEN 'DISABLED_BY_ADMIN' ELSE suspension_reason END AS suspension_reason, CASE WHEN ack THEN version + 1 ELSE version END AS version) FROM (
      SELECT *, coalesce(action = 'CREATE', false) AS creates,
        coalesce(requested_at > suspended_at AND NOT active AND NOT desired_enabled AND suspension_reason IS DISTINCT FROM 'DISABLED_BY_ADMIN', false) AS ack FROM ({_PLANNED})) p)"""), "reg"))
def _(spark, sf_dir):
    return schema.schema_registry_update(fleet.registry(spark, sf_dir), _planned(spark, sf_dir), NOW)


@query("schema_action_result", sql(replaced(
    {"refreshed_at": f"CASE WHEN h % 4 >= 2 AND h % 2 = 0 THEN {NOW_SQL} ELSE refreshed_at END",
     "refresh_error": "CASE h % 4 WHEN 0 THEN 'CDC_MANAGEMENT_PERMISSION_REQUIRED' WHEN 1 THEN 'CAPTURE_REFRESH_SQLCODE_1205' END",
     "schema_state": "CASE WHEN h % 4 < 2 THEN 'REFRESH_FAILED' ELSE schema_state END"}, "h % 3 <> 0"), "reg"))
def _(spark, sf_dir):
    results = fleet.spark_columns(fleet.keys(spark, sf_dir).filter("h % 3 <> 0"), {
        **_TABLE, "action": "CASE WHEN h % 2 = 0 THEN 'RETIRE' ELSE 'CREATE' END", "sql_code": "CASE h % 4 WHEN 0 THEN 22902 WHEN 1 THEN 1205 END"})
    return schema.schema_action_result(fleet.registry(spark, sf_dir), results, NOW)


@query("capture_instance_name", sql("""
  SELECT h, CASE WHEN length(n) > 84 THEN substring(n, 1, 71) || '_' || substring(sha256(n), 1, 12) ELSE n END || '_20240601000000' || CASE WHEN h % 4 = 0 THEN 'b' ELSE '' END AS instance_name
  FROM (SELECT h, 'dbo_' || repeat(table_name || '_', CASE WHEN h % 3 = 0 THEN 20 ELSE 1 END) AS n FROM reg)""", "reg"))
def _(spark, sf_dir):
    named = fleet.spark_columns(fleet.keys(spark, sf_dir), {"h": "h", "t": "repeat(name || '_', CASE WHEN h % 3 = 0 THEN 20 ELSE 1 END)"})
    taken = schema.capture_instance_name(F.lit("dbo"), F.col("t"), F.lit("other"), NOW)
    current = F.when(F.col("h") % 4 == 0, F.upper(taken)).otherwise("other")
    return named.select("h", schema.capture_instance_name(F.lit("dbo"), F.col("t"), current, NOW).alias("instance_name"))


def _record_text() -> str:
    """Schema-history record of one table as JSON text (both dialects)."""
    return ("'{\"tableChanges\":[{\"type\":\"' || CASE WHEN h % 13 = 0 THEN 'DROP' WHEN n = 1 THEN 'CREATE' ELSE 'ALTER' END || '\",\"id\":\"\\\"' || CASE WHEN h % 29 = 0 THEN 'other' ELSE 'DB' || s END || "
            "'\\\".\\\"dbo\\\".\\\"' || name || '\\\"\",\"table\":{\"columns\":[{\"name\":\"ID\",\"typeName\":\"INT identity\",\"length\":10,\"optional\":false},{\"name\":\"Code\",\"typeName\":\"varchar\",\"length\":' || "
            "(CASE WHEN h % 5 = 0 THEN 10 ELSE 20 END + n) || '}]}}]}'")


def _spark_record() -> str:
    return _record_text().replace("\\\"", "\\\\\"")


def _chunks(spark, sf_dir) -> DataFrame:
    """Two records per table, each cut into parts of 40 characters; every 17th table's second record is not JSON."""
    records = fleet.keys(spark, sf_dir).selectExpr("*", "explode(array(1, 2)) AS n").selectExpr(
        "s", "h", "n", f"CASE WHEN h % 17 = 0 AND n = 2 THEN 'not a record at all, only a text that is longer than forty characters' ELSE {_spark_record()} END AS record")
    parts = records.selectExpr("*", "explode(sequence(0, CAST(ceil(length(record) / 40.0) AS INT) - 1)) AS part")
    return parts.selectExpr(
        "'T' || s AS tenant_id", "'S' || s AS source_id", "(h * 2 + n) * 1000 + part AS storage_sequence", "'r' || h || '-' || n AS id", "part AS history_data_seq",
        "substring(record, part * 40 + 1, 40) AS history_data")


_RECORDS = f"SELECT s, h, n, name, CASE WHEN h % 17 = 0 AND n = 2 THEN 'not a record at all, only a text that is longer than forty characters' ELSE {_record_text()} END AS record FROM keys, (VALUES (1), (2)) v(n)"


@query("schema_history_records", sql(f"SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'r' || h || '-' || n AS record_id, (h * 2 + n) * 1000 AS first_sequence, record FROM ({_RECORDS})", "keys"))
def _(spark, sf_dir):
    return schema.schema_history_records(_chunks(spark, sf_dir))


@query("reader_schemas", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'dbo' AS schema_name, name AS table_name,
    '[{"name":"ID","type":"int","length":10,"precision":10,"scale":0,"nullable":false},{"name":"Code","type":"varchar","length":' || z || ',"precision":' || z || ',"scale":0,"nullable":true}]' AS reader_columns
  FROM (SELECT *, CASE WHEN h % 5 = 0 THEN 10 ELSE 20 END + CASE WHEN h % 17 = 0 THEN 1 ELSE 2 END AS z FROM keys WHERE h % 13 <> 0 AND h % 29 <> 0)""", "keys"))
def _(spark, sf_dir):
    return schema.reader_schemas(schema.schema_history_records(_chunks(spark, sf_dir)), fleet.sources(spark, sf_dir))


@query("state_counts", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, CAST({_COUNTED} AS BIGINT) AS offset_partitions, CAST(n AS BIGINT) AS schema_parts
  FROM (SELECT s, sum((length(record) + 39) // 40) AS n FROM ({_RECORDS}) GROUP BY s)""", "keys"))
def _(spark, sf_dir):
    return positions.state_counts(offsets(spark, sf_dir), _chunks(spark, sf_dir))


# Catalog rows: object h is a table, h + 1000000 and h + 2000000 its capture instances.
def _catalog(spark, sf_dir):
    ids = fleet.keys(spark, sf_dir)
    tables = fleet.spark_columns(ids, {
        **_BASE, "object_id": "h", "schema_name": "CASE WHEN h % 31 = 0 THEN 'CDC' ELSE 'dbo' END", "is_shipped": "h % 19 = 0",
        "table_name": "CASE WHEN h % 37 = 0 THEN 'Capture_Extra' WHEN h % 12 = 5 THEN replace(name, '_', ' ') ELSE name END"})
    instances = ids.selectExpr("*", "explode(CASE WHEN h % 8 = 0 THEN array(1, 2) ELSE array(1) END) AS n")
    captures = fleet.spark_columns(instances, {
        **_BASE, "source_object_id": "h", "capture_object_id": "n * 1000000 + h", "capture_name": "'dbo_' || name || CASE WHEN n = 2 THEN '_2' ELSE '' END",
        "created_at": f"MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h - n))", "start": "CASE WHEN h % 15 = 4 THEN '00000000:00000000:0000' ELSE LSN(39, h % 32 + n, 1) END"})
    captures = captures.withColumn("start_lsn", lsn.lsn_bytes(F.col("start")))
    objects = ids.selectExpr("s", "h", "h AS object_id", "false AS change_table").unionByName(instances.selectExpr("s", "h", "n * 1000000 + h AS object_id", "true AS change_table"))
    listed = objects.selectExpr("*", """inline(array_compact(array(
      CASE WHEN change_table THEN named_struct('column_id', 1, 'name', '__$start_lsn', 'type', 'binary', 'max_length', 10) END,
      named_struct('column_id', 2, 'name', 'ID', 'type', 'INT', 'max_length', 4), named_struct('column_id', 3, 'name', 'Note', 'type', 'nvarchar', 'max_length', 400),
      CASE WHEN NOT change_table THEN named_struct('column_id', 4, 'name', 'Total', 'type', 'int', 'max_length', 4) END)))""")
    columns = fleet.spark_columns(listed, {
        **_BASE, "object_id": "object_id", "column_id": "column_id", "name": "name", "type": "type", "system_type_id": "56", "user_type_id": "56", "max_length": "max_length",
        "precision": "10", "scale": "0", "is_nullable": "column_id > 2", "is_computed": "name = 'Total'"})
    keys = fleet.spark_columns(ids.filter("h % 14 <> 6"), {**_BASE, "object_id": "h", "key_ordinal": "1", "column_name": "'ID'"})
    captured = fleet.spark_columns(instances.filter("NOT (h % 16 = 8 AND n = 2)").filter("h % 18 <> 7"), {**_BASE, "capture_object_id": "n * 1000000 + h", "column_name": "'ID'"})
    return tables, captures, columns, keys, captured


_SHAPE_ID = "'2|ID|56|56|4|10|0|false|'"
_SHAPE_NOTE = "'3|Note|56|56|400|10|0|true|'"
_SOURCE_SHAPE = f"({_SHAPE_ID} || {_SHAPE_NOTE} || '4|Total|56|56|4|10|0|true|')"
_CAPTURE_SHAPE = f"('1|__$start_lsn|56|56|10|10|0|false|' || {_SHAPE_ID} || {_SHAPE_NOTE})"
_KEY_SHAPE = "CASE WHEN h % 14 <> 6 THEN '1:ID|' ELSE '' END"
_INSTANCES = f"""
  SELECT s, h, n, 'dbo_' || name || CASE WHEN n = 2 THEN '_2' ELSE '' END AS capture_name, h % 15 <> 4 AS ready,
    h % 14 <> 6 AND h % 18 <> 7 AND NOT (h % 16 = 8 AND n = 2) AS keyed, name
  FROM keys, (VALUES (1), (2)) v(n) WHERE n = 1 OR h % 8 = 0"""
_PRINTS = f"""
  SELECT s, h, sha256(string_agg(line, chr(10) ORDER BY line)) AS fingerprint FROM (
    SELECT *, h || '|' || (n * 1000000 + h) || '|' || capture_name || '|' || strftime(epoch_ms(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h - n)), '%Y-%m-%dT%H:%M:%S') || '|' ||
      {_SOURCE_SHAPE} || '|' || {_CAPTURE_SHAPE} || '|' || {_KEY_SHAPE} AS line FROM ({_INSTANCES})) GROUP BY s, h"""


@query("column_shape", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, h AS object_id, {_SOURCE_SHAPE} AS column_shape FROM keys
  UNION ALL SELECT 'T' || s, 'S' || s, n * 1000000 + h, {_CAPTURE_SHAPE} FROM ({_INSTANCES})""", "keys"))
def _(spark, sf_dir):
    return schema.column_shape(_catalog(spark, sf_dir)[2])


@query("key_shape", sql("SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, h AS object_id, '1:ID|' AS key_shape FROM keys WHERE h % 14 <> 6", "keys"))
def _(spark, sf_dir):
    return schema.key_shape(_catalog(spark, sf_dir)[3])


@query("capture_fingerprint", sql(f"SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, h AS source_object_id, fingerprint FROM ({_PRINTS})", "keys"))
def _(spark, sf_dir):
    _, captures, columns, keys, _ = _catalog(spark, sf_dir)
    return schema.capture_fingerprint(captures, schema.column_shape(columns), schema.key_shape(keys))


@query("captured_key_coverage", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, n * 1000000 + h AS capture_object_id, CAST(1 AS BIGINT) AS key_columns, CAST(CASE WHEN keyed THEN 0 ELSE 1 END AS BIGINT) AS uncaptured, keyed
  FROM ({_INSTANCES}) WHERE h % 14 <> 6""", "keys"))
def _(spark, sf_dir):
    _, captures, _, keys, captured = _catalog(spark, sf_dir)
    asked = captures.select("tenant_id", "source_id", "capture_object_id", "source_object_id").join(keys.withColumnRenamed("object_id", "source_object_id"), ["tenant_id", "source_id", "source_object_id"])
    return schema.captured_key_coverage(asked, captured)


_CAPTURABLE = "h % 19 <> 0 AND h % 37 <> 0 AND h % 31 <> 0"
_SUPPORTED = "NOT (h % 12 = 5 AND contains(name, '_'))"
_SHOWN = "CASE WHEN h % 12 = 5 THEN replace(name, '_', ' ') ELSE name END"


@query("capturable_tables", sql(f"SELECT 'S' || s AS source_id, h AS object_id, {_SHOWN} AS table_name, {_SUPPORTED} AS supported FROM keys WHERE {_CAPTURABLE}", "keys"))
def _(spark, sf_dir):
    return schema.capturable_tables(_catalog(spark, sf_dir)[0]).select("source_id", "object_id", "table_name", "supported")


@query("capture_inventory", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'dbo' AS schema_name, {_SHOWN} AS table_name, fingerprint, {_SUPPORTED} AND ready AND keyed AS eligible,
    CASE WHEN NOT {_SUPPORTED} THEN 'TABLE_IDENTIFIER_UNSUPPORTED' WHEN NOT keyed THEN 'CAPTURED_PRIMARY_KEY_REQUIRED' WHEN NOT ready THEN 'CDC_CAPTURE_INITIALIZING' END AS diagnostic,
    instances, CASE WHEN ready THEN minimums ELSE '' END AS minimums, 'ID:int:4,Note:nvarchar:200' AS source_columns
  FROM (SELECT s, h, any_value(name) AS name, any_value(ready) AS ready,
      CASE WHEN any_value(ready) THEN bool_and(keyed) ELSE bool_or(keyed) END AS keyed, string_agg(capture_name, ',' ORDER BY n DESC) AS instances,
      string_agg('00000027' || printf('%08x', h % 32 + n) || '0001', ',' ORDER BY n DESC) AS minimums FROM ({_INSTANCES}) GROUP BY s, h) JOIN ({_PRINTS}) USING (s, h) WHERE {_CAPTURABLE}""", "keys"))
def _(spark, sf_dir):
    seen = schema.capture_inventory(*_catalog(spark, sf_dir))
    return seen.select(
        "tenant_id", "source_id", "schema_name", "table_name", "fingerprint", "eligible", "diagnostic", "instances",
        F.array_join(F.transform("minimums", lambda m: F.lower(F.hex(m))), ",").alias("minimums"),
        F.array_join(F.transform("source_columns", lambda c: F.concat_ws(":", c["name"], c["type"], c["length"].cast("string"))), ",").alias("source_columns"))


@query("storage_contract", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'history' AS table_name, c AS column_name, t AS expected_type, CASE WHEN s % 5 = 1 AND i % 7 = 2 THEN NULL WHEN s % 3 = 1 AND i % 5 = 1 THEN 'binary' ELSE t END AS actual_type,
    CASE WHEN s % 5 = 1 AND i % 7 = 2 THEN 'COLUMN_MISSING' WHEN s % 3 = 1 AND i % 5 = 1 THEN 'TYPE_DIFFERS' ELSE 'NULLABILITY_DIFFERS' END AS violation
  FROM src, (VALUES {", ".join(f"({i}, '{part.strip().split(' ')[0]}', '{part.strip().split(' ')[1]}')" for i, part in enumerate(storage.HISTORY_SCHEMA.split(",")))}) v(i, c, t)
  WHERE (s % 5 = 1 AND i % 7 = 2) OR (s % 3 = 1 AND i % 5 = 1) OR (s % 4 = 1 AND i = 3)""", "src"))
def _(spark, sf_dir):
    """Every source's stored history columns, some of them missing or of another shape."""
    empty = spark.createDataFrame([], storage.HISTORY_SCHEMA)
    expected = spark.createDataFrame([("history", c, t, True) for c, t in empty.dtypes], "table_name string, column_name string, type_name string, is_nullable boolean")
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("c"), F.lit(t).alias("t")) for i, (c, t) in enumerate(empty.dtypes)])
    stored = fleet.source_keys(spark, sf_dir).select("s", F.inline(listed)).filter("NOT (s % 5 = 1 AND i % 7 = 2)").selectExpr(
        "'T' || s AS tenant_id", "'S' || s AS source_id", "'history' AS table_name", "c AS column_name", "CASE WHEN s % 3 = 1 AND i % 5 = 1 THEN 'binary' ELSE t END AS type_name", "NOT (s % 4 = 1 AND i = 3) AS is_nullable")
    return schema.storage_contract(stored, expected)


# ---------------------------------------------------------------- source health (F11)

_METRICS = {
    **_BASE, "retention_minutes": "CASE WHEN s % 29 = 1 THEN 60 ELSE 20160 END", "minimum_minutes": "20160", "capture_running": "s % 7 <> 2", "job_state_unavailable": "s % 5 = 3",
    "recent_errors": "s % 11 = 4", "scan_age_s": "CASE WHEN s % 13 = 5 THEN 301 ELSE 300 END", "free_bytes": "CASE WHEN s % 17 = 6 THEN CAST(1000 AS BIGINT) ELSE CAST(9000000000 AS BIGINT) END",
    "capped_free_pages": "CASE WHEN s % 19 = 7 THEN 131071 WHEN s % 19 = 8 THEN NULL ELSE 131072 END", "headroom_s": "CASE WHEN s % 3 = 1 THEN 604799 ELSE 604800 END", "volume_unavailable": "s % 2 = 1",
}


@query("source_warning", sql("""
  SELECT 'S' || s AS source_id, CASE WHEN s % 29 = 1 THEN 'CDC_RETENTION_BELOW_14_DAYS' WHEN s % 7 = 2 AND s % 5 <> 3 THEN 'CDC_CAPTURE_JOB_STOPPED' WHEN s % 11 = 4 THEN 'CDC_CAPTURE_ERRORS'
    WHEN s % 13 = 5 THEN 'CDC_SCAN_STALE' WHEN s % 17 = 6 OR s % 19 = 7 THEN 'SOURCE_STORAGE_LOW' WHEN s % 3 = 1 THEN 'CDC_RETENTION_HEADROOM_LOW' WHEN s % 5 = 3 THEN 'CDC_JOB_STATE_METRICS_UNAVAILABLE'
    WHEN s % 2 = 1 THEN 'PHYSICAL_DISK_METRICS_UNAVAILABLE' END AS warning FROM src""", "src"))
def _(spark, sf_dir):
    return monitor.source_warning(fleet.spark_columns(fleet.source_keys(spark, sf_dir), _METRICS)).select("source_id", "warning")


@query("pipeline_status", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, CASE WHEN f IS NOT NULL THEN 'ERROR' WHEN w IS NOT NULL THEN 'DEGRADED' ELSE 'RUNNING' END AS state,
    coalesce('CONSUMER_' || f, w, 'CAPTURE_AND_CONSUMER_RUNNING') AS message, CASE WHEN w IS NULL THEN 'RUNNING' ELSE 'DEGRADED' END AS capture_state, CASE WHEN f IS NULL THEN 'RUNNING' ELSE 'ERROR' END AS consumer_state
  FROM (SELECT s, CASE WHEN s % 7 = 1 THEN 'SOURCE_FENCED' END AS f, CASE WHEN s % 11 = 2 THEN 'BROKER_BACKLOG_HIGH' WHEN s % 5 = 3 THEN 'CAPTURE_PROGRESS_STALE' WHEN s % 3 = 1 THEN 'CDC_SCAN_STALE'
    WHEN s % 4 = 2 THEN 'TABLE_CAPTURE_SUSPENDED' WHEN s % 6 = 3 THEN 'CAPTURE_SCHEMA_REFRESH_FAILED' END AS w FROM src)""", "src"))
def _(spark, sf_dir):
    runtime = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        **_BASE, "warning": "CASE WHEN s % 3 = 1 THEN 'CDC_SCAN_STALE' END", "unacknowledged_suspension": "s % 4 = 2", "failed_refresh": "s % 6 = 3",
        "progress_age_s": "CASE WHEN s % 5 = 3 THEN 121 ELSE 120 END", "backlog": "CASE WHEN s % 11 = 2 THEN 100001 ELSE 100000 END", "consumer_failure": "CASE WHEN s % 7 = 1 THEN 'SOURCE_FENCED' END"})
    return monitor.pipeline_status(runtime)


def _status(age: str, event: str, position: str) -> dict[str, str]:
    return {
        "source_id": fleet.SOURCE, "tenant_id": fleet.TENANT, "state": "CASE WHEN s % 5 = 0 THEN 'DEGRADED' ELSE 'RUNNING' END", "message": f"'{age}'",
        "updated_at": f"MS(CAST(1000 AS BIGINT) * ({NOW_SECONDS} - {age}))", "last_event_at": event, "last_commit_lsn": position,
        "retention_minutes": f"CASE WHEN s % 3 = 0 AND {age} < 100 THEN NULL ELSE 20160 END", "retention_headroom_seconds": f"CASE WHEN s % 4 = 0 THEN NULL ELSE CAST({age} AS BIGINT) END"}


_OLD = _status("600", f"MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + s % 10))", "LSN(39, s % 50, 1)")
_NEW = _status("30", f"CASE WHEN s % 6 <> 0 THEN MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + 5)) END", "CASE WHEN s % 2 = 0 THEN LSN(40, s % 50, 1) END")
_MERGED = f"""
  SELECT s, coalesce(n.source_id, o.source_id) AS source_id, CASE WHEN n.s IS NOT NULL THEN n.tenant_id ELSE o.tenant_id END AS tenant_id, CASE WHEN n.s IS NOT NULL THEN n.state ELSE o.state END AS state,
    CASE WHEN n.s IS NOT NULL THEN n.message ELSE o.message END AS message, CASE WHEN n.s IS NOT NULL THEN n.updated_at ELSE o.updated_at END AS updated_at,
    greatest(n.last_event_at, o.last_event_at) AS last_event_at, coalesce(n.last_commit_lsn, o.last_commit_lsn) AS last_commit_lsn, coalesce(n.retention_minutes, o.retention_minutes) AS retention_minutes,
    coalesce(n.retention_headroom_seconds, o.retention_headroom_seconds) AS retention_headroom_seconds
  FROM (SELECT s, {fleet.duck_columns(_NEW)} FROM src WHERE s % 7 <> 0) n FULL JOIN (SELECT s, {fleet.duck_columns(_OLD)} FROM src WHERE s % 9 <> 0) o USING (s)"""
_MERGED_SQL = sql(f"SELECT * EXCLUDE (s) FROM ({_MERGED})", "src")


def _statuses(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """New and previous status rows; some sources report only once."""
    ids = fleet.source_keys(spark, sf_dir)
    return fleet.spark_columns(ids.filter("s % 7 <> 0"), _NEW), fleet.spark_columns(ids.filter("s % 9 <> 0"), _OLD)


@query("status_merge", _MERGED_SQL)
def _(spark, sf_dir):
    return monitor.status_merge(*_statuses(spark, sf_dir))


@query("write_status", _MERGED_SQL)
def _(spark, sf_dir):
    path = run_folder(spark, "status")
    new, old = _statuses(spark, sf_dir)
    storage.write_status(old, path, 0)
    storage.write_status(new, path, 1)
    storage.write_status(new, path, 1)
    return storage.read_snapshot(spark, path)


@query("write_status_fenced", _MERGED_SQL)
def _(spark, sf_dir):
    """The new rows come from a reader with a greater fence, whose versions begin anew; the replaced one can no longer write."""
    path = run_folder(spark, "status")
    new, old = _statuses(spark, sf_dir)
    storage.write_status(old, path, 5, fence=7, writer="old")
    for _ in range(2):  # once more after a crash
        storage.write_status(new, path, 0, fence=8, writer="new")
    try:
        storage.write_status(old, path, 6, fence=7, writer="old")
    except storage.SourceFenced:
        return storage.read_snapshot(spark, path)
    raise AssertionError("a fenced write went through")


@query("stream_status", _MERGED_SQL)
def _(spark, sf_dir):
    """The previous rows arrive in one run of the stream, the new ones in the next."""
    feed, path, checkpoint = run_folder(spark, "metrics"), run_folder(spark, "status"), run_folder(spark, "checkpoint")
    new, old = _statuses(spark, sf_dir)
    for rows in (old, new):
        rows.write.mode("append").parquet(feed)
        streams.stream_status(spark.readStream.schema(rows.schema).parquet(feed), path, checkpoint, available_now=True).awaitTermination()
    return storage.read_snapshot(spark, path)


@query("stale_status", sql(f"SELECT source_id, date_diff('second', updated_at, {NOW_SQL}) > 120 AS stale FROM ({_MERGED})", "src"))
def _(spark, sf_dir):
    return monitor.stale_status(monitor.status_merge(*_statuses(spark, sf_dir)), NOW, 120).select("source_id", "stale")


@query("fleet_health", sql(f"""
  SELECT count(*) AS source_count, count(*) FILTER (state = 'RUNNING' AND updated_at > {NOW_SQL} - INTERVAL 90 SECOND) AS healthy_count,
    CASE WHEN count(*) > 0 AND bool_and(state = 'RUNNING' AND updated_at > {NOW_SQL} - INTERVAL 90 SECOND) THEN 'UP' ELSE 'DOWN' END AS health FROM ({_MERGED})""", "src"))
def _(spark, sf_dir):
    return monitor.fleet_health(monitor.status_merge(*_statuses(spark, sf_dir)), NOW, 30)


@query("safe_diagnostic", sql("""
  SELECT h, CASE WHEN h % 5 = 0 THEN 'SOURCE_FENCED' ELSE 'DEPENDENCY_FAILURE_IllegalStateException' || repeat('_RuntimeException', CAST(least(h % 8, 5) AS INT)) ||
    CASE WHEN h % 8 < 5 THEN '_SQLException' || CASE WHEN h % 3 = 0 THEN '' ELSE '_SQLSTATE_28000' END || '_SQLCODE_' || h ELSE '' END END AS diagnostic FROM keys""", "keys"))
def _(spark, sf_dir):
    """A service failure for every fifth row, else a chain that ends in a database error, sometimes deeper than is read."""
    def cause(name: str, known: str = "CAST(NULL AS STRING)", state: str = "CAST(NULL AS STRING)", code: str = "CAST(NULL AS BIGINT)") -> str:
        return f"named_struct('class_name', '{name}', 'known_code', {known}, 'sql_state', {state}, 'sql_code', {code})"

    chain = (f"concat(array({cause('IllegalStateException', chr(67) + 'ASE WHEN h % 5 = 0 THEN ' + repr('SOURCE_FENCED') + ' END')}), "
             f"array_repeat({cause('RuntimeException')}, CAST(h % 8 AS INT)), array({cause('SQLException', state=chr(67) + 'ASE WHEN h % 3 = 0 THEN ' + repr('password=x') + ' ELSE ' + repr('28000') + ' END', code='h')}))")
    return fleet.keys(spark, sf_dir).selectExpr("h", f"{chain} AS causes").select("h", monitor.safe_diagnostic(F.col("causes"), shown=6).alias("diagnostic"))


@query("initialization_window", sql(f"""
  SELECT 'S' || s AS source_id, CASE WHEN code IS NULL THEN 'RUNNING' WHEN ok THEN 'STARTING' ELSE 'ERROR' END AS state, CASE WHEN code IS NULL THEN NULL WHEN ok THEN 'SOURCE_INITIALIZING' ELSE code END AS message
  FROM (SELECT s, code, s % 2 = 0 AND s % 240 < 120 AND code IN ('SOURCE_OFFSETS_MISSING_OR_AMBIGUOUS', 'SOURCE_INITIALIZATION_INCOMPLETE') AS ok
        FROM (SELECT s, {_POSITION_CODE} AS code FROM src WHERE s % 8 <> 0))""", "src"))
def _(spark, sf_dir):
    claimed = fleet.activation(spark, sf_dir)
    codes = positions.saved_position(claimed, offsets(spark, sf_dir), fleet.sources(spark, sf_dir))
    first = claimed.withColumn("first_activation", F.substring("source_id", 2, 20).cast("bigint") % 2 == 0)
    return monitor.initialization_window(first, codes, NOW)


@query("storage_minimum", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, min(h * 1000 % 7777) AS free_bytes, min(CASE WHEN h % 4 <> 0 AND h % 3 <> 0 THEN h % 900 + 200 - h % 150 END) AS capped_free_pages FROM keys GROUP BY s""", "keys"))
def _(spark, sf_dir):
    files = fleet.spark_columns(fleet.keys(spark, sf_dir), {
        **_BASE, "file_type": "CASE WHEN h % 4 = 0 THEN 1 ELSE 0 END", "free_bytes": "h * 1000 % 7777", "max_pages": "CASE WHEN h % 3 = 0 THEN -1 ELSE h % 900 + 200 END", "used_pages": "h % 150"})
    return monitor.storage_minimum(files)


_SESSIONS = {**_BASE, "session_id": "h % 5 + CASE WHEN h % 5 = 0 THEN 0 ELSE s END", "start_time": f"MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h))", "end_time": f"MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h + 9))", "error_count": "h % 3"}


@query("latest_scan", sql(f"""
  SELECT tenant_id, source_id, session_id, start_time, end_time, error_count FROM (SELECT {fleet.duck_columns(_SESSIONS)} FROM keys) WHERE session_id <> 0
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY session_id DESC) = 1""", "keys"))
def _(spark, sf_dir):
    return monitor.latest_scan(fleet.spark_columns(fleet.keys(spark, sf_dir), _SESSIONS))


@query("recent_scans", sql(f"SELECT source_id, session_id, error_count FROM (SELECT {fleet.duck_columns(_SESSIONS)} FROM keys) ORDER BY session_id DESC, source_id LIMIT 10", "keys"))
def _(spark, sf_dir):
    return monitor.recent_scans(fleet.spark_columns(fleet.keys(spark, sf_dir), _SESSIONS)).select("source_id", "session_id", "error_count")
