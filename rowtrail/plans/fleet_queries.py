"""Queries over the fleet (F7): settings, coverage, registry transitions, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtrail.functions import lsn, names
from rowtrail.operators import history, positions, registry, settings
from rowtrail.plans import fleet
from rowtrail.plans.catalog import ORACLES, query
from rowtrail.plans.fleet import NOW, NOW_SQL, REG_LIST, replaced, sql
from rowtrail.session import run_folder
from rowtrail.sources import storage

_UNAVAILABLE = "(NOT sql_cdc_enabled OR state IN ('BLOCKED', 'MISSING', 'STOPPING'))"
_SAVED = fleet.duck_text(fleet.SAVED)
_COVERED = f"(o.eligible AND (o.first_minimum <= p.saved_commit OR coalesce(o.second_minimum <= p.saved_commit, false)))"
_UNACKNOWLEDGED = ("(NOT active AND suspended_at IS NOT NULL AND suspension_reason IS DISTINCT FROM 'DISABLED_BY_ADMIN' "
                   "AND (requested_at IS NULL OR requested_at < suspended_at))")


@query("captured_tables", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, 'dbo.' || name AS table_name FROM keys
  UNION ALL SELECT 'T' || s, 'S' || s, 'dbo.Capture_Heartbeat' FROM src""", "keys", "src"))
def _(spark, sf_dir):
    return settings.captured_tables(fleet.sources(spark, sf_dir))


@query("configuration_hash", sql("SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, h256 AS configuration_hash FROM hashes", "hashes"))
def _(spark, sf_dir):
    return settings.configuration_hash(fleet.sources(spark, sf_dir)).select("tenant_id", "source_id", "configuration_hash")


@query("validate_sources", sql("""
  SELECT tenant_id, 'S' || s AS source_id, violation FROM (
    SELECT s, CASE WHEN s % 10 = 3 THEN 'T_shared' WHEN s % 17 = 5 THEN 'bad id' ELSE 'T' || s END AS tenant_id, unnest(list_filter([
      CASE WHEN s % 10 <> 3 AND s % 17 = 5 THEN 'INVALID_IDENTIFIER' END, CASE WHEN s % 13 = 2 THEN 'INVALID_ADDRESS' END,
      CASE WHEN s % 19 = 4 THEN 'INVALID_PORT' END, CASE WHEN s % 23 = 6 THEN 'ALLOWLIST_REQUIRED' END, CASE WHEN s % 29 = 7 AND s % 23 <> 6 THEN 'INVALID_TABLE' END,
      CASE WHEN s % 7 = 1 THEN 'RETENTION_TOO_SHORT' END, CASE WHEN s % 11 IN (1, 2) THEN 'INVALID_BATCH_BOUNDS' END,
      CASE WHEN s % 10 = 3 AND (SELECT count(*) FROM src WHERE s % 10 = 3) > 1 OR s % 10 <> 3 AND s % 17 = 5 AND (SELECT count(*) FROM src WHERE s % 10 <> 3 AND s % 17 = 5) > 1 THEN 'DUPLICATE_TENANT' END,
      CASE WHEN s % 31 = 8 AND (SELECT count(*) FROM src WHERE s % 31 = 8 AND s % 13 <> 2 AND s % 19 <> 4) > 1 AND s % 13 <> 2 AND s % 19 <> 4
        OR s % 31 = 8 AND s % 13 = 2 AND s % 19 <> 4 AND (SELECT count(*) FROM src WHERE s % 31 = 8 AND s % 13 = 2 AND s % 19 <> 4) > 1
        OR s % 31 = 8 AND s % 13 <> 2 AND s % 19 = 4 AND (SELECT count(*) FROM src WHERE s % 31 = 8 AND s % 13 <> 2 AND s % 19 = 4) > 1
        OR s % 31 = 8 AND s % 13 = 2 AND s % 19 = 4 AND (SELECT count(*) FROM src WHERE s % 31 = 8 AND s % 13 = 2 AND s % 19 = 4) > 1 THEN 'DUPLICATE_DATABASE' END
    ], lambda x: x IS NOT NULL)) AS violation FROM src)""", "src"))
def _(spark, sf_dir):
    configured = fleet.sources(spark, sf_dir).withColumn("s", F.substring("source_id", 2, 20).cast("bigint")).selectExpr(
        "CASE WHEN s % 10 = 3 THEN 'T_shared' WHEN s % 17 = 5 THEN 'bad id' ELSE tenant_id END AS tenant_id", "source_id",
        "CASE WHEN s % 31 = 8 THEN CASE WHEN s % 2 = 0 THEN 'one.example' ELSE 'ONE.example' END ELSE host END AS host",
        "CASE WHEN s % 19 = 4 THEN 70000 ELSE 0 END AS port",
        "CASE WHEN s % 13 = 2 THEN '9bad' WHEN s % 31 = 8 THEN 'shared' ELSE database END AS database",
        "CASE WHEN s % 23 = 6 THEN CAST(array() AS array<string>) WHEN s % 29 = 7 THEN array('dbo.Capture_Heartbeat') ELSE tables END AS tables",
        "CASE WHEN s % 7 = 1 THEN 60 ELSE 0 END AS retention_minutes", "CASE WHEN s % 11 = 1 THEN 10000 ELSE 0 END AS max_queue",
        "CASE WHEN s % 11 = 2 THEN 2000 ELSE 0 END AS max_batch")
    return settings.validate_sources(configured)


def _requested(spark, sf_dir):
    """Tables somebody wants: inactive and desired."""
    return fleet.registry(spark, sf_dir).filter("NOT active AND desired_enabled").select("tenant_id", "source_id", F.concat(F.lit("dbo."), "table_name").alias("table_name"))


@query("expanded_tables", sql("SELECT tenant_id, source_id, 'dbo.' || table_name AS table_name FROM reg WHERE active OR desired_enabled", "reg"))
def _(spark, sf_dir):
    current = fleet.registry(spark, sf_dir).filter("active").select("tenant_id", "source_id", F.concat(F.lit("dbo."), "table_name").alias("table_name"))
    return settings.expanded_tables(current, _requested(spark, sf_dir))


_READY = f"""
  SELECT r.s, r.tenant_id, r.source_id, 'dbo.' || r.table_name AS table_name FROM reg r JOIN obs o USING (table_id) JOIN pos p ON p.s = r.s
  WHERE r.desired_enabled AND NOT r.active AND r.state = 'PENDING' AND p.saved_commit IS NOT NULL AND {_COVERED}"""


@query("ready_requests", sql(f"SELECT tenant_id, source_id, table_name FROM ({_READY})", "reg", "obs", "pos"))
def _(spark, sf_dir):
    return registry.ready_requests(fleet.registry(spark, sf_dir), fleet.observations(spark, sf_dir), fleet.positions(spark, sf_dir))


@query("request_set_match", sql(f"""
  SELECT tenant_id, source_id, count(*) AS requested_tables, count(*) FILTER (NOT ready) AS lost_tables,
    CASE WHEN count(*) FILTER (NOT ready) > 0 THEN 'ONBOARDING_REQUEST_CHANGED' END AS error_code
  FROM (SELECT r.tenant_id, r.source_id, EXISTS (SELECT 1 FROM ({_READY}) y WHERE y.s = r.s AND y.table_name = 'dbo.' || r.table_name) AS ready
        FROM reg r WHERE NOT active AND desired_enabled) GROUP BY ALL""", "reg", "obs", "pos"))
def _(spark, sf_dir):
    ready = registry.ready_requests(fleet.registry(spark, sf_dir), fleet.observations(spark, sf_dir), fleet.positions(spark, sf_dir))
    return settings.request_set_match(_requested(spark, sf_dir), ready)


@query("missing_tables", sql("SELECT tenant_id, source_id, schema_name, table_name FROM reg WHERE h % 7 = 0", "reg"))
def _(spark, sf_dir):
    return registry.missing_tables(fleet.registry(spark, sf_dir), fleet.observations(spark, sf_dir), fleet.positions(spark, sf_dir))


@query("table_id", sql("SELECT table_id, tenant_id, source_id, schema_name, table_name FROM reg", "reg"))
def _(spark, sf_dir):
    return fleet.registry(spark, sf_dir).select("table_id", "tenant_id", "source_id", "schema_name", "table_name")


@query("registry_flags", sql(f"""
  SELECT tenant_id, source_id, bool_or(active AND {_UNAVAILABLE}) AS unavailable_active, bool_or({_UNACKNOWLEDGED}) AS unacknowledged_suspension,
    bool_or(active AND schema_state IS NOT DISTINCT FROM 'REFRESH_FAILED') AS failed_refresh, bool_or(sql_cdc_enabled AND NOT desired_enabled) AS unconfigured
  FROM reg GROUP BY ALL""", "reg"))
def _(spark, sf_dir):
    return registry.registry_flags(fleet.registry(spark, sf_dir))


@query("effective_tables", sql("""
  SELECT tenant_id, source_id, string_agg('dbo.' || table_name, ',' ORDER BY table_name) AS tables,
    coalesce(string_agg('dbo.' || table_name || '=' || activation_lsn, ',' ORDER BY table_name) FILTER (activation_lsn IS NOT NULL), '') AS boundaries
  FROM reg WHERE active GROUP BY ALL""", "reg"))
def _(spark, sf_dir):
    listed = registry.effective_tables(fleet.registry(spark, sf_dir))
    pairs = F.transform(F.map_entries("boundaries"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return listed.select("tenant_id", "source_id", F.array_join("tables", ",").alias("tables"), F.array_join(F.sort_array(pairs), ",").alias("boundaries"))


@query("active_continuity", sql(f"""
  SELECT tenant_id, source_id, arg_min(coalesce(diagnostic, 'ACTIVE_TABLE_UNAVAILABLE'), table_id) AS error_code FROM reg WHERE active AND {_UNAVAILABLE} GROUP BY ALL""", "reg"))
def _(spark, sf_dir):
    return registry.active_continuity(fleet.registry(spark, sf_dir))


@query("position_coverage", sql(f"""
  SELECT tenant_id, source_id, table_name, CAST(instances AS BIGINT) AS instances, instances > 0 AND covered AS covered,
    CASE WHEN instances = 0 THEN 'SOURCE_TABLE_NOT_CDC_ENABLED' WHEN NOT covered THEN 'SOURCE_POSITION_UNAVAILABLE' END AS error_code
  FROM (SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, name AS table_name,
      CASE WHEN h % 7 = 0 THEN 0 WHEN h % 8 = 0 THEN 2 ELSE 1 END AS instances,
      s % 9 = 0 OR (s % 10 <> 7 AND ((h % 32 <= 16 AND (h % 5 <> 0 OR h % 32 + 3 > 16)) OR (h % 8 = 0 AND h % 32 + 8 <= 16))) AS covered FROM keys)""", "keys"))
def _(spark, sf_dir):
    """Every fifth first instance ended three blocks after its start; one source in ten has scanned less than it saved."""
    seen = fleet.keys(spark, sf_dir)
    tables = fleet.spark_columns(seen, {"tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "table_name": "name"})
    first = fleet.spark_columns(seen.filter("h % 7 <> 0"), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "table_name": "name", "low": "LSN(39, h % 32, 1)", "high": "CASE WHEN h % 5 = 0 THEN LSN(39, h % 32 + 3, 1) END"})
    second = fleet.spark_columns(seen.filter("h % 7 <> 0 AND h % 8 = 0"), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "table_name": "name", "low": "LSN(39, h % 32 + 8, 1)", "high": "CAST(NULL AS STRING)"})
    captures = first.unionByName(second).select("tenant_id", "source_id", "table_name", lsn.lsn_bytes(F.col("low")).alias("minimum"), lsn.lsn_bytes(F.col("high")).alias("end"))
    top = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        **fleet.POSITION, "top": "CASE WHEN s % 10 = 7 THEN LSN(39, 2, 1) ELSE LSN(40, 0, 1) END"}).withColumn("maximum", lsn.lsn_bytes(F.col("top")))
    return positions.position_coverage(tables, captures, top)


def _collision_inputs(spark, sf_dir):
    """Change rows at, before and after each source's saved block; a few sources saved no change position."""
    seen = fleet.keys(spark, sf_dir)
    rows = fleet.spark_columns(seen.filter("h % 7 <> 0"), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "table_name": "'dbo.' || name", "c": "LSN(39, 16, CASE WHEN h % 5 = 0 THEN 3 ELSE 4 END)", "q": "LSN(39, 16, 2)"})
    rows = rows.withColumn("start_lsn", lsn.lsn_bytes(F.col("c"))).withColumn("seqval", lsn.lsn_bytes(F.col("q")))
    saved = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "commit_lsn": fleet.SAVED, "change_lsn": "CASE WHEN s % 6 = 0 THEN 'NULL' ELSE LSN(39, 16, 2) END"})
    return rows, saved


_BLOCKED = "s % 6 <> 0 AND (h % 7 = 0 OR h % 5 = 0)"


@query("boundary_collision", sql(f"""
  SELECT tenant_id, source_id, 'dbo.' || table_name AS table_name, s % 6 <> 0 AND h % 7 <> 0 AND h % 5 = 0 AS collides, {_BLOCKED} AS blocked
  FROM reg WHERE NOT active AND desired_enabled""", "reg"))
def _(spark, sf_dir):
    rows, saved = _collision_inputs(spark, sf_dir)
    return positions.boundary_collision(_requested(spark, sf_dir), rows, saved, rows)


def _heartbeats(spark, sf_dir):
    """Heartbeat change rows: each source's tick, most of it captured, and the greatest position scanned."""
    ids = fleet.source_keys(spark, sf_dir)
    base = {"tenant_id": fleet.TENANT, "source_id": fleet.SOURCE}
    rows = fleet.spark_columns(ids.selectExpr("s", "explode(array(2, 3, 4)) AS op"), {
        **base, "singleton_id": "CASE WHEN s % 11 = 0 THEN 2 ELSE 1 END", "tick_sequence": "s + CASE WHEN s % 7 = 0 THEN 1 ELSE 0 END", "operation": "op", "c": "LSN(40, s, op)"})
    ticks = fleet.spark_columns(ids, {**base, "tick_sequence": "s"})
    top = fleet.spark_columns(ids, {**base, "c": "CASE WHEN s % 5 = 0 THEN LSN(40, s, 3) ELSE LSN(40, s + 1, 0) END"})
    return rows.withColumn("start_lsn", lsn.lsn_bytes(F.col("c"))), ticks, top.withColumn("maximum", lsn.lsn_bytes(F.col("c")))


_BOUNDARY = "CASE WHEN s % 11 <> 0 AND s % 7 <> 0 AND s % 5 <> 0 THEN printf('%08x:%08x:%04x', 40, s + 1, 0) END"


@query("onboarding_boundary", sql(f"SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, {_BOUNDARY} AS boundary FROM src", "src"))
def _(spark, sf_dir):
    return positions.onboarding_boundary(*_heartbeats(spark, sf_dir))


def _offset_rows(spark, sf_dir):
    """One offset per source; every thirteenth still carries a snapshot marker."""
    return fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "id": "'o' || s", "offset_key": "'k' || s",
        "offset_val": f"'{{' || CASE WHEN s % 13 = 0 THEN '\"snapshot\":\"INITIAL\",' ELSE '' END || '\"commit_lsn\":\"' || {fleet.SAVED} || '\"}}'"})


@query("onboarding_decision", sql(f"""
  SELECT tenant_id, source_id, requests, CASE WHEN reason IS NULL THEN 'READY' ELSE 'WAIT' END AS decision, reason, CASE WHEN reason IS NULL THEN boundary END AS boundary
  FROM (SELECT tenant_id, source_id, count(*) AS requests, any_value(boundary) AS boundary,
      CASE WHEN any_value(s) % 13 = 0 THEN 'SNAPSHOT_MARKER' WHEN bool_or(uncovered) THEN 'POSITION_NOT_COVERED' WHEN bool_or(blocked) THEN 'BOUNDARY_COLLISION'
        WHEN any_value(boundary) IS NULL THEN 'BOUNDARY_NOT_CAPTURED' WHEN bool_or(h % 15 = 3) THEN 'REQUESTS_CHANGED' END AS reason
    FROM (SELECT y.*, r.h, {_BLOCKED.replace('s %', 'r.s %').replace('h %', 'r.h %')} AS blocked, r.h % 7 = 0 AS uncovered, {_BOUNDARY.replace('s %', 'r.s %').replace('40, s', '40, r.s')} AS boundary
          FROM ({_READY}) y JOIN reg r ON r.s = y.s AND y.table_name = 'dbo.' || r.table_name) GROUP BY tenant_id, source_id)""", "reg", "obs", "pos"))
def _(spark, sf_dir):
    rows = fleet.registry(spark, sf_dir)
    ready = registry.ready_requests(rows, fleet.observations(spark, sf_dir), fleet.positions(spark, sf_dir))
    change_rows, saved = _collision_inputs(spark, sf_dir)
    captures = fleet.observations(spark, sf_dir).select(
        "tenant_id", "source_id", F.concat(F.lit("dbo."), "table_name").alias("table_name"), F.explode("minimums").alias("minimum"), F.lit(None).cast("binary").alias("end"))
    top = fleet.positions(spark, sf_dir).withColumn("maximum", F.unhex(F.lit("ffffffffffffffffffff")))
    # Some requests are no longer ready when looked at again.
    ids = F.substring("source_id", 2, 20).cast("bigint")
    after = ready.join(fleet.keys(spark, sf_dir).filter("h % 15 <> 3").selectExpr("'S' || s AS source_id", "'dbo.' || name AS table_name"), ["source_id", "table_name"], "left_semi").filter(ids >= 0)
    return registry.onboarding_decision(
        ready, _offset_rows(spark, sf_dir), positions.position_coverage(ready, captures, top),
        positions.boundary_collision(ready, change_rows, saved, change_rows), positions.onboarding_boundary(*_heartbeats(spark, sf_dir)), after)


def _bootstrap(spark, sf_dir):
    """Registries of sources whose number leaves 0 modulo 4 exist; the others are to be loaded first."""
    existing = fleet.registry(spark, sf_dir).filter("CAST(substring(source_id, 2) AS BIGINT) % 4 = 0")
    return registry.registry_initialize(fleet.sources(spark, sf_dir), fleet.observations(spark, sf_dir), existing, fleet.activation(spark, sf_dir), NOW)


_INIT_CODE = "CASE WHEN s % 4 = 0 THEN NULL WHEN s % 8 <> 0 AND s % 5 <> 0 THEN 'TABLE_REGISTRY_MISSING' WHEN s % 8 <> 0 AND s % 6 = 1 THEN 'TABLE_REGISTRY_BOOTSTRAP_CONFIGURATION_MISMATCH' END"


@query("registry_initialize", sql(f"""
  SELECT {REG_LIST} FROM reg WHERE s % 4 = 0 UNION ALL BY NAME
  SELECT r.table_id, r.tenant_id, r.source_id, r.schema_name, r.table_name, o.table_id IS NOT NULL AS sql_cdc_enabled, o.fingerprint AS capture_fingerprint, true AS desired_enabled, true AS active,
    CASE WHEN o.table_id IS NULL THEN 'MISSING' ELSE 'ONBOARDING' END AS state,
    CASE WHEN o.table_id IS NULL THEN 'SOURCE_TABLE_NOT_CDC_ENABLED' ELSE 'AWAITING_CAPTURE_PROGRESS' END AS diagnostic, {NOW_SQL} AS observed_at, CAST(0 AS BIGINT) AS version
  FROM (SELECT *, {_INIT_CODE} AS code FROM reg WHERE s % 4 <> 0) r LEFT JOIN obs o USING (table_id) WHERE code IS NULL""", "reg", "obs"))
def _(spark, sf_dir):
    return _bootstrap(spark, sf_dir)[0]


@query("registry_initialize_outcome", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, {_INIT_CODE} AS error_code, s % 8 <> 0 AND ({_INIT_CODE}) IS NULL AS table_registry_initialized FROM src""", "src"))
def _(spark, sf_dir):
    return _bootstrap(spark, sf_dir)[1]


def _choose(*results: str) -> str:
    missing, idle, idle_blocked, pending, pending_blocked, stopping, blocked, lost, joining, kept = results
    return (f"CASE WHEN NOT found THEN {missing} WHEN NOT act AND NOT des AND eligible THEN {idle} WHEN NOT act AND NOT des THEN {idle_blocked} "
            f"WHEN NOT act AND eligible THEN {pending} WHEN NOT act THEN {pending_blocked} WHEN NOT des THEN {stopping} WHEN NOT eligible THEN {blocked} "
            f"WHEN gap THEN {lost} WHEN state IS DISTINCT FROM 'ACTIVE' THEN {joining} ELSE {kept} END")


_KEPT = ", ".join(c for c in registry.REGISTRY_COLUMNS if c not in {
    "table_id", "tenant_id", "source_id", "schema_name", "table_name", "sql_cdc_enabled", "capture_fingerprint", "desired_enabled", "active", "state",
    "diagnostic", "observed_at", "capture_instances", "version"})


_OBSERVED = f"""
  SELECT table_id, tenant_id, source_id, schema_name, table_name, found AS sql_cdc_enabled, CASE WHEN found THEN fingerprint ELSE capture_fingerprint END AS capture_fingerprint,
    des AS desired_enabled, act AS active,
    {_choose("'MISSING'", "'DISCOVERED'", "'BLOCKED'", "'PENDING'", "'BLOCKED'", "'STOPPING'", "'BLOCKED'", "'BLOCKED'", "'ONBOARDING'", "state")} AS state,
    {_choose("'SOURCE_TABLE_NOT_CDC_ENABLED'", "'NOT_CONFIGURED'", "seen", "'WAITING_SAFE_SOURCE_BOUNDARY'", "seen", "'DISABLED_BY_ADMIN'", "seen", "'CAPTURE_HISTORY_GAP'", "'AWAITING_CAPTURE_PROGRESS'", "diagnostic")} AS diagnostic,
    {NOW_SQL} AS observed_at, CASE WHEN found THEN instances END AS capture_instances, CASE WHEN version IS NULL THEN CAST(0 AS BIGINT) ELSE version + 1 END AS version, {_KEPT}
  FROM (SELECT coalesce(r.table_id, o.table_id) AS table_id, coalesce(r.tenant_id, o.tenant_id) AS tenant_id, coalesce(r.source_id, o.source_id) AS source_id, 'dbo' AS schema_name,
      coalesce(r.table_name, o.table_name) AS table_name, o.table_id IS NOT NULL AS found, coalesce(r.active, false) AS act, coalesce(r.desired_enabled, false) AS des, coalesce(o.eligible, false) AS eligible,
      o.diagnostic AS seen, o.fingerprint, o.instances, r.capture_fingerprint, r.state, r.diagnostic, r.version, {", ".join("r." + c.strip() for c in _KEPT.split(","))},
      p.saved_commit IS NOT NULL AND NOT coalesce({_COVERED}, false) AS gap
    FROM reg r FULL JOIN obs o USING (table_id) JOIN pos p ON p.s = coalesce(r.s, o.s))"""


@query("registry_observe", sql(_OBSERVED, "reg", "obs", "pos"))
def _(spark, sf_dir):
    return registry.registry_observe(fleet.registry(spark, sf_dir), fleet.observations(spark, sf_dir), fleet.positions(spark, sf_dir), NOW)


@query("monitor_pass", sql(f"""
  SELECT tenant_id, source_id, CASE WHEN f IS NOT NULL THEN 'ERROR' WHEN w IS NOT NULL THEN 'DEGRADED' ELSE 'RUNNING' END AS state, coalesce('CONSUMER_' || f, w, 'CAPTURE_AND_CONSUMER_RUNNING') AS message,
    CASE WHEN w IS NULL THEN 'RUNNING' ELSE 'DEGRADED' END AS capture_state, CASE WHEN f IS NULL THEN 'RUNNING' ELSE 'ERROR' END AS consumer_state, leaving OR ready AS reconfigure
  FROM (
    SELECT n.tenant_id, n.source_id, bool_or(active AND {_UNAVAILABLE}) AS leaving, bool_or(coalesce(n.desired_enabled AND NOT n.active AND n.state = 'PENDING' AND {_COVERED}, false)) AS ready,
      CASE WHEN any_value(p.s) % 7 = 1 THEN 'SOURCE_FENCED' END AS f,
      CASE WHEN any_value(p.s) % 11 = 2 THEN 'BROKER_BACKLOG_HIGH' WHEN any_value(p.s) % 5 = 3 THEN 'CAPTURE_PROGRESS_STALE' WHEN any_value(p.s) % 13 = 5 THEN 'CDC_SCAN_STALE'
        WHEN bool_or({_UNACKNOWLEDGED}) THEN 'TABLE_CAPTURE_SUSPENDED' WHEN bool_or(n.active AND n.schema_state IS NOT DISTINCT FROM 'REFRESH_FAILED') THEN 'CAPTURE_SCHEMA_REFRESH_FAILED' END AS w
    FROM ({_OBSERVED}) n JOIN pos p ON 'S' || p.s = n.source_id LEFT JOIN obs o ON o.table_id = n.table_id GROUP BY ALL)""", "reg", "obs", "pos"))
def _(spark, sf_dir):
    """All sources at once: what was seen of their tables, their warnings and their readers' progress."""
    keys = fleet.source_keys(spark, sf_dir)
    metrics = fleet.spark_columns(keys, {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "retention_minutes": "20160", "minimum_minutes": "20160", "capture_running": "true", "job_state_unavailable": "false",
        "recent_errors": "false", "scan_age_s": "CASE WHEN s % 13 = 5 THEN 301 ELSE 300 END", "free_bytes": "CAST(9000000000 AS BIGINT)", "capped_free_pages": "CAST(NULL AS BIGINT)",
        "headroom_s": "604800", "volume_unavailable": "false"})
    runtime = fleet.spark_columns(keys, {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "progress_age_s": "CASE WHEN s % 5 = 3 THEN 121 ELSE 120 END", "backlog": "CASE WHEN s % 11 = 2 THEN 100001 ELSE 100000 END",
        "consumer_failure": "CASE WHEN s % 7 = 1 THEN 'SOURCE_FENCED' END"})
    _, status = registry.monitor_pass(fleet.registry(spark, sf_dir), fleet.observations(spark, sf_dir), fleet.positions(spark, sf_dir), metrics, runtime, NOW)
    return status


def _suspended(spark, sf_dir):
    """Callers of every fifth source hold an old fence."""
    current = fleet.activation(spark, sf_dir)
    expected = current.withColumn("fence", F.when(F.substring("source_id", 2, 20).cast("bigint") % 5 == 2, F.col("fence") - 1).otherwise(F.col("fence")))
    return registry.registry_suspend(fleet.registry(spark, sf_dir), fleet.sources(spark, sf_dir), current, expected, fleet.positions(spark, sf_dir), NOW)


_SUSPEND = f"""
  SELECT a.s, a.fence, a.configuration_hash, n.leaving, y.h256,
    CASE WHEN a.s % 5 = 2 THEN 'SOURCE_FENCED' WHEN n.leaving > 0 AND n.staying = 0 THEN 'ALL_CAPTURED_TABLES_UNAVAILABLE' END AS code
  FROM act a JOIN (SELECT s, count(*) FILTER (active AND {_UNAVAILABLE}) AS leaving, count(*) FILTER (active AND NOT {_UNAVAILABLE}) AS staying FROM reg GROUP BY s) n USING (s)
  LEFT JOIN ({fleet.hash_sql(f"active AND NOT {_UNAVAILABLE}")}) y USING (s)"""


@query("registry_suspend", sql(replaced(
    {"suspension_reason": "CASE WHEN NOT desired_enabled THEN 'DISABLED_BY_ADMIN' ELSE coalesce(diagnostic, 'ACTIVE_TABLE_UNAVAILABLE') END", "active": "false", "desired_enabled": "false",
     "suspended_at": NOW_SQL, "suspended_lsn": "saved_commit", "activation_lsn": "NULL", "state": "CASE WHEN sql_cdc_enabled THEN 'DISCOVERED' ELSE 'MISSING' END",
     "diagnostic": "CASE WHEN sql_cdc_enabled THEN 'NOT_CONFIGURED' ELSE 'SOURCE_TABLE_NOT_CDC_ENABLED' END"},
    f"ok AND active AND {_UNAVAILABLE}",
    f"(SELECT reg.*, p.saved_commit, d.s IS NOT NULL AS ok FROM reg JOIN pos p USING (s) LEFT JOIN (SELECT s FROM ({_SUSPEND}) WHERE code IS NULL) d USING (s))"), "reg", "pos", "act"))
def _(spark, sf_dir):
    return _suspended(spark, sf_dir)[0]


@query("registry_suspend_outcome", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, code AS error_code, code IS NULL AND leaving > 0 AS changed,
    CASE WHEN code IS NULL AND leaving > 0 THEN fence + 1 ELSE fence END AS fence, CASE WHEN code IS NULL AND leaving > 0 THEN h256 ELSE configuration_hash END AS configuration_hash
  FROM ({_SUSPEND})""", "reg", "act"))
def _(spark, sf_dir):
    return _suspended(spark, sf_dir)[1]


@query("registry_acknowledge", sql(replaced(
    {"suspension_reason": "'DISABLED_BY_ADMIN'"},
    "coalesce(requested_at > suspended_at AND NOT active AND NOT desired_enabled AND suspension_reason IS DISTINCT FROM 'DISABLED_BY_ADMIN', false)"), "reg"))
def _(spark, sf_dir):
    return registry.registry_acknowledge(fleet.registry(spark, sf_dir))


@query("registry_starting", sql(replaced({"state": "'ONBOARDING'", "diagnostic": "'AWAITING_CAPTURE_PROGRESS'"}, "active AND state = 'ACTIVE'"), "reg"))
def _(spark, sf_dir):
    return registry.registry_starting(fleet.registry(spark, sf_dir))


@query("registry_confirm_progress", sql(replaced(
    {"state": "'ACTIVE'", "diagnostic": "NULL", "enabled_at": f"coalesce(enabled_at, {NOW_SQL})"},
    f"s % 9 <> 0 AND active AND sql_cdc_enabled AND state = 'ONBOARDING' AND (activation_lsn IS NULL OR {_SAVED} > activation_lsn)"), "reg"))
def _(spark, sf_dir):
    return registry.registry_confirm_progress(fleet.registry(spark, sf_dir), fleet.positions(spark, sf_dir), NOW)


def _onboarded(spark, sf_dir):
    """Pending tables are asked for. Every guard fails for some sources: fence, checkpoint, boundary, request."""
    number = F.substring("source_id", 2, 20).cast("bigint")
    current = fleet.activation(spark, sf_dir)
    expected = current.withColumn("fence", F.when(number % 5 == 2, F.col("fence") - 1).otherwise(F.col("fence")))
    stored = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "id": "'o' || s", "offset_key": "'k' || s", "offset_val": f"'{{\"commit_lsn\":\"' || {fleet.SAVED} || '\"}}'"})
    read = stored.withColumn("offset_key", F.when(number % 7 == 3, "other").otherwise(F.col("offset_key")))
    boundaries = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "boundary": "CASE WHEN s % 11 = 4 THEN LSN(39, 2, 1) ELSE LSN(40, s, 1) END"})
    rows = fleet.registry(spark, sf_dir)
    asked = rows.filter("NOT active AND desired_enabled AND (state = 'PENDING' OR CAST(substring(source_id, 2) AS BIGINT) % 13 = 6)").select(
        "tenant_id", "source_id", F.concat(F.lit("dbo."), "table_name").alias("table_name"))
    return registry.registry_onboard(rows, fleet.sources(spark, sf_dir), current, stored, read, asked, boundaries, expected)


_ASKED = "(NOT active AND desired_enabled AND (state = 'PENDING' OR s % 13 = 6))"
_FIT = "(NOT active AND desired_enabled AND sql_cdc_enabled AND state = 'PENDING')"
_ONBOARD = f"""
  SELECT q.s, a.fence, a.configuration_hash, CASE WHEN q.s % 11 = 4 THEN printf('%08x:%08x:%04x', 39, 2, 1) ELSE printf('%08x:%08x:%04x', 40, q.s, 1) END AS boundary,
    CASE WHEN a.s IS NULL OR q.s % 5 = 2 THEN 'SOURCE_FENCED' WHEN q.s % 7 = 3 THEN 'ONBOARDING_CHECKPOINT_CHANGED' WHEN q.s % 11 = 4 THEN 'ONBOARDING_BOUNDARY_BEFORE_CHECKPOINT'
      WHEN q.fit < q.asked THEN 'ONBOARDING_REQUEST_CHANGED' END AS code
  FROM (SELECT s, count(*) AS asked, count(*) FILTER ({_FIT}) AS fit FROM reg WHERE {_ASKED} GROUP BY s) q LEFT JOIN act a USING (s)"""
_ONBOARD_ROWS = f"(SELECT reg.*, d.boundary, d.s IS NOT NULL AND {_ASKED} AS ok FROM reg LEFT JOIN (SELECT s, boundary FROM ({_ONBOARD}) WHERE code IS NULL) d USING (s))"


@query("registry_onboard", sql(replaced(
    {"active": "true", "state": "'ONBOARDING'", "diagnostic": "'AWAITING_CAPTURE_PROGRESS'", "activation_lsn": "boundary", "suspended_at": "NULL", "suspension_reason": "NULL", "suspended_lsn": "NULL"},
    "ok", _ONBOARD_ROWS), "reg", "act"))
def _(spark, sf_dir):
    return _onboarded(spark, sf_dir)[0]


@query("registry_onboard_outcome", sql(f"""
  SELECT 'T' || o.s AS tenant_id, 'S' || o.s AS source_id, code AS error_code, CASE WHEN code IS NULL THEN fence + 1 ELSE fence END AS fence,
    CASE WHEN code IS NULL THEN h256 ELSE configuration_hash END AS configuration_hash
  FROM ({_ONBOARD}) o LEFT JOIN ({fleet.hash_sql("active OR ok", _ONBOARD_ROWS)}) n USING (s)""", "reg", "act"))
def _(spark, sf_dir):
    return _onboarded(spark, sf_dir)[1]


@query("claim_activation", sql(f"""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, CASE WHEN a.s IS NULL THEN 'new-' || s ELSE incarnation END AS incarnation, coalesce(configuration_hash, h256) AS configuration_hash,
    coalesce(created_at, {NOW_SQL}) AS created_at, CAST(CASE WHEN a.s IS NULL THEN 1 WHEN s % 6 = 1 THEN fence ELSE fence + 1 END AS BIGINT) AS fence,
    coalesce(table_registry_initialized, false) OR (s % 4 <> 0 AND NOT (a.s IS NOT NULL AND s % 6 = 1)) AS table_registry_initialized,
    CASE WHEN a.s IS NOT NULL AND s % 6 = 1 THEN 'SOURCE_CONFIGURATION_CHANGED' END AS error_code
  FROM hashes LEFT JOIN act a USING (s)""", "act"))
def _(spark, sf_dir):
    prepared = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {"source_id": fleet.SOURCE, "incarnation": "'new-' || s"})
    listed = fleet.registry(spark, sf_dir).filter("CAST(substring(source_id, 2) AS BIGINT) % 4 <> 0")
    return registry.claim_activation(fleet.sources(spark, sf_dir), fleet.activation(spark, sf_dir), listed, prepared, NOW)


@query("startup_consistency", sql("""
  SELECT 'T' || s AS tenant_id, 'S' || s AS source_id, CASE WHEN s % 14 = 9 THEN 'SOURCE_IDENTITY_CHANGED' WHEN s % 8 <> 0 AND s % 3 = 0 THEN 'SCHEMA_HISTORY_MISSING'
    WHEN s % 8 = 0 AND (s % 5 = 0 OR s % 3 <> 0) THEN 'ACTIVATION_STATE_INCONSISTENT' END AS error_code FROM src""", "src"))
def _(spark, sf_dir):
    flags = fleet.spark_columns(fleet.source_keys(spark, sf_dir), {
        "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "has_history": "s % 5 = 0", "has_schema_history": "s % 3 <> 0",
        "stored_source_id": "CASE WHEN s % 14 = 9 THEN 'foreign' WHEN s % 8 <> 0 THEN 'S' || s END"})
    return registry.startup_consistency(fleet.activation(spark, sf_dir), flags)


@query("fence_guard", sql("""
  SELECT k.h AS row_number, 'S' || k.s AS source_id, CASE WHEN a.s IS NULL OR a.fence <> k.h % 4 + 1 THEN 'SOURCE_FENCED' END AS error_code
  FROM keys k LEFT JOIN act a USING (s)""", "act", "keys"))
def _(spark, sf_dir):
    batch = fleet.spark_columns(fleet.keys(spark, sf_dir), {"row_number": "h", "source_id": fleet.SOURCE, "fence": "CAST(h % 4 + 1 AS BIGINT)"})
    return history.fence_guard(batch, fleet.activation(spark, sf_dir)).select("row_number", "source_id", "error_code")


def _grants(spark, sf_dir):
    return fleet.spark_columns(fleet.source_keys(spark, sf_dir), {"tenant_id": fleet.TENANT, "can_manage": "s % 3 <> 1"})


_CAN = f"(s % 3 <> 1 AND state = 'DISCOVERED' AND sql_cdc_enabled AND NOT desired_enabled AND NOT active AND date_diff('second', observed_at, {NOW_SQL}) <= 120)"


@query("can_enable", sql(f"SELECT table_id, {_CAN} AS can_enable FROM reg", "reg"))
def _(spark, sf_dir):
    return registry.can_enable(fleet.registry(spark, sf_dir), _grants(spark, sf_dir), NOW).select("table_id", "can_enable")


@query("tables_page", sql(f"""
  SELECT table_id, source_id, schema_name, table_name, sql_cdc_enabled, desired_enabled, active, state, diagnostic, observed_at, requested_at, enabled_at, activation_lsn, s % 3 <> 1 AS can_manage, {_CAN} AS can_enable,
    (SELECT count(*) FROM reg WHERE lower('dbo.' || table_name) LIKE '%a%' AND state = 'DISCOVERED') AS total_elements
  FROM reg WHERE lower('dbo.' || table_name) LIKE '%a%' AND state = 'DISCOVERED' ORDER BY schema_name, table_name, source_id, table_id LIMIT 10 OFFSET 10""", "reg"))
def _(spark, sf_dir):
    return registry.tables_page(fleet.registry(spark, sf_dir), _grants(spark, sf_dir), NOW, query="A", state="DISCOVERED", page=1, size=10)


def _requests(spark, sf_dir):
    """One request per table by turns; every twelfth names a table its tenant does not have."""
    rows = fleet.spark_columns(fleet.keys(spark, sf_dir), {
        "request_id": "h", "tenant_id": fleet.TENANT, "source_id": fleet.SOURCE, "schema_name": "'dbo'", "table_name": "CASE WHEN h % 12 = 11 THEN 'foreign' ELSE name END",
        "action": "CASE h % 5 WHEN 0 THEN 'refresh' WHEN 1 THEN 'stop' WHEN 2 THEN 'refresh' ELSE 'enable' END", "requested_by": "'admin'"})
    return registry.table_ids(rows).select("request_id", "tenant_id", "table_id", "action", "requested_by")


_FRESH = f"date_diff('second', observed_at, {NOW_SQL}) <= 120"
_ACTION = "CASE h % 5 WHEN 0 THEN 'refresh' WHEN 1 THEN 'stop' WHEN 2 THEN 'refresh' ELSE 'enable' END"
_REQUESTS = f"""
  SELECT *, CASE WHEN h % 12 = 11 THEN 'NOT_FOUND'
    WHEN action = 'enable' THEN CASE WHEN desired_enabled THEN 'UNCHANGED' WHEN {_FRESH} AND sql_cdc_enabled AND state = 'DISCOVERED' THEN 'APPLIED' ELSE 'CONFLICT' END
    WHEN action = 'refresh' THEN CASE WHEN active AND state IN ('ACTIVE', 'ONBOARDING') AND {_FRESH} THEN CASE WHEN refresh_requested_at IS NULL THEN 'APPLIED' ELSE 'UNCHANGED' END ELSE 'CONFLICT' END
    WHEN desired_enabled AND (active OR state = 'PENDING') THEN 'APPLIED' WHEN {_UNACKNOWLEDGED} THEN 'APPLIED' ELSE 'UNCHANGED' END AS outcome
  FROM (SELECT *, {_ACTION} AS action FROM reg)"""


@query("apply_requests", sql(replaced(
    {"desired_enabled": "CASE action WHEN 'enable' THEN true WHEN 'stop' THEN false ELSE desired_enabled END", "state": "CASE action WHEN 'enable' THEN 'PENDING' ELSE state END",
     "requested_at": f"CASE WHEN action = 'refresh' THEN requested_at ELSE {NOW_SQL} END", "requested_by": "CASE WHEN action = 'refresh' THEN requested_by ELSE 'admin' END",
     "refresh_requested_at": f"CASE WHEN action = 'refresh' THEN {NOW_SQL} ELSE refresh_requested_at END",
     "refresh_requested_by": "CASE WHEN action = 'refresh' THEN 'admin' ELSE refresh_requested_by END"},
    "outcome = 'APPLIED'", f"({_REQUESTS})"), "reg"))
def _(spark, sf_dir):
    return registry.apply_requests(fleet.registry(spark, sf_dir), _requests(spark, sf_dir), NOW)[0]


@query("apply_requests_outcome", sql(f"SELECT h AS request_id, action, outcome FROM ({_REQUESTS})", "reg"))
def _(spark, sf_dir):
    return registry.apply_requests(fleet.registry(spark, sf_dir), _requests(spark, sf_dir), NOW)[1].select("request_id", "action", "outcome")


@query("write_registry", sql(f"SELECT {REG_LIST} FROM reg", "reg"))
def _(spark, sf_dir):
    path = run_folder(spark, "registry")
    storage.write_registry(registry.registry_starting(fleet.registry(spark, sf_dir)), path, 0)
    storage.write_registry(fleet.registry(spark, sf_dir), path, 1)
    return storage.read_snapshot(spark, path)


def refused(write) -> None:
    """A write that must be refused; its success is an error."""
    try:
        write()
    except storage.SourceFenced:
        return
    raise AssertionError("a fenced write went through")


@query("write_registry_fenced", sql(f"SELECT {REG_LIST} FROM reg", "reg"))
def _(spark, sf_dir):
    """A replaced writer, and a second one at the same version, are refused; the registry is the newer writer's."""
    path, table = run_folder(spark, "registry"), fleet.registry(spark, sf_dir)
    storage.write_registry(registry.registry_starting(table), path, 0, fence=7, writer="old")
    storage.write_registry(table, path, 1, fence=8, writer="new")
    refused(lambda: storage.write_registry(registry.registry_starting(table), path, 2, fence=7, writer="old"))
    refused(lambda: storage.write_registry(registry.registry_starting(table), path, 1, fence=8, writer="another"))
    return storage.read_snapshot(spark, path)


@query("apply_requests_repeated", ORACLES["apply_requests"])
def _(spark, sf_dir):
    """Every request comes twice, and once more with the opposite wish; the registry is as after the first ones alone."""
    asked = _requests(spark, sf_dir)
    later = F.col("request_id") + 1_000_000_000_000
    opposite = F.when(F.col("action") == "stop", "enable").otherwise("stop")
    every = asked.unionByName(asked.withColumn("request_id", later)).unionByName(asked.withColumns({"request_id": later * 2, "action": opposite}))
    return registry.apply_requests(fleet.registry(spark, sf_dir), every, NOW)[0]
