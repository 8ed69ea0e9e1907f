"""Registry of capture tables: set-based transitions over all sources at once.

A transition that fails for a source leaves that source's rows as they were and reports a code for it.
Every time and new identifier is a parameter, so a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtrail.functions import identity, lsn, names
from rowtrail.operators.history import page_size
from rowtrail.operators.monitor import OBSERVATION_STALE_SECONDS, pipeline_status, source_warning
from rowtrail.operators.positions import SOURCE

TABLE_KEY = ["tenant_id", "source_id", "schema_name", "table_name"]
# The registry's columns in storage order.
REGISTRY_SCHEMA = (
    "table_id string, tenant_id string, source_id string, schema_name string, table_name string, sql_cdc_enabled boolean, "
    "capture_fingerprint string, desired_enabled boolean, active boolean, state string, diagnostic string, observed_at timestamp, "
    "requested_at timestamp, enabled_at timestamp, requested_by string, activation_lsn string, schema_state string, schema_detail string, "
    "capture_instances string, refresh_requested_at timestamp, refresh_requested_by string, refresh_started_at timestamp, refresh_detail string, "
    "refreshed_at timestamp, refresh_error string, suspended_at timestamp, suspension_reason string, suspended_lsn string, version bigint"
)
_TYPES = dict(part.strip().split(" ") for part in REGISTRY_SCHEMA.split(","))
REGISTRY_COLUMNS = list(_TYPES)

NOT_ENABLED = "SOURCE_TABLE_NOT_CDC_ENABLED"
AWAITING = "AWAITING_CAPTURE_PROGRESS"
DISABLED_BY_ADMIN = "DISABLED_BY_ADMIN"
SOURCE_FENCED = "SOURCE_FENCED"


def _registry_rows(frame: DataFrame, **values: Column) -> DataFrame:
    """Complete registry rows: given values, the frame's own columns, null for the rest."""
    def column(name: str) -> Column:
        value = values.get(name)
        if value is None:
            value = F.col(name) if name in frame.columns else F.lit(None)
        return value.cast(_TYPES[name]).alias(name)

    return frame.select(*[column(c) for c in REGISTRY_COLUMNS])


def _updated(registry: DataFrame, condition: Column, values: dict[str, Column], extra: list[str] | None = None) -> DataFrame:
    """Registry with some columns replaced, and its version raised, where a condition holds."""
    replaced = dict(values, version=F.col("version") + 1)
    return registry.select(*[
        (F.when(condition, replaced[c].cast(_TYPES[c])).otherwise(F.col(c)) if c in replaced else F.col(c)).alias(c) for c in REGISTRY_COLUMNS
    ], *(extra or []))


def table_ids(tables: DataFrame) -> DataFrame:
    return tables.withColumn("table_id", identity.table_id(*[F.col(c) for c in TABLE_KEY]))


def _source_hash(sources: DataFrame, tables: DataFrame, heartbeat_table: str) -> DataFrame:
    """Configuration hash per source for a given list of tables (``tables`` has one array per source)."""
    return sources.select(*SOURCE, "host", "port", "database").join(tables, SOURCE).select(
        *SOURCE,
        identity.configuration_hash(
            F.col("tenant_id"), F.col("source_id"), F.col("host"), F.col("port"), F.col("database"),
            F.array_union("tables", F.array(F.lit(heartbeat_table)))).alias("configuration_hash"))


def _known_names(registry: DataFrame, condition: Column) -> DataFrame:
    """Sorted qualified names per source. A source's name list is one value by definition (its hash covers it)."""
    return registry.filter(condition).groupBy(*SOURCE).agg(
        F.sort_array(F.collect_list(names.qualified(F.col("schema_name"), F.col("table_name")))).alias("tables"))


def effective_tables(registry: DataFrame) -> DataFrame:
    """Active tables per source with the activation position of those that have one."""
    name = names.qualified(F.col("schema_name"), F.col("table_name"))
    pair = F.when(F.col("activation_lsn").isNotNull(), F.struct(name.alias("key"), F.col("activation_lsn").alias("value")))
    return registry.filter("active").groupBy(*SOURCE).agg(
        F.sort_array(F.collect_list(name)).alias("tables"),
        F.map_from_entries(F.sort_array(F.collect_list(pair))).alias("boundaries"))


def unavailable() -> Column:
    """An active table the reader can no longer serve."""
    return ~F.col("sql_cdc_enabled") | F.col("state").isin("BLOCKED", "MISSING", "STOPPING")


def _unacknowledged() -> Column:
    return F.coalesce(
        ~F.col("active") & F.col("suspended_at").isNotNull() & ~F.col("suspension_reason").eqNullSafe(F.lit(DISABLED_BY_ADMIN))
        & (F.col("requested_at").isNull() | (F.col("requested_at") < F.col("suspended_at"))), F.lit(False))


def registry_flags(registry: DataFrame) -> DataFrame:
    """What the monitor asks of each source's registry."""
    return registry.groupBy(*SOURCE).agg(
        F.bool_or(F.col("active") & unavailable()).alias("unavailable_active"),
        F.bool_or(_unacknowledged()).alias("unacknowledged_suspension"),
        F.bool_or(F.col("active") & F.col("schema_state").eqNullSafe(F.lit("REFRESH_FAILED"))).alias("failed_refresh"),
        F.bool_or(F.col("sql_cdc_enabled") & ~F.col("desired_enabled")).alias("unconfigured"))


def active_continuity(registry: DataFrame) -> DataFrame:
    """Sources whose first activation must not proceed, with the code of their first unavailable active table."""
    code = F.coalesce("diagnostic", F.lit("ACTIVE_TABLE_UNAVAILABLE"))
    return registry.filter(F.col("active") & unavailable()).groupBy(*SOURCE).agg(F.min_by(code, F.col("table_id")).alias("error_code"))


def registry_initialize(sources: DataFrame, observations: DataFrame, registry: DataFrame, activation: DataFrame, now,
                        heartbeat_table: str = names.HEARTBEAT_TABLE) -> tuple[DataFrame, DataFrame]:
    """First load of each source's allowlist; returns the registry and one outcome per source.

    Sources that have rows keep them. A source marked as initialized without rows, or whose stored
    settings differ, gets a code and no rows.
    """
    existing = registry.select(*SOURCE).distinct().withColumn("_has_rows", F.lit(True))
    configured = _source_hash(sources, sources.select(*SOURCE, "tables"), heartbeat_table).withColumnRenamed("configuration_hash", "_hash")
    claimed = activation.select(*SOURCE, F.col("configuration_hash").alias("_stored"), F.col("table_registry_initialized").alias("_marked"), F.lit(True).alias("_claimed"))
    joined = sources.select(*SOURCE, "tables").join(existing, SOURCE, "left").join(claimed, SOURCE, "left").join(configured, SOURCE)
    code = (
        F.when(F.col("_has_rows"), F.lit(None))
        .when(F.coalesce("_marked", F.lit(False)), "TABLE_REGISTRY_MISSING")
        .when(F.col("_claimed").isNotNull() & ~F.col("_stored").eqNullSafe(F.col("_hash")), "TABLE_REGISTRY_BOOTSTRAP_CONFIGURATION_MISMATCH"))
    decided = joined.withColumn("error_code", code)
    fresh = decided.filter(F.col("error_code").isNull() & F.col("_has_rows").isNull())
    part = names.split_qualified(F.col("name"))
    listed = fresh.select(*SOURCE, F.explode("tables").alias("name")).select(*SOURCE, part["schema_name"].alias("schema_name"), part["table_name"].alias("table_name"))
    seen = observations.select(*TABLE_KEY, F.col("fingerprint").alias("_fingerprint"), F.lit(True).alias("_seen"))
    found = F.col("_seen").isNotNull()
    created = _registry_rows(
        table_ids(listed.join(seen, TABLE_KEY, "left")),
        sql_cdc_enabled=found, capture_fingerprint=F.col("_fingerprint"), desired_enabled=F.lit(True), active=F.lit(True),
        state=F.when(found, "ONBOARDING").otherwise("MISSING"), diagnostic=F.when(found, AWAITING).otherwise(NOT_ENABLED),
        observed_at=F.lit(now), version=F.lit(0))
    outcomes = decided.select(*SOURCE, "error_code", (F.col("_claimed").isNotNull() & F.col("error_code").isNull()).alias("table_registry_initialized"))
    return registry.select(*REGISTRY_COLUMNS).unionByName(created), outcomes


def _covers_start(saved: Column) -> Column:
    return F.exists("minimums", lambda m: lsn.ready_lsn(m) & (lsn.lsn_bytes(saved) >= m)) & F.col("eligible")


def registry_observe(registry: DataFrame, observations: DataFrame, positions: DataFrame, now) -> DataFrame:
    """Registry after a complete look at each source's capture tables.

    ``observations`` has fingerprint, eligibility, ``minimums`` (start positions of ready captures) and
    ``instances`` (their names). ``positions`` has one ``saved_commit`` per observed source (null where none); rows of
    sources that were not observed stay as they are.
    """
    seen = observations.select(*TABLE_KEY, "fingerprint", "eligible", F.col("diagnostic").alias("_obs_diagnostic"), "minimums",
                               F.col("instances").alias("_instances"), F.lit(True).alias("_seen"))
    # Full outer join of the two sides, with positions only looked up for the result.
    joined = registry.join(seen, TABLE_KEY, "full_outer").join(positions.select(*SOURCE, "saved_commit", F.lit(True).alias("_looked_at")), SOURCE, "left")
    looked_at = F.col("_looked_at").isNotNull() | F.col("_seen").isNotNull()
    new, found = F.col("table_id").isNull(), F.col("_seen").isNotNull()
    active, desired = F.coalesce("active", F.lit(False)), F.coalesce("desired_enabled", F.lit(False))
    eligible = F.coalesce("eligible", F.lit(False))
    saved = F.col("saved_commit")
    gap = saved.isNotNull() & ~F.coalesce(_covers_start(saved), F.lit(False))

    def choose(missing, idle, idle_blocked, pending, pending_blocked, stopping, blocked, lost, joining, kept):
        return (
            F.when(~found, missing)
            .when(~active & ~desired & eligible, idle).when(~active & ~desired, idle_blocked)
            .when(~active & eligible, pending).when(~active, pending_blocked)
            .when(~desired, stopping).when(~eligible, blocked).when(gap, lost)
            .when(F.coalesce(F.col("state"), F.lit("")) != "ACTIVE", joining).otherwise(kept))

    diagnostic = F.col("_obs_diagnostic")
    text = F.lit
    state = choose(text("MISSING"), text("DISCOVERED"), text("BLOCKED"), text("PENDING"), text("BLOCKED"), text("STOPPING"),
                   text("BLOCKED"), text("BLOCKED"), text("ONBOARDING"), F.col("state"))
    reason = choose(text(NOT_ENABLED), text("NOT_CONFIGURED"), diagnostic, text("WAITING_SAFE_SOURCE_BOUNDARY"), diagnostic,
                    text(DISABLED_BY_ADMIN), diagnostic, text("CAPTURE_HISTORY_GAP"), text(AWAITING), F.col("diagnostic"))
    names_text = F.when(F.length("_instances") > 0, F.col("_instances"))
    values = dict(
        sql_cdc_enabled=found, capture_fingerprint=F.when(found, F.col("fingerprint")).otherwise(F.col("capture_fingerprint")),
        desired_enabled=desired, active=active, state=state, diagnostic=reason, observed_at=F.lit(now),
        capture_instances=F.when(found, names_text), version=F.when(new, 0).otherwise(F.col("version") + 1))
    return _registry_rows(
        joined, table_id=F.coalesce("table_id", identity.table_id(*[F.col(c) for c in TABLE_KEY])),
        **{name: F.when(looked_at, value).otherwise(F.col(name)) for name, value in values.items()})


def missing_tables(registry: DataFrame, observations: DataFrame, positions: DataFrame) -> DataFrame:
    """Registered tables of observed sources (those with a row in ``positions``) that a complete look did not find."""
    looked_at = registry.select(*TABLE_KEY).join(positions.select(*SOURCE), SOURCE, "left_semi")
    return looked_at.join(observations.select(*TABLE_KEY), TABLE_KEY, "left_anti").select(*TABLE_KEY)


def registry_suspend(registry: DataFrame, sources: DataFrame, activation: DataFrame, expected: DataFrame, positions: DataFrame, now,
                     heartbeat_table: str = names.HEARTBEAT_TABLE) -> tuple[DataFrame, DataFrame]:
    """Take unavailable active tables out; returns the registry and each source's outcome.

    ``expected`` has the ``fence`` and ``configuration_hash`` each caller believes current. The outcome
    has the new hash and fence, or the code that left the source untouched.
    """
    leaving = F.col("active") & unavailable()
    counts = registry.groupBy(*SOURCE).agg(F.count_if(leaving).alias("_leaving"), F.count_if(F.col("active") & ~leaving).alias("_staying"))
    remaining = _source_hash(sources, _known_names(registry, F.col("active") & ~leaving), heartbeat_table).withColumnRenamed("configuration_hash", "_new_hash")
    current = activation.select(*SOURCE, F.col("fence").alias("_fence"), F.col("configuration_hash").alias("_hash"))
    decided = (
        expected.select(*SOURCE, "fence", "configuration_hash").join(current, SOURCE, "left").join(counts, SOURCE, "left").join(remaining, SOURCE, "left")
        .select(
            *SOURCE, "_fence", "_hash", "_new_hash", F.coalesce("_leaving", F.lit(0)).alias("_leaving"),
            F.when(~F.coalesce((F.col("fence") == F.col("_fence")) & (F.col("configuration_hash") == F.col("_hash")), F.lit(False)), SOURCE_FENCED)
            .when((F.col("_leaving") > 0) & (F.col("_staying") == 0), "ALL_CAPTURED_TABLES_UNAVAILABLE").alias("error_code")))
    outcome = decided.select(
        *SOURCE, "error_code", (F.col("error_code").isNull() & (F.col("_leaving") > 0)).alias("changed"),
    ).join(decided.select(*SOURCE, "_fence", "_hash", "_new_hash"), SOURCE).select(
        *SOURCE, "error_code", "changed",
        F.when(F.col("changed"), F.col("_fence") + 1).otherwise(F.col("_fence")).alias("fence"),
        F.when(F.col("changed"), F.col("_new_hash")).otherwise(F.col("_hash")).alias("configuration_hash"))
    allowed = decided.filter(F.col("error_code").isNull()).select(*SOURCE, F.lit(True).alias("_allowed"))
    joined = registry.join(allowed, SOURCE, "left").join(positions.select(*SOURCE, "saved_commit"), SOURCE, "left")
    enabled = F.col("sql_cdc_enabled")
    suspended = _updated(joined, leaving & F.col("_allowed").isNotNull(), {
        "suspension_reason": F.when(~F.col("desired_enabled"), DISABLED_BY_ADMIN).otherwise(F.coalesce("diagnostic", F.lit("ACTIVE_TABLE_UNAVAILABLE"))),
        "active": F.lit(False), "desired_enabled": F.lit(False), "suspended_at": F.lit(now), "suspended_lsn": F.col("saved_commit"),
        "activation_lsn": F.lit(None), "state": F.when(enabled, "DISCOVERED").otherwise("MISSING"),
        "diagnostic": F.when(enabled, "NOT_CONFIGURED").otherwise(NOT_ENABLED)})
    return suspended, outcome


def registry_acknowledge(registry: DataFrame) -> DataFrame:
    """A request made after a suspension, on a row that stays out, acknowledges it."""
    acknowledged = F.coalesce(
        (F.col("requested_at") > F.col("suspended_at")) & ~F.col("active") & ~F.col("desired_enabled")
        & ~F.col("suspension_reason").eqNullSafe(F.lit(DISABLED_BY_ADMIN)), F.lit(False))
    return _updated(registry, acknowledged, {"suspension_reason": F.lit(DISABLED_BY_ADMIN)})


def ready_requests(registry: DataFrame, observations: DataFrame, positions: DataFrame) -> DataFrame:
    """Requested tables whose captures already cover the saved position of their source."""
    seen = observations.select(*TABLE_KEY, "eligible", "minimums")
    saved = positions.filter(F.col("saved_commit").isNotNull()).select(*SOURCE, "saved_commit")
    return (
        registry.filter(F.col("desired_enabled") & ~F.col("active") & (F.col("state") == "PENDING")).select(*TABLE_KEY)
        .join(seen, TABLE_KEY).join(saved, SOURCE)
        .filter(_covers_start(F.col("saved_commit")))
        .select(*SOURCE, names.qualified(F.col("schema_name"), F.col("table_name")).alias("table_name")))


def monitor_pass(registry: DataFrame, observations: DataFrame, positions: DataFrame, metrics: DataFrame, runtime: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """One look at all sources: the registry after it, and the status of every source in ``runtime``.

    ``metrics`` is what :func:`source_warning` reads and ``runtime`` has progress, backlog and the consumer's failure. ``reconfigure``
    says that a source's reader has to start anew: it holds a table it can't serve, or a requested one is ready. Write the
    registry first where it is also planned on; the plan of both results goes through it.
    """
    observed = registry_observe(registry, observations, positions, now)
    flags = registry_flags(observed).select(*SOURCE, "unavailable_active", "unacknowledged_suspension", "failed_refresh")
    ready = ready_requests(observed, observations, positions).select(*SOURCE).distinct().withColumn("_ready", F.lit(True))
    warned = source_warning(metrics).select(*SOURCE, "warning")
    whole = runtime.join(warned, SOURCE, "left").join(flags, SOURCE, "left")
    again = whole.select(*SOURCE, "unavailable_active").join(ready, SOURCE, "left").select(
        *SOURCE, (F.coalesce("unavailable_active", F.lit(False)) | F.col("_ready").isNotNull()).alias("reconfigure"))
    return observed, pipeline_status(whole).join(again, SOURCE)


def registry_onboard(registry: DataFrame, sources: DataFrame, activation: DataFrame, offsets: DataFrame, checkpoints: DataFrame,
                     requested: DataFrame, boundaries: DataFrame, expected: DataFrame,
                     heartbeat_table: str = names.HEARTBEAT_TABLE) -> tuple[DataFrame, DataFrame]:
    """Activate requested tables at their boundary; returns the registry and each requesting source's outcome.

    ``checkpoints`` holds the offset row each caller read, ``expected`` the fence and hash it read.
    Guards run in order: fence, unchanged checkpoint, boundary not before it, request unchanged.
    """
    name = names.qualified(F.col("schema_name"), F.col("table_name"))
    wanted = requested.select(*SOURCE, F.col("table_name").alias("_name")).distinct()
    rows = registry.select(*TABLE_KEY, "active", "desired_enabled", "sql_cdc_enabled", "state", name.alias("_name"))
    fit = ~F.col("active") & F.col("desired_enabled") & F.col("sql_cdc_enabled") & (F.col("state") == "PENDING")
    matched = wanted.join(rows, [*SOURCE, "_name"], "left").groupBy(*SOURCE).agg(
        F.count(F.lit(1)).alias("_requested"), F.count_if(F.coalesce(fit, F.lit(False))).alias("_fit"))
    current = activation.select(*SOURCE, F.col("fence").alias("_fence"), F.col("configuration_hash").alias("_hash"))
    stored = offsets.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("id", "offset_key", "offset_val")).alias("_o"))
    read = checkpoints.select(*SOURCE, F.struct("id", "offset_key", "offset_val").alias("_c"))
    joined = (
        matched.join(expected.select(*SOURCE, "fence", "configuration_hash"), SOURCE, "left").join(current, SOURCE, "left")
        .join(stored, SOURCE, "left").join(read, SOURCE, "left").join(boundaries.select(*SOURCE, "boundary"), SOURCE, "left"))
    saved = F.get_json_object("_c.offset_val", "$.commit_lsn")
    code = (
        F.when(~F.coalesce((F.col("fence") == F.col("_fence")) & (F.col("configuration_hash") == F.col("_hash")), F.lit(False)), SOURCE_FENCED)
        .when(~F.coalesce((F.col("_n") == 1) & (F.col("_o") == F.col("_c")), F.lit(False)), "ONBOARDING_CHECKPOINT_CHANGED")
        .when(~lsn.valid_lsn(F.col("boundary")) | ~lsn.valid_lsn(saved), "INVALID_SOURCE_POSITION")
        .when(lsn.lsn_bytes(F.col("boundary")) < lsn.lsn_bytes(saved), "ONBOARDING_BOUNDARY_BEFORE_CHECKPOINT")
        .when(F.col("_fit") < F.col("_requested"), "ONBOARDING_REQUEST_CHANGED"))
    decided = joined.select(*SOURCE, "boundary", "_fence", "_hash", code.alias("error_code"))
    allowed = wanted.join(decided.filter(F.col("error_code").isNull()).select(*SOURCE, "boundary"), SOURCE)
    changed = registry.withColumn("_name", name).join(allowed, [*SOURCE, "_name"], "left")
    onboarded = _updated(changed, F.col("boundary").isNotNull(), {
        "active": F.lit(True), "state": F.lit("ONBOARDING"), "diagnostic": F.lit(AWAITING), "activation_lsn": F.col("boundary"),
        "suspended_at": F.lit(None), "suspension_reason": F.lit(None), "suspended_lsn": F.lit(None)})
    hashes = _source_hash(sources, _known_names(onboarded, F.col("active")), heartbeat_table).withColumnRenamed("configuration_hash", "_new_hash")
    good = F.col("error_code").isNull()
    outcome = decided.join(hashes, SOURCE, "left").select(
        *SOURCE, "error_code", F.when(good, F.col("_fence") + 1).otherwise(F.col("_fence")).alias("fence"),
        F.when(good, F.col("_new_hash")).otherwise(F.col("_hash")).alias("configuration_hash"))
    return onboarded, outcome


def registry_starting(registry: DataFrame) -> DataFrame:
    """At each start an active table has to prove progress again."""
    return _updated(registry, F.col("active") & (F.col("state") == "ACTIVE"), {"state": F.lit("ONBOARDING"), "diagnostic": F.lit(AWAITING)})


def registry_confirm_progress(registry: DataFrame, positions: DataFrame, now) -> DataFrame:
    """Onboarding tables become active once the saved commit is strictly after their activation."""
    joined = registry.join(positions.select(*SOURCE, "saved_commit"), SOURCE, "left")
    passed = F.coalesce(
        F.col("saved_commit").isNotNull() & F.col("active") & F.col("sql_cdc_enabled") & (F.col("state") == "ONBOARDING")
        & (F.col("activation_lsn").isNull() | (lsn.lsn_bytes(F.col("saved_commit")) > lsn.lsn_bytes(F.col("activation_lsn")))), F.lit(False))
    return _updated(joined, passed, {"state": F.lit("ACTIVE"), "diagnostic": F.lit(None), "enabled_at": F.coalesce("enabled_at", F.lit(now))})


def claim_activation(sources: DataFrame, activation: DataFrame, registry: DataFrame, incarnations: DataFrame, now,
                     heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Activation row each source starts under, with ``error_code`` where its settings changed.

    A new source takes fence 1 and the incarnation prepared for it; a known one must match and moves its fence on.
    """
    configured = _source_hash(sources, sources.select(*SOURCE, "tables"), heartbeat_table).withColumnRenamed("configuration_hash", "_hash")
    stored = activation.select("source_id", F.struct("tenant_id", "incarnation", "configuration_hash", "created_at", "fence", "table_registry_initialized").alias("a"))
    listed = registry.select(*SOURCE).distinct().withColumn("_listed", F.lit(True))
    joined = configured.join(stored, "source_id", "left").join(listed, SOURCE, "left").join(incarnations.select("source_id", F.col("incarnation").alias("_new")), "source_id", "left")
    known = F.col("a").isNotNull()
    changed = known & ~((F.col("_hash") == F.col("a.configuration_hash")) & (F.col("tenant_id") == F.col("a.tenant_id")))
    return joined.select(
        *SOURCE,
        F.coalesce("a.incarnation", "_new").alias("incarnation"),
        F.coalesce("a.configuration_hash", "_hash").alias("configuration_hash"),
        F.coalesce("a.created_at", F.lit(now)).alias("created_at"),
        F.when(~known, 1).when(changed, F.col("a.fence")).otherwise(F.col("a.fence") + 1).cast("bigint").alias("fence"),
        (F.coalesce("a.table_registry_initialized", F.lit(False)) | (~changed & F.col("_listed").isNotNull())).alias("table_registry_initialized"),
        F.when(changed, "SOURCE_CONFIGURATION_CHANGED").alias("error_code"))


def startup_consistency(activation: DataFrame, flags: DataFrame) -> DataFrame:
    """Code per source whose durable state does not fit together.

    ``flags`` has one row per configured source: ``has_history``, ``has_schema_history`` and the
    ``stored_source_id`` its store names (null where it has none).
    """
    claimed = activation.select("source_id", F.lit(True).alias("_claimed"))
    joined = flags.join(claimed, "source_id", "left")
    return joined.select(
        *SOURCE,
        F.when(F.coalesce(F.col("stored_source_id") != F.col("source_id"), F.lit(False)), "SOURCE_IDENTITY_CHANGED")
        .when(F.col("_claimed").isNotNull() & ~F.col("has_schema_history"), "SCHEMA_HISTORY_MISSING")
        .when(F.col("_claimed").isNull() & (F.col("has_history") | F.col("has_schema_history")), "ACTIVATION_STATE_INCONSISTENT").alias("error_code"))


def onboarding_decision(ready: DataFrame, offsets: DataFrame, coverage: DataFrame, collisions: DataFrame, boundaries: DataFrame,
                        ready_after: DataFrame) -> DataFrame:
    """READY with a boundary, or WAIT with the first reason, per source that has ready requests.

    Evidence in order: no snapshot marker, every table covers the position, no change collides with it, the
    heartbeat gave a boundary, and the same requests are still ready afterwards.
    """
    asked = ready.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("requests"))
    marker = F.get_json_object("offset_val", "$.snapshot").isNotNull() | F.get_json_object("offset_val", "$.snapshot_completed").isNotNull()
    snapshots = offsets.groupBy(*SOURCE).agg(F.bool_or(marker).alias("_snapshot"))
    covered = coverage.groupBy(*SOURCE).agg(F.bool_or(F.col("error_code").isNotNull()).alias("_uncovered"))
    blocked = collisions.groupBy(*SOURCE).agg(F.bool_or("blocked").alias("_blocked"))
    still = ready.join(ready_after, ["tenant_id", "source_id", "table_name"], "left_semi").groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("_still"))
    joined = asked
    for evidence in (snapshots, covered, blocked, boundaries.select(*SOURCE, "boundary"), still):
        joined = joined.join(evidence, SOURCE, "left")
    no = F.lit(False)
    reason = (
        F.when(F.coalesce("_snapshot", no), "SNAPSHOT_MARKER")
        .when(F.coalesce("_uncovered", no), "POSITION_NOT_COVERED")
        .when(F.coalesce("_blocked", no), "BOUNDARY_COLLISION")
        .when(F.col("boundary").isNull(), "BOUNDARY_NOT_CAPTURED")
        .when(F.coalesce("_still", F.lit(0)) < F.col("requests"), "REQUESTS_CHANGED"))
    decided = joined.withColumn("reason", reason)
    return decided.select(
        *SOURCE, "requests", F.when(F.col("reason").isNull(), "READY").otherwise("WAIT").alias("decision"), "reason",
        F.when(F.col("reason").isNull(), F.col("boundary")).alias("boundary"))


def _fresh(now) -> Column:
    return F.timestamp_diff("SECOND", F.col("observed_at"), F.lit(now)) <= OBSERVATION_STALE_SECONDS


def can_enable(registry: DataFrame, grants: DataFrame, now) -> DataFrame:
    """Add ``can_manage`` (the caller may manage the tenant) and ``can_enable``: a discovered, eligible, freshly observed table of such a tenant."""
    managed = grants.filter("can_manage").select("tenant_id").distinct().withColumn("_manages", F.lit(True))
    return registry.join(managed, "tenant_id", "left").withColumn("can_manage", F.col("_manages").isNotNull()).withColumn(
        "can_enable",
        F.col("can_manage") & (F.col("state") == "DISCOVERED") & F.col("sql_cdc_enabled") & ~F.col("desired_enabled") & ~F.col("active") & _fresh(now),
    ).drop("_manages")


def apply_requests(registry: DataFrame, requests: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Admin requests against the registry; returns the registry and one outcome per request.

    ``requests`` has ``request_id, tenant_id, table_id, action (enable, refresh, stop), requested_by``. Of several for
    a table the first by id is decided; its repeats change nothing, opposing ones conflict. Stale or unfit tables
    conflict, foreign ids are not found.
    """
    rows = registry.select("tenant_id", "table_id", "active", "desired_enabled", "state", "sql_cdc_enabled", "observed_at",
                           "refresh_requested_at", _unacknowledged().alias("_open_suspension"), F.lit(True).alias("_row"))
    in_order = Window.partitionBy("tenant_id", "table_id").orderBy("request_id")
    asked_for = requests.withColumn("_turn", F.row_number().over(in_order)).withColumn("_first_action", F.first("action").over(in_order))
    joined = asked_for.join(rows, ["tenant_id", "table_id"], "left")
    enable, refresh = F.col("action") == "enable", F.col("action") == "refresh"
    fresh, active, desired = _fresh(now), F.col("active"), F.col("desired_enabled")
    outcome = (
        F.when(F.col("_row").isNull(), "NOT_FOUND")
        .when(F.col("_turn") > 1, F.when(F.col("action") == F.col("_first_action"), "UNCHANGED").otherwise("CONFLICT"))
        .when(enable & desired, "UNCHANGED")
        .when(enable & fresh & F.col("sql_cdc_enabled") & (F.col("state") == "DISCOVERED"), "APPLIED")
        .when(enable, "CONFLICT")
        .when(refresh & active & F.col("state").isin("ACTIVE", "ONBOARDING") & fresh, F.when(F.col("refresh_requested_at").isNull(), "APPLIED").otherwise("UNCHANGED"))
        .when(refresh, "CONFLICT")
        .when(desired & (active | (F.col("state") == "PENDING")), "APPLIED")
        .when(F.col("_open_suspension"), "APPLIED")
        .otherwise("UNCHANGED"))
    outcomes = joined.select("request_id", "tenant_id", "table_id", "action", "requested_by", outcome.alias("outcome"))
    applied = outcomes.filter(F.col("outcome") == "APPLIED").select("tenant_id", "table_id", F.col("action").alias("_action"), F.col("requested_by").alias("_by"))
    changed = registry.join(applied, ["tenant_id", "table_id"], "left")
    action = F.col("_action")
    asked = F.when(action.isin("enable", "stop"), F.lit(now))
    return _updated(changed, action.isNotNull(), {
        "desired_enabled": F.when(action == "enable", True).when(action == "stop", False).otherwise(F.col("desired_enabled")),
        "state": F.when(action == "enable", "PENDING").otherwise(F.col("state")),
        "requested_at": F.coalesce(asked, F.col("requested_at")),
        "requested_by": F.when(action.isin("enable", "stop"), F.col("_by")).otherwise(F.col("requested_by")),
        "refresh_requested_at": F.when(action == "refresh", F.lit(now)).otherwise(F.col("refresh_requested_at")),
        "refresh_requested_by": F.when(action == "refresh", F.col("_by")).otherwise(F.col("refresh_requested_by"))}), outcomes


def tables_page(registry: DataFrame, grants: DataFrame, now, tenant: str | None = None, query: str = "", state: str | None = None,
                page: int = 0, size: int = 20) -> DataFrame:
    """One zero-based page of the registry by name with ``can_manage``, ``can_enable`` and ``total_elements``."""
    page_size(size)
    name = names.qualified(F.col("schema_name"), F.col("table_name"))
    found = registry.filter(F.contains(F.lower(name), F.lower(F.lit(query))))
    if tenant is not None:
        found = found.filter(F.col("tenant_id") == tenant)
    if state is not None:
        found = found.filter(F.col("state") == state)
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        can_enable(found, grants, now)
        .select("table_id", "source_id", "schema_name", "table_name", "sql_cdc_enabled", "desired_enabled", "active", "state", "diagnostic",
                "observed_at", "requested_at", "enabled_at", "activation_lsn", "can_manage", "can_enable")
        .orderBy("schema_name", "table_name", "source_id", "table_id").offset(page * size).limit(size).withColumn("total_elements", total))
