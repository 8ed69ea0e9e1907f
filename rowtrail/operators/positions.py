"""Saved source positions: validation, progress, coverage by capture instances, onboarding boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtrail.functions import identity, jsonvalue, lsn, names
from rowtrail.operators.settings import prepare_sources

SOURCE = ["tenant_id", "source_id"]
TABLE = ["tenant_id", "source_id", "table_name"]
NOT_ENABLED = "SOURCE_TABLE_NOT_CDC_ENABLED"
UNAVAILABLE = "SOURCE_POSITION_UNAVAILABLE"
CORRUPT = "SOURCE_OFFSETS_CORRUPT"
PARTITION_CHANGED = "SOURCE_OFFSET_PARTITION_CHANGED"
INCOMPLETE = "SOURCE_INITIALIZATION_INCOMPLETE"
COORDINATES = "SOURCE_REPLAY_COORDINATES_INVALID"
INVALID_POSITION = lsn.INVALID_POSITION
MISSING_OR_AMBIGUOUS = "SOURCE_OFFSETS_MISSING_OR_AMBIGUOUS"


def position_coverage(tables: DataFrame, captures: DataFrame, positions: DataFrame) -> DataFrame:
    """Whether some capture instance of each table still holds its source's saved position.

    ``captures`` has ``minimum`` and ``end`` bytes per instance, ``positions`` the ``saved_commit`` text and
    the source's ``maximum`` bytes. A source without a saved position counts as covered.
    """
    saved = positions.select(*SOURCE, lsn.lsn_bytes(F.col("saved_commit")).alias("_saved"), F.col("maximum").alias("_max"))
    held = F.coalesce(
        (F.col("_saved") >= F.col("minimum")) & (F.col("_saved") <= F.col("_max"))
        & (F.col("end").isNull() | (F.col("_saved") <= F.col("end"))), F.lit(False))
    found = captures.join(saved, SOURCE, "left").groupBy(*TABLE).agg(
        F.count(F.lit(1)).alias("instances"), F.bool_or(F.col("_saved").isNull() | held).alias("covered"))
    code = F.when(F.col("instances").isNull(), NOT_ENABLED).when(~F.col("covered"), UNAVAILABLE)
    return tables.select(*TABLE).join(found, TABLE, "left").select(
        *TABLE, F.coalesce("instances", F.lit(0)).cast("bigint").alias("instances"),
        F.coalesce("covered", F.lit(False)).alias("covered"), code.alias("error_code"))


def boundary_collision(requests: DataFrame, change_rows: DataFrame, positions: DataFrame, instances: DataFrame) -> DataFrame:
    """Requested tables that must wait: a change lies exactly at the saved position, or no instance exists.

    A position whose change part is ``NULL`` collides with nothing and needs no instance.
    """
    at = positions.select(*SOURCE, "commit_lsn", "change_lsn")
    exact = at.select(*SOURCE, lsn.lsn_bytes(F.col("commit_lsn")).alias("start_lsn"), lsn.lsn_bytes(F.col("change_lsn")).alias("seqval"))
    hit = change_rows.join(exact, [*SOURCE, "start_lsn", "seqval"], "left_semi").select(*TABLE).distinct().withColumn("_hit", F.lit(True))
    known = instances.select(*TABLE).distinct().withColumn("_known", F.lit(True))
    unset = F.coalesce(F.col("change_lsn") == lsn.NO_CHANGE_POSITION, F.lit(False))
    return (
        requests.select(*TABLE).join(at, SOURCE).join(hit, TABLE, "left").join(known, TABLE, "left")
        .select(*TABLE, (~unset & F.col("_hit").isNotNull()).alias("collides"),
                (~unset & (F.col("_hit").isNotNull() | F.col("_known").isNull())).alias("blocked")))


def onboarding_boundary(heartbeat_rows: DataFrame, ticks: DataFrame, source_max: DataFrame) -> DataFrame:
    """Activation position per source, null while its tick has not been captured.

    The tick's greatest captured row proves that all earlier commits were scanned; the boundary is the
    source's greatest position once that has reached the tick.
    """
    barrier = (
        heartbeat_rows.filter((F.col("singleton_id") == 1) & F.col("operation").isin(2, 4))
        .join(ticks.select(*SOURCE, "tick_sequence"), [*SOURCE, "tick_sequence"], "left_semi")
        .groupBy(*SOURCE).agg(F.max("start_lsn").alias("_barrier")))
    ready = lsn.ready_lsn(F.col("_barrier")) & lsn.ready_lsn(F.col("maximum")) & F.coalesce(F.col("maximum") >= F.col("_barrier"), F.lit(False))
    return ticks.select(*SOURCE).join(barrier, SOURCE, "left").join(source_max.select(*SOURCE, "maximum"), SOURCE, "left").select(
        *SOURCE, F.when(ready, lsn.lsn_text(F.col("maximum"))).alias("boundary"))


def retention_headroom(positions: DataFrame, captures: DataFrame, now) -> DataFrame:
    """Seconds until retention could remove what a source still has to read.

    ``positions`` has ``retention_minutes`` and ``saved_time``, the time of the saved position where known.
    """
    captured = captures.select(*SOURCE).distinct().withColumn("_captured", F.lit(True))
    whole = F.col("retention_minutes").cast("bigint") * 60
    age = F.timestamp_diff("SECOND", F.col("saved_time"), F.lit(now))
    left = F.when(F.col("_captured").isNotNull() & F.col("saved_time").isNotNull(), F.least(whole, whole - age)).otherwise(whole)
    return positions.join(captured, SOURCE, "left").select(*SOURCE, left.alias("headroom_seconds"))


def single_offset(offsets: DataFrame, activation: DataFrame) -> DataFrame:
    """Row counts per source and the code where they do not add up to one activation with one offset."""
    stored = offsets.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("offset_rows"))
    claimed = activation.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("activation_rows"))
    counted = claimed.join(stored, SOURCE, "full_outer").select(
        *SOURCE, F.coalesce("activation_rows", F.lit(0)).cast("bigint").alias("activation_rows"),
        F.coalesce("offset_rows", F.lit(0)).cast("bigint").alias("offset_rows"))
    return counted.withColumn(
        "error_code",
        F.when(F.col("activation_rows") > 1, "SOURCE_IDENTITY_CHANGED")
        .when((F.col("activation_rows") == 0) & (F.col("offset_rows") > 0), "ACTIVATION_MISSING_FOR_EXISTING_OFFSETS")
        .when((F.col("activation_rows") == 1) & (F.col("offset_rows") != 1), MISSING_OR_AMBIGUOUS))


def state_counts(offsets: DataFrame, chunks: DataFrame) -> DataFrame:
    """Durable offset partitions and schema-history parts per source."""
    stored = offsets.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("offset_partitions"))
    parts = chunks.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("schema_parts"))
    return stored.join(parts, SOURCE, "full_outer").select(
        *SOURCE, F.coalesce("offset_partitions", F.lit(0)).cast("bigint").alias("offset_partitions"),
        F.coalesce("schema_parts", F.lit(0)).cast("bigint").alias("schema_parts"))


def _text(value: Column, path: str) -> Column:
    """Scalar at a path as text, null for JSON null and for absent."""
    return F.try_variant_get(value, path, "string")


def _is_true(token: Column) -> Column:
    """A JSON boolean as loosely as the position format writes it: true, "true" or a number other than 0."""
    return F.coalesce(token.isin("true", '"true"') | (token.try_cast("double") != 0), F.lit(False))


def saved_position(activation: DataFrame, offsets: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """The saved commit position per source, or the code that says why it cannot be trusted.

    Sources without an activation and without offsets are pristine: no position and no code.
    """
    known = prepare_sources(sources, heartbeat_table)
    current = known.select(
        *SOURCE, "connector", "database",
        identity.configuration_hash(F.col("tenant_id"), F.col("source_id"), F.col("host"), F.col("port"), F.col("database"), F.col("captured")).alias("_hash"))
    claimed = activation.select("source_id", F.col("tenant_id").alias("_owner"), F.col("configuration_hash").alias("_stored_hash"), F.lit(True).alias("_active"))
    # Only a single offset is ever read, so one of several may stand for all.
    stored = offsets.groupBy("source_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("offset_key", "offset_val")).alias("_o"))
    joined = current.join(claimed, "source_id", "left").join(stored, "source_id", "left")
    read = joined.select(
        "*", F.coalesce("_n", F.lit(0)).alias("_rows"),
        jsonvalue.parse(F.col("_o.offset_key")).alias("_key"), jsonvalue.parse(F.col("_o.offset_val")).alias("_value"),
        F.col("_o.offset_key").alias("_key_text"), F.col("_o.offset_val").alias("_value_text"))
    key, value = F.col("_key"), F.col("_value")
    fields = read.select(
        "*",
        F.to_json(value).alias("_json"),
        F.size(F.try_variant_get(key, "$", "array<variant>")).alias("_key_size"),
        _text(key, "$[0]").alias("_key_name"), _text(key, "$[1].server").alias("_key_server"), _text(key, "$[1].database").alias("_key_database"),
        _text(value, "$.snapshot").alias("_snapshot"),
        jsonvalue.token(value, "$.snapshot_completed").alias("_completed_token"),
        jsonvalue.token(value, "$.change_lsn").alias("_change_token"), _text(value, "$.change_lsn").alias("_change"),
        jsonvalue.is_integral(jsonvalue.at(value, "$.event_serial_no")).alias("_serial_ok"),
        F.try_variant_get(value, "$.event_serial_no", "bigint").alias("_serial"),
        _text(value, "$.commit_lsn").alias("_commit"))
    completed = F.col("_snapshot").isNotNull() & _is_true(F.col("_completed_token"))
    unset_change = (F.col("_change_token") == "null") | (F.col("_change") == lsn.NO_CHANGE_POSITION)
    initial_boundary = (F.col("_change_token") == '"NULL"') & (F.col("_serial") == 1)
    unreadable = F.col("_value_text").isNull() | F.col("_key_text").isNull() | jsonvalue.malformed(F.col("_value_text"), value) | jsonvalue.malformed(F.col("_key_text"), key)

    def no(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    code = (
        F.when(F.col("_active").isNull() & (F.col("_rows") > 0), "ACTIVATION_MISSING_FOR_EXISTING_OFFSETS")
        .when(F.col("_active").isNull(), F.lit(None))
        .when(no(F.col("_owner") == F.col("tenant_id")) | no(F.col("_stored_hash") == F.col("_hash")), "SOURCE_CONFIGURATION_CHANGED")
        .when(F.col("_rows") != 1, MISSING_OR_AMBIGUOUS)
        .when(unreadable | no(F.startswith("_json", F.lit("{"))), CORRUPT)
        .when(no(F.col("_key_size") == 2) | no(F.col("_key_name") == F.col("connector")) | no(F.col("_key_server") == F.col("connector"))
              | no(F.col("_key_database") == F.col("database")), PARTITION_CHANGED)
        .when(F.col("_snapshot").isNotNull() & (F.col("_snapshot") != "false") & ~_is_true(F.col("_completed_token")), INCOMPLETE)
        .when(F.col("_change_token").isNull() | ~F.col("_serial_ok") | no(F.col("_serial") >= 0), COORDINATES)
        .when(unset_change & ~completed & ~initial_boundary, COORDINATES)
        .when(~unset_change & ~lsn.valid_lsn(F.col("_change")), INVALID_POSITION)
        .when(completed & (F.col("_commit").isNull() | (F.col("_commit") == lsn.NO_CHANGE_POSITION)), INCOMPLETE)
        .when(~lsn.valid_lsn(F.col("_commit")), INVALID_POSITION))
    return fields.select(*SOURCE, code.alias("error_code"), F.when(F.col("_active").isNotNull(), F.col("_commit")).alias("_commit")).select(
        *SOURCE, F.when(F.col("error_code").isNull(), F.col("_commit")).alias("saved_commit"), "error_code")


def offset_advanced(frame: DataFrame, before: str = "before_val", after: str = "after_val") -> DataFrame:
    """Add ``advanced``: the full position moved strictly forward. Anything unreadable is no progress."""
    read = frame.withColumn("_b", jsonvalue.parse(F.col(before))).withColumn("_a", jsonvalue.parse(F.col(after)))
    b, a = F.col("_b"), F.col("_a")
    commit_b, commit_a = lsn.lsn_bytes(_text(b, "$.commit_lsn")), lsn.lsn_bytes(_text(a, "$.commit_lsn"))
    change_b, change_a = _text(b, "$.change_lsn"), _text(a, "$.change_lsn")
    serial_b, serial_a = (F.coalesce(F.try_variant_get(v, "$.event_serial_no", "bigint"), F.lit(0)) for v in (b, a))
    moved = (
        F.when(commit_a != commit_b, commit_a > commit_b)
        .when(commit_a.isNull() | commit_b.isNull(), False)
        .when(change_b == lsn.NO_CHANGE_POSITION, F.coalesce(change_a, F.lit("")) != lsn.NO_CHANGE_POSITION)
        .when(change_a == lsn.NO_CHANGE_POSITION, False)
        .otherwise((lsn.lsn_bytes(change_a) > lsn.lsn_bytes(change_b))
                   | ((lsn.lsn_bytes(change_a) == lsn.lsn_bytes(change_b)) & (serial_a > serial_b))))
    started = F.when(F.col(before).isNull(), F.col(after).isNotNull())
    return read.withColumn("advanced", F.coalesce(started, moved, F.lit(False))).drop("_b", "_a")


def rewrite_position(offsets: DataFrame, commit: Column, change: Column, serial: Column) -> DataFrame:
    """Add ``replay_val``, the offset moved back to a target with all its other fields, or ``error_code``."""
    value = jsonvalue.parse(F.col("offset_val"))
    read = offsets.select(
        "*", value.alias("_v"), commit.alias("_to_commit"), change.alias("_to_change"), serial.cast("bigint").alias("_to_serial"))
    v = F.col("_v")
    fields = read.select("*", jsonvalue.object_at(v, "$").alias("_fields"), _text(v, "$.commit_lsn").alias("_commit"), _text(v, "$.change_lsn").alias("_change"),
                         jsonvalue.is_integral(jsonvalue.at(v, "$.event_serial_no")).alias("_serial_ok"), F.try_variant_get(v, "$.event_serial_no", "bigint").alias("_serial"))
    here = lsn.position(F.col("_commit"), F.col("_change"), F.col("_serial"))
    there = lsn.position(F.col("_to_commit"), F.col("_to_change"), F.col("_to_serial"))
    code = (
        F.when(F.col("_fields").isNull(), "INVALID_OFFSET_JSON")
        .when(F.map_contains_key("_fields", "snapshot") | F.map_contains_key("_fields", "snapshot_completed"), "SNAPSHOT_OFFSET_NOT_SUPPORTED")
        .when(~lsn.valid_lsn(F.col("_commit")) | ~lsn.valid_lsn(F.col("_change")), INVALID_POSITION)
        .when(~F.col("_serial_ok") | ~F.coalesce(F.col("_serial") >= 0, F.lit(False)), "INVALID_OFFSET_SERIAL")
        .when(here < there, "CHECKPOINT_BEFORE_REPLAY_BOUNDARY"))
    others = F.map_filter("_fields", lambda k, _: ~k.isin("commit_lsn", "change_lsn", "event_serial_no"))
    target = F.create_map(F.lit("commit_lsn"), F.col("_to_commit").cast("variant"), F.lit("change_lsn"), F.col("_to_change").cast("variant"),
                          F.lit("event_serial_no"), F.col("_to_serial").cast("variant"))
    return fields.withColumn("error_code", code).withColumn(
        "replay_val", F.when(F.col("error_code").isNull(), F.to_json(F.map_concat(others, target)))).select(*offsets.columns, "replay_val", "error_code")


def boundary_evidence(change_rows: DataFrame, boundary: DataFrame) -> DataFrame:
    """Whether a source's replay boundary rests on exactly one heartbeat update and nothing else.

    ``change_rows`` has a ``role`` per row: ``heartbeat``, ``new`` (tables being added) or ``business``.
    """
    limits = boundary.select(*SOURCE, lsn.lsn_bytes(F.col("commit_lsn")).alias("_commit"), lsn.lsn_bytes(F.col("change_lsn")).alias("_change"))
    at = F.col("start_lsn") == F.col("_commit")
    beat = (F.col("role") == "heartbeat") & at
    proper = beat & (F.col("singleton_id") == 1) & (F.col("seqval") == F.col("_change"))
    counted = change_rows.join(limits, SOURCE).groupBy(*SOURCE).agg(
        F.count_if(beat).alias("_beats"),
        F.count_if(proper & (F.col("operation") == 3)).alias("_before"),
        F.count_if(proper & (F.col("operation") == 4)).alias("_after"),
        F.count_if((F.col("role") == "new") & (F.col("start_lsn") <= F.col("_commit"))).alias("_new"),
        F.count_if((F.col("role") == "business") & at).alias("_business"))
    zero = F.lit(0)
    code = (
        F.when(F.coalesce("_beats", zero) > 2, "AMBIGUOUS_HEARTBEAT_BOUNDARY")
        .when(F.coalesce("_beats", zero) != 2, "HEARTBEAT_BOUNDARY_MISSING")
        .when((F.col("_before") != 1) | (F.col("_after") != 1), "INVALID_HEARTBEAT_BOUNDARY")
        .when(F.col("_new") > 0, "NEW_TABLE_CHANGES_BEFORE_REPLAY_BOUNDARY")
        .when(F.col("_business") > 0, "BUSINESS_CHANGE_AT_HEARTBEAT_BOUNDARY"))
    return boundary.select(*SOURCE).join(counted, SOURCE, "left").select(*SOURCE, code.alias("error_code"))
