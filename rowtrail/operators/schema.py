"""Source-table schemas: catalog inventory, reader schema history, differences and refresh planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtrail.functions import identity, jsonvalue, lsn, names
from rowtrail.operators.positions import SOURCE
from rowtrail.operators.registry import TABLE_KEY, _updated, registry_acknowledge

# Limits and states of schema evolution.
RETIRE_GRACE_SECONDS = 120
MAX_NAME_CHARS = 84
NAME_HASH_CHARS = 12
LENGTH_TYPES = ("char", "varchar", "nchar", "nvarchar", "binary", "varbinary")
SCALE_TYPES = ("decimal", "numeric")
PERMISSION_CODES = (22902, 229, 297, 15247, 916)
CURRENT, SOURCE_CHANGED, READER_STALE = "CURRENT", "SOURCE_CHANGED", "READER_STALE"
REFRESHING, REFRESH_FAILED = "REFRESHING", "REFRESH_FAILED"

COLUMN_TYPE = "struct<name:string,type:string,length:int,precision:int,scale:int,nullable:boolean>"


def type_signature(data_type: Column, length: Column, precision: Column, scale: Column) -> Column:
    """Type text that matters for decoding; a length of zero or less, or beyond 8000, reads ``max``."""
    size = F.when((length <= 0) | (length > 8000), "max").otherwise(length.cast("string"))
    return (
        F.when(data_type.isin(*LENGTH_TYPES), F.concat(data_type, F.lit("("), size, F.lit(")")))
        .when(data_type.isin(*SCALE_TYPES), F.concat(data_type, F.lit("("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")))
        .otherwise(data_type))


def column_diff(before_cols: DataFrame, after_cols: DataFrame, keys: list[str] | None = None, shown: int | None = None) -> DataFrame:
    """Differences per table: ADDED and CHANGED in the new order, then REMOVED; for display, only the first ``shown``.

    Both sides hold ``ordinal, name, type, length, precision, scale`` per table and match by name ignoring case.
    """
    keys = keys or TABLE_KEY
    signature = type_signature(F.col("type"), F.col("length"), F.col("precision"), F.col("scale"))

    def side(columns: DataFrame, prefix: str) -> DataFrame:
        return columns.select(
            *keys, F.lower("name").alias("_match"), F.col("name").alias(f"_{prefix}_name"),
            F.col("ordinal").alias(f"_{prefix}_ordinal"), signature.alias(f"_{prefix}_type"))

    joined = side(before_cols, "old").join(side(after_cols, "new"), [*keys, "_match"], "full_outer")
    kind = F.when(F.col("_old_name").isNull(), "ADDED").when(F.col("_new_name").isNull(), "REMOVED").when(F.col("_old_type") != F.col("_new_type"), "CHANGED")
    changes = joined.select(
        *keys, F.coalesce("_new_name", "_old_name").alias("column_name"), kind.alias("kind"),
        F.col("_old_type").alias("before_type"), F.col("_new_type").alias("after_type"),
        F.col("_new_name").isNull().alias("_removed"), F.coalesce("_new_ordinal", "_old_ordinal").alias("_ordinal")).filter("kind IS NOT NULL")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_removed", "_ordinal"))
    placed = changes.withColumn("position", place).drop("_removed", "_ordinal")
    return placed if shown is None else placed.filter(F.col("position") <= shown)


def captured_key_coverage(pk_columns: DataFrame, captured_columns: DataFrame) -> DataFrame:
    """Per capture object: has its source table a primary key, and is every key column captured?

    ``pk_columns`` names the ``capture_object_id`` whose coverage is asked, ``captured_columns`` lists its columns.
    """
    keys = [*SOURCE, "capture_object_id"]
    listed = captured_columns.select(*keys, "column_name").distinct().withColumn("_captured", F.lit(True))
    return pk_columns.join(listed, [*keys, "column_name"], "left").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("key_columns"), F.count_if(F.col("_captured").isNull()).alias("uncaptured"),
    ).withColumn("keyed", (F.col("key_columns") > 0) & (F.col("uncaptured") == 0))


def _shape_text(*parts: str) -> Column:
    return F.concat(*[F.concat(F.coalesce(F.col(p).cast("string"), F.lit("null")), F.lit("|")) for p in parts])


def column_shape(columns: DataFrame) -> DataFrame:
    """One text per object describing its columns in order."""
    row = _shape_text("column_id", "name", "system_type_id", "user_type_id", "max_length", "precision", "scale", "is_nullable")
    return columns.select(*SOURCE, "object_id", "column_id", row.alias("_row")).groupBy(*SOURCE, "object_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("column_id", "_row"))), lambda c: c["_row"]), "").alias("column_shape"))


def key_shape(pk_columns: DataFrame) -> DataFrame:
    """One text per object listing its primary-key columns in key order."""
    row = F.concat(F.col("key_ordinal").cast("string"), F.lit(":"), F.col("column_name"), F.lit("|"))
    return pk_columns.select(*SOURCE, "object_id", "key_ordinal", row.alias("_row")).groupBy(*SOURCE, "object_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key_ordinal", "_row"))), lambda c: c["_row"]), "").alias("key_shape"))


def capture_fingerprint(captures: DataFrame, column_shapes: DataFrame, key_shapes: DataFrame) -> DataFrame:
    """Hash per source table over the sorted descriptions of its capture instances."""
    source_shape = column_shapes.select(*SOURCE, F.col("object_id").alias("source_object_id"), F.col("column_shape").alias("_source_shape"))
    capture_shape = column_shapes.select(*SOURCE, F.col("object_id").alias("capture_object_id"), F.col("column_shape").alias("_capture_shape"))
    keys = key_shapes.select(*SOURCE, F.col("object_id").alias("source_object_id"), "key_shape")
    described = (
        captures.join(source_shape, [*SOURCE, "source_object_id"], "left").join(capture_shape, [*SOURCE, "capture_object_id"], "left")
        .join(keys, [*SOURCE, "source_object_id"], "left"))
    empty = F.lit("")
    line = F.concat_ws(
        "|", F.col("source_object_id").cast("string"), F.col("capture_object_id").cast("string"), F.col("capture_name"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.coalesce("_source_shape", empty), F.coalesce("_capture_shape", empty), F.coalesce("key_shape", empty))
    return described.groupBy(*SOURCE, "source_object_id").agg(
        identity.sha256(F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("fingerprint"))


def capturable_tables(inventory: DataFrame, service_marker: str = names.SERVICE_MARKER) -> DataFrame:
    """Tables of the catalog that may be captured, with whether their name is a plain identifier; those named with the service's marker are its own."""
    name = names.qualified(F.col("schema_name"), F.col("table_name"))
    return inventory.filter(~F.col("is_shipped") & ~names.service_owned(F.col("table_name"), service_marker) & (F.lower("schema_name") != "cdc")).withColumn(
        "supported", name.rlike(names.QUALIFIED_IDENTIFIER))


def character_length(data_type: Column, bytes_length: Column) -> Column:
    """Catalog byte length in characters for two-byte text types."""
    return F.when((bytes_length > 0) & data_type.isin("nvarchar", "nchar"), F.floor(bytes_length / 2).cast("int")).otherwise(bytes_length.cast("int"))


def capture_inventory(tables: DataFrame, captures: DataFrame, columns: DataFrame, pk_columns: DataFrame, captured_columns: DataFrame) -> DataFrame:
    """Catalog rows as one observation per capturable table.

    Groups are bounded by the catalog: a table has a handful of capture instances and a limited number of
    columns. Captures are in order of creation, then name.
    """
    eligible_tables = capturable_tables(tables).select(*SOURCE, F.col("object_id").alias("source_object_id"), "schema_name", "table_name", "supported")
    keys = captures.select(*SOURCE, "capture_object_id", "source_object_id").join(
        pk_columns.withColumnRenamed("object_id", "source_object_id"), [*SOURCE, "source_object_id"])
    keyed = captured_key_coverage(keys, captured_columns).select(*SOURCE, "capture_object_id", "keyed")
    column = F.struct(
        F.col("name"), F.lower("type").alias("type"), character_length(F.lower("type"), F.col("max_length")).alias("length"),
        F.col("precision"), F.col("scale"), F.col("is_nullable").alias("nullable"))
    plain = columns.filter(~F.col("is_computed") & ~F.startswith(F.col("name"), F.lit("__$")))
    lists = plain.select(*SOURCE, "object_id", "column_id", column.alias("_column")).groupBy(*SOURCE, "object_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("column_id", "_column"))), lambda c: c["_column"]).alias("_columns"))
    prints = capture_fingerprint(captures, column_shape(columns), key_shape(pk_columns))
    capture = F.struct(
        "created_at", F.col("capture_name").alias("name"), "start_lsn", F.coalesce("keyed", F.lit(False)).alias("keyed"),
        lsn.ready_lsn(F.col("start_lsn")).alias("ready"), F.coalesce("_columns", F.array().cast(f"array<{COLUMN_TYPE}>")).alias("columns"))
    grouped = (
        captures.join(keyed, [*SOURCE, "capture_object_id"], "left")
        .join(lists.withColumnRenamed("object_id", "capture_object_id"), [*SOURCE, "capture_object_id"], "left")
        .select(*SOURCE, "source_object_id", capture.alias("c"))
        .groupBy(*SOURCE, "source_object_id").agg(F.sort_array(F.collect_list("c")).alias("captures")))
    observed = (
        eligible_tables.join(grouped, [*SOURCE, "source_object_id"]).join(prints, [*SOURCE, "source_object_id"], "left")
        .join(lists.select(*SOURCE, F.col("object_id").alias("source_object_id"), F.col("_columns").alias("source_columns")), [*SOURCE, "source_object_id"], "left"))
    ready = F.exists("captures", lambda c: c["ready"])
    all_keyed = F.forall(F.filter("captures", lambda c: c["ready"]), lambda c: c["keyed"]) & F.exists("captures", lambda c: c["keyed"])
    return observed.select(
        *TABLE_KEY, "fingerprint", (F.col("supported") & ready & all_keyed).alias("eligible"),
        F.when(~F.col("supported"), "TABLE_IDENTIFIER_UNSUPPORTED").when(~all_keyed, "CAPTURED_PRIMARY_KEY_REQUIRED").when(~ready, "CDC_CAPTURE_INITIALIZING").alias("diagnostic"),
        F.transform(F.filter("captures", lambda c: c["ready"]), lambda c: c["start_lsn"]).alias("minimums"),
        F.array_join(F.transform("captures", lambda c: c["name"]), ",").alias("instances"),
        "captures", F.coalesce("source_columns", F.array().cast(f"array<{COLUMN_TYPE}>")).alias("source_columns"))


def schema_history_records(chunks: DataFrame) -> DataFrame:
    """Whole schema-history records from their stored parts, with the sequence each began at.

    Parts without an id are records of their own, so they never share a group.
    """
    record = F.coalesce("id", F.concat(F.lit("#"), F.col("storage_sequence").cast("string")))
    return chunks.select(*SOURCE, record.alias("record_id"), "storage_sequence", F.struct("history_data_seq", "storage_sequence", F.coalesce("history_data", F.lit("")).alias("data")).alias("p")).groupBy(
        *SOURCE, "record_id").agg(
        F.min("storage_sequence").alias("first_sequence"),
        F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["data"]), "").alias("record"))


_CHANGE_TYPE = "array<struct<type string, id string, table struct<columns array<struct<name string, typeName string, length int, scale int, optional boolean>>>>>"


def reader_schemas(records: DataFrame, sources: DataFrame) -> DataFrame:
    """Latest column list per table as the reader last recorded it; a later DROP removes the table.

    Records that do not parse and changes of other databases are ignored.
    """
    read = records.select(*SOURCE, "first_sequence", F.try_variant_get(jsonvalue.parse(F.col("record")), "$.tableChanges", _CHANGE_TYPE).alias("_changes"))
    change = read.select(*SOURCE, "first_sequence", F.posexplode("_changes").alias("_pos", "_change"))
    parts = F.split("_change.id", r"\.")
    plain = F.transform(parts, lambda p: F.regexp_replace(p, '^"|"$', ""))
    named = change.withColumn("_id", F.when(F.size(parts) == 3, plain)).join(sources.select(*SOURCE, "database"), SOURCE).filter(
        F.lower(F.col("_id")[0]) == F.lower("database"))
    latest = named.groupBy(*SOURCE, F.col("_id")[1].alias("schema_name"), F.col("_id")[2].alias("table_name")).agg(
        F.max_by(F.struct("_change.type", F.col("_change.table.columns").alias("columns")), F.struct("first_sequence", "_pos")).alias("c"))
    kept = latest.filter(F.coalesce("c.type", F.lit("")) != "DROP")

    def column(c: Column) -> Column:
        data_type = F.trim(F.replace(F.lower(F.coalesce(c["typeName"], F.lit(""))), F.lit(" identity"), F.lit("")))
        size = F.coalesce(c["length"], F.lit(0))
        return F.struct(c["name"].alias("name"), data_type.alias("type"), size.alias("length"), size.alias("precision"),
                        F.coalesce(c["scale"], F.lit(0)).alias("scale"), F.coalesce(c["optional"], F.lit(True)).alias("nullable"))

    return kept.select(*TABLE_KEY, F.coalesce(F.transform("c.columns", column), F.array().cast(f"array<{COLUMN_TYPE}>")).alias("reader_columns"))


def explode_columns(tables: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """Column lists as rows for :func:`column_diff`."""
    keys = keys or TABLE_KEY
    return tables.select(*keys, F.posexplode(column).alias("ordinal", "_c")).select(*keys, "ordinal", "_c.*")


def _change_lists(diff: DataFrame, name: str) -> DataFrame:
    entry = F.struct(F.col("position"), F.col("column_name").alias("column"), "kind", F.col("before_type").alias("before"), F.col("after_type").alias("after"))
    listed = F.transform(F.sort_array(F.collect_list(entry)), lambda c: F.struct(c["column"].alias("column"), c["kind"].alias("kind"), c["before"].alias("before"), c["after"].alias("after")))
    return diff.groupBy(*TABLE_KEY).agg(listed.alias(name))


def schema_assess(observations: DataFrame, reader: DataFrame) -> DataFrame:
    """State per observed table with its source and reader differences.

    The newest capture is compared with the source table and with the reader's columns; while two captures
    coexist a replacement is under way and nothing is compared.
    """
    single = observations.filter(F.size("captures") == 1).select(*TABLE_KEY, F.get("captures", F.lit(0))["columns"].alias("_captured"), "source_columns")
    captured = explode_columns(single, "_captured")
    with_source = single.filter(F.size("source_columns") > 0).select(*TABLE_KEY)
    source_diff = column_diff(captured.join(with_source, TABLE_KEY, "left_semi"), explode_columns(single, "source_columns"))
    with_reader = single.join(reader.select(*TABLE_KEY, "reader_columns"), TABLE_KEY)
    reader_diff = column_diff(explode_columns(with_reader, "reader_columns"), captured.join(with_reader.select(*TABLE_KEY), TABLE_KEY, "left_semi"))
    joined = observations.join(_change_lists(source_diff, "source_changes"), TABLE_KEY, "left").join(_change_lists(reader_diff, "reader_changes"), TABLE_KEY, "left")
    state = (
        F.when(F.size("captures") == 0, CURRENT).when(F.size("captures") > 1, REFRESHING)
        .when(F.col("reader_changes").isNotNull(), READER_STALE).when(F.col("source_changes").isNotNull(), SOURCE_CHANGED).otherwise(CURRENT))
    return joined.withColumn("assessed_state", state)


def schema_detail(source_changes: Column, reader_changes: Column, shown: int | None = None) -> Column:
    """JSON of both difference lists, null when there are none. It is whole, as plans compare it with earlier ones;
    for display, ``shown`` entries a side are enough, marked as truncated where that leaves any out.
    """
    empty = F.array().cast("array<struct<column:string,kind:string,before:string,after:string>>")
    source, reader = F.coalesce(source_changes, empty), F.coalesce(reader_changes, empty)
    options = {"ignoreNullFields": "false"}
    detail = F.to_json(F.struct(source.alias("source"), reader.alias("reader")), options)
    if shown is not None:
        short = F.struct(F.slice(source, 1, shown).alias("source"), F.slice(reader, 1, shown).alias("reader"), F.lit(True).alias("truncated"))
        detail = F.when((F.size(source) > shown) | (F.size(reader) > shown), F.to_json(short, options)).otherwise(detail)
    return F.when((F.size(source) > 0) | (F.size(reader) > 0), detail)


def capture_instance_name(schema: Column, table: Column, current: Column, now) -> Column:
    """Name of a replacement capture; one that would repeat the current name gets a suffix.

    A table name beyond the identifier's length is cut and ends in a hash of the whole, so no two tables share one.
    """
    full = F.concat(schema, F.lit("_"), table)
    short = F.concat(F.substring(full, 1, MAX_NAME_CHARS - NAME_HASH_CHARS - 1), F.lit("_"), F.substring(identity.sha256(full), 1, NAME_HASH_CHARS))
    base = F.when(F.length(full) > MAX_NAME_CHARS, short).otherwise(full)
    name = F.concat(base, F.lit("_"), F.date_format(F.lit(now), "yyyyMMddHHmmss"))
    return F.when(F.lower(name) == F.lower(current), F.concat(name, F.lit("b"))).otherwise(name)


def schema_plan(assessed: DataFrame, registry: DataFrame, positions: DataFrame, automatic: bool, now) -> DataFrame:
    """Next step per observed registry table: CREATE a replacement capture, RETIRE the oldest, or none.

    Only capturing tables (active, and active or onboarding by state) are planned for; a difference that an
    earlier attempt already addressed is left alone unless requested.
    """
    rows = registry.select(*TABLE_KEY, "active", "state", "refresh_requested_at", "refresh_detail", "refresh_started_at")
    joined = assessed.join(rows, TABLE_KEY).join(positions.select(*SOURCE, "saved_commit"), SOURCE, "left")
    detailed = joined.withColumn("detail", schema_detail(F.col("source_changes"), F.col("reader_changes"))).withColumn(
        "capturing", F.col("active") & F.col("state").isin("ACTIVE", "ONBOARDING"))
    first, newest = F.get("captures", F.lit(0)), F.try_element_at("captures", F.lit(-1))
    passed = F.coalesce(lsn.ready_lsn(newest["start_lsn"]) & (lsn.lsn_bytes(F.col("saved_commit")) > newest["start_lsn"]), F.lit(False))
    settled = F.col("refresh_started_at").isNull() | (F.timestamp_diff("SECOND", F.col("refresh_started_at"), F.lit(now)) >= RETIRE_GRACE_SECONDS)
    needs = F.col("assessed_state").isin(SOURCE_CHANGED, READER_STALE)
    due = F.col("refresh_requested_at").isNotNull() | (F.lit(automatic) & needs & ~F.col("detail").eqNullSafe(F.col("refresh_detail")))
    one_ready = (F.size("captures") == 1) & first["ready"]
    action = (
        F.when(~F.col("capturing"), F.lit(None))
        .when(F.size("captures") > 1, F.when(passed & settled, "RETIRE"))
        .when(one_ready & due, "CREATE"))
    planned = detailed.withColumn("action", action)
    return planned.withColumn(
        "action_instance",
        F.when(F.col("action") == "RETIRE", first["name"])
        .when(F.col("action") == "CREATE", capture_instance_name(F.col("schema_name"), F.col("table_name"), first["name"], now))
    ).select(*TABLE_KEY, "assessed_state", "detail", "capturing", "action", "action_instance")


def schema_registry_update(registry: DataFrame, planned: DataFrame, now) -> DataFrame:
    """Registry after planning: assessments recorded, started refreshes marked before they run."""
    plan = planned.select(*TABLE_KEY, "assessed_state", "detail", "capturing", (F.col("action") == "CREATE").alias("_creates"))
    joined = registry_acknowledge(registry).join(plan, TABLE_KEY, "left")
    found, capturing, assessed = F.col("assessed_state").isNotNull(), F.col("capturing"), F.col("assessed_state")
    creates = F.coalesce("_creates", F.lit(False))
    failed = F.col("refresh_error").isNotNull() & (assessed != CURRENT)
    return _updated(joined, found, {
        "schema_detail": F.col("detail"),
        "schema_state": F.when(~capturing, assessed).when(creates, REFRESHING).when(failed, REFRESH_FAILED).otherwise(assessed),
        "refresh_requested_at": F.when(capturing & ~creates & (assessed != REFRESHING), F.col("refresh_requested_at")),
        "refresh_started_at": F.when(capturing & creates, F.lit(now)).otherwise(F.col("refresh_started_at")),
        "refresh_detail": F.when(capturing & creates, F.col("detail")).otherwise(F.col("refresh_detail")),
        "refresh_error": F.when(capturing & creates, F.lit(None)).otherwise(F.col("refresh_error"))})


def schema_action_result(registry: DataFrame, results: DataFrame, now) -> DataFrame:
    """Registry after the planned steps ran; ``results`` has ``action`` and ``sql_code`` (null on success)."""
    joined = registry.join(results.select(*TABLE_KEY, F.col("action").alias("_action"), F.col("sql_code").alias("_code")), TABLE_KEY, "left")
    failed = F.col("_code").isNotNull()
    error = F.when(F.col("_code").isin(*PERMISSION_CODES), "CDC_MANAGEMENT_PERMISSION_REQUIRED").otherwise(
        F.concat(F.lit("CAPTURE_REFRESH_SQLCODE_"), F.col("_code").cast("string")))
    return _updated(joined, F.col("_action").isNotNull(), {
        "refreshed_at": F.when(~failed & (F.col("_action") == "RETIRE"), F.lit(now)).otherwise(F.col("refreshed_at")),
        "refresh_error": F.when(failed, error),
        "schema_state": F.when(failed, REFRESH_FAILED).otherwise(F.col("schema_state"))})


def storage_contract(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Where stored tables differ from what the engine needs.

    ``expected`` has ``table_name, column_name, type_name, is_nullable`` and ``actual`` the same per store
    (``tenant_id, source_id``); a missing table misses all its columns.
    """
    stores = actual.select(*SOURCE).distinct()
    # The contract is one value, a list of columns, so attaching it to every store is an explode, not a join of tables.
    listed = expected.agg(F.collect_list(F.struct("table_name", "column_name", F.col("type_name").alias("_type"), F.col("is_nullable").alias("_nullable")))).scalar()
    needed = stores.withColumn("_contract", listed).select(*SOURCE, F.inline("_contract"))
    have = actual.select(*SOURCE, "table_name", "column_name", F.col("type_name").alias("actual_type"), F.col("is_nullable").alias("actual_nullable"))
    violation = (
        F.when(F.col("actual_type").isNull(), "COLUMN_MISSING").when(F.col("actual_type") != F.col("_type"), "TYPE_DIFFERS")
        .when(F.col("actual_nullable") != F.col("_nullable"), "NULLABILITY_DIFFERS"))
    return needed.join(have, [*SOURCE, "table_name", "column_name"], "left").select(
        *SOURCE, "table_name", "column_name", F.col("_type").alias("expected_type"), "actual_type", violation.alias("violation")).filter("violation IS NOT NULL")
