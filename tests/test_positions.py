"""Saved positions, progress and registry transitions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowtrail.functions import lsn
from rowtrail.operators import monitor, positions, registry, schema, settings

SAVED = "00000027:00000ac0:0003"
MIN = "00000027:00000a00:0001"
FUTURE = "00000028:00000000:0001"
ACTIVATION = "00000027:00000af0:0003"
NOW = dt.datetime(2026, 10, 11, 12, 0, 0)
KEY = '["capture-A-hr",{"server":"capture-A-hr","database":"people"}]'
GOOD = '{"commit_lsn":"00000027:00000ac0:0003","change_lsn":"00000027:00000ab8:0002","event_serial_no":1}'


def sources(spark, tables=("dbo.One", "dbo.Two")):
    return spark.createDataFrame([("A", "hr", "localhost", 1433, "people", list(tables), "inc", None)], settings.SOURCE_SCHEMA)


def hash_of(spark, tables):
    return settings.configuration_hash(sources(spark, tables)).first().configuration_hash


def activation(spark, tables=("dbo.One", "dbo.Two"), fence=5):
    return spark.createDataFrame([("hr", "A", "inc", hash_of(spark, tables), NOW, fence, True)],
                                 "source_id string, tenant_id string, incarnation string, configuration_hash string, created_at timestamp, fence bigint, table_registry_initialized boolean")


def saved(spark, value, key=KEY):
    offsets = spark.createDataFrame([("A", "hr", "o", key, value)], "tenant_id string, source_id string, id string, offset_key string, offset_val string")
    row = positions.saved_position(activation(spark), offsets, sources(spark)).first()
    return row.error_code or row.saved_commit


@pytest.mark.parametrize("value, expected", [
    (GOOD, SAVED),
    ("{}", "SOURCE_REPLAY_COORDINATES_INVALID"),
    ('{"snapshot":"INITIAL","snapshot_completed":false}', "SOURCE_INITIALIZATION_INCOMPLETE"),
    (GOOD.replace('no":1', 'no":-1'), "SOURCE_REPLAY_COORDINATES_INVALID"),
    (GOOD.replace('"00000027:00000ab8:0002"', "null"), "SOURCE_REPLAY_COORDINATES_INVALID"),
    (GOOD.replace('"00000027:00000ab8:0002"', "null").replace("{", '{"snapshot":"INITIAL","snapshot_completed":true,'), SAVED),
    (GOOD.replace("00000027:00000ab8:0002", "NULL"), SAVED),
    (GOOD.replace("00000027:00000ab8:0002", "NULL").replace('no":1', 'no":2'), "SOURCE_REPLAY_COORDINATES_INVALID"),
    ('{"commit_lsn":"NULL","change_lsn":"NULL","event_serial_no":1}', "INVALID_SOURCE_POSITION"),
    ("not json", "SOURCE_OFFSETS_CORRUPT"), ("[]", "SOURCE_OFFSETS_CORRUPT"), (None, "SOURCE_OFFSETS_CORRUPT"),
])
def test_saved_position(spark, value, expected):
    assert saved(spark, value) == expected


def test_saved_position_of_another_database(spark):
    assert saved(spark, '{"snapshot":"INITIAL"}', KEY.replace("people", "another")) == "SOURCE_OFFSET_PARTITION_CHANGED"


@pytest.mark.parametrize("before, after, expected", [
    (GOOD, GOOD, False), (GOOD, GOOD.replace('no":1', 'no":2'), True), (GOOD, GOOD.replace("0:0003", "0:0002"), False),
    (GOOD, GOOD.replace("0:0003", "0:0004"), True), (None, GOOD, True), (GOOD, None, False), (GOOD, "broken", False),
])
def test_offset_advanced(spark, before, after, expected):
    frame = spark.createDataFrame([(before, after)], "before_val string, after_val string")
    assert positions.offset_advanced(frame).first().advanced is expected


@pytest.mark.parametrize("low, end, covered", [(MIN, "00000027:00000b00:0001", True), ("00000027:00000b00:0001", None, False), (MIN, MIN, False)])
def test_coverage_during_a_capture_rollover(spark, low, end, covered):
    table = spark.createDataFrame([("A", "hr", "dbo.One")], "tenant_id string, source_id string, table_name string")
    captures = table.withColumn("minimum", lsn.lsn_bytes(F.lit(low))).withColumn("end", lsn.lsn_bytes(F.lit(end).cast("string")))
    at = spark.createDataFrame([("A", "hr", SAVED)], "tenant_id string, source_id string, saved_commit string").withColumn("maximum", lsn.lsn_bytes(F.lit(FUTURE)))
    assert positions.position_coverage(table, captures, at).first().covered is covered


def observed(spark, **minimums):
    rows = [("A", "hr", "dbo", name, f"fp-{name}", True, None, [minimum], name) for name, minimum in minimums.items()]
    frame = spark.createDataFrame(rows, "tenant_id string, source_id string, schema_name string, table_name string, fingerprint string, eligible boolean, diagnostic string, texts array<string>, instances string")
    return frame.withColumn("minimums", F.transform("texts", lsn.lsn_bytes)).drop("texts")


def at(spark, commit=SAVED):
    return spark.createDataFrame([("A", "hr", commit)], "tenant_id string, source_id string, saved_commit string")


def empty(spark):
    return spark.createDataFrame([], registry.REGISTRY_SCHEMA)


def start(spark, tables=("dbo.One", "dbo.Two"), **minimums):
    minimums = minimums or {"One": MIN, "Two": MIN}
    none = activation(spark).filter("false")
    return registry.registry_initialize(sources(spark, tables), observed(spark, **minimums), empty(spark), none, NOW)[0]


def rows(frame):
    return {r.table_name: r for r in frame.collect()}


def test_lost_registry_is_not_bootstrapped_again(spark):
    created, outcome = registry.registry_initialize(sources(spark), observed(spark, One=MIN), empty(spark), activation(spark), NOW)
    assert created.count() == 0 and outcome.first().error_code == "TABLE_REGISTRY_MISSING"


def test_onboarding_becomes_active_only_strictly_after_its_activation(spark):
    reg = start(spark, tables=("dbo.One",))
    reg = registry.registry_observe(reg, observed(spark, One=MIN, Two=MIN), at(spark), NOW)
    assert rows(reg)["Two"].state == "DISCOVERED"
    two = F.col("table_name") == "Two"
    reg = reg.withColumn("desired_enabled", F.col("desired_enabled") | two).withColumn("state", F.when(two, "PENDING").otherwise(F.col("state")))
    ready = registry.ready_requests(reg, observed(spark, One=MIN, Two=MIN), at(spark))
    assert [r.table_name for r in ready.collect()] == ["dbo.Two"]
    assert registry.ready_requests(reg, observed(spark, One=MIN, Two=FUTURE), at(spark)).count() == 0
    offset = spark.createDataFrame([("A", "hr", "o", KEY, GOOD)], "tenant_id string, source_id string, id string, offset_key string, offset_val string")
    boundary = spark.createDataFrame([("A", "hr", ACTIVATION)], "tenant_id string, source_id string, boundary string")
    current = activation(spark, ("dbo.One",))

    def onboard(requested=ready, expected=current, checkpoint=offset):
        return registry.registry_onboard(reg, sources(spark, ("dbo.One",)), current, offset, checkpoint, requested, boundary, expected)

    assert onboard(expected=activation(spark, ("dbo.One",), fence=6))[1].first().error_code == "SOURCE_FENCED"
    assert onboard(checkpoint=offset.withColumn("offset_val", F.lit("changed")))[1].first().error_code == "ONBOARDING_CHECKPOINT_CHANGED"
    more = ready.unionByName(ready.withColumn("table_name", F.lit("dbo.Missing")))
    failed, outcome = onboard(requested=more)
    assert outcome.first().error_code == "ONBOARDING_REQUEST_CHANGED" and not rows(failed)["Two"].active
    done, outcome = onboard()
    assert (outcome.first().error_code, outcome.first().fence) == (None, 6)
    assert outcome.first().configuration_hash == hash_of(spark, ("dbo.One", "dbo.Two"))
    done = registry.registry_starting(done)
    for commit, state in ((SAVED, "ONBOARDING"), (ACTIVATION, "ONBOARDING"), ("00000027:00000af0:0004", "ACTIVE")):
        assert rows(registry.registry_confirm_progress(done, at(spark, commit), NOW))["Two"].state == state


def test_gap_suspends_only_that_table(spark):
    reg = registry.registry_observe(start(spark), observed(spark, One=MIN, Two=FUTURE), at(spark), NOW)
    assert (rows(reg)["Two"].state, rows(reg)["Two"].diagnostic) == ("BLOCKED", "CAPTURE_HISTORY_GAP")
    current = activation(spark)
    stale = registry.registry_suspend(reg, sources(spark), current, activation(spark, fence=6), at(spark), NOW)
    assert stale[1].first().error_code == "SOURCE_FENCED" and rows(stale[0])["Two"].active
    after, outcome = registry.registry_suspend(reg, sources(spark), current, current, at(spark), NOW)
    two = rows(after)["Two"]
    assert (two.active, two.suspension_reason, two.suspended_lsn, two.state) == (False, "CAPTURE_HISTORY_GAP", SAVED, "DISCOVERED")
    assert rows(after)["One"].active and outcome.first().fence == 6
    assert outcome.first().configuration_hash == hash_of(spark, ("dbo.One",))
    assert registry.registry_flags(after).first().unacknowledged_suspension
    asked = after.withColumn("requested_at", F.lit(NOW) + F.expr("interval 1 second"))
    assert not registry.registry_flags(registry.registry_acknowledge(asked)).first().unacknowledged_suspension


def test_the_last_table_cannot_leave(spark):
    reg = start(spark, tables=("dbo.One",)).withColumn("desired_enabled", F.lit(False))
    reg = registry.registry_observe(reg, observed(spark, One=MIN), at(spark), NOW)
    current = activation(spark, ("dbo.One",))
    after, outcome = registry.registry_suspend(reg, sources(spark, ("dbo.One",)), current, current, at(spark), NOW)
    assert outcome.first().error_code == "ALL_CAPTURED_TABLES_UNAVAILABLE" and rows(after)["One"].active


COLUMN = "named_struct('name', '{}', 'type', '{}', 'length', {}, 'precision', 0, 'scale', 0, 'nullable', true)"


def columns(*parts):
    return F.expr("array(" + ", ".join(COLUMN.format(*p) for p in parts) + ")")


WIDE = [("ID", "int", 4), ("Floor", "varchar", 20), ("Apartment", "varchar", 20)]
NARROW = [("ID", "int", 10), ("Floor", "varchar", 10), ("Apartment", "varchar", 5)]


def assessed(spark, captured=WIDE, source=WIDE, reader=NARROW, starts=((MIN, "dbo_Address"),)):
    one = spark.createDataFrame([("A", "hr", "dbo", "Address")], "tenant_id string, source_id string, schema_name string, table_name string")
    captures = F.array(*[F.struct(F.lit(NOW).alias("created_at"), F.lit(n).alias("name"), lsn.lsn_bytes(F.lit(s)).alias("start_lsn"), F.lit(True).alias("ready"), columns(*captured).alias("columns")) for s, n in starts])
    return schema.schema_assess(one.withColumn("captures", captures).withColumn("source_columns", columns(*source)), one.withColumn("reader_columns", columns(*reader)))


def planned(spark, frame, saved_commit=SAVED, requested=None, automatic=True, detail=None, started=None, now=NOW):
    row = {"table_id": "t", "tenant_id": "A", "source_id": "hr", "schema_name": "dbo", "table_name": "Address", "sql_cdc_enabled": True, "desired_enabled": True, "active": True,
           "state": "ACTIVE", "observed_at": NOW, "version": 0, "refresh_requested_at": requested, "refresh_detail": detail, "refresh_started_at": started}
    reg = spark.createDataFrame([tuple(row.get(c) for c in registry.REGISTRY_COLUMNS)], registry.REGISTRY_SCHEMA)
    result = schema.schema_plan(frame, reg, at(spark, saved_commit), automatic, now).first()
    return result


def test_widening_is_refreshed_once(spark):
    frame = assessed(spark)
    row = frame.first()
    assert row.assessed_state == "READER_STALE"
    assert [tuple(c) for c in row.reader_changes] == [("Floor", "CHANGED", "varchar(10)", "varchar(20)"), ("Apartment", "CHANGED", "varchar(5)", "varchar(20)")]
    first = planned(spark, frame)
    assert (first.action, first.action_instance) == ("CREATE", "dbo_Address_20261011120000")
    hour = NOW + dt.timedelta(hours=1)
    assert planned(spark, frame, detail=first.detail, started=NOW, now=hour).action is None
    assert planned(spark, frame, detail=first.detail, started=NOW, requested=NOW).action == "CREATE"
    assert planned(spark, frame, automatic=False).action is None


def test_source_column_added_and_sentinels_ignored(spark):
    added = assessed(spark, captured=WIDE[:2], reader=WIDE[:2]).first()
    assert added.assessed_state == "SOURCE_CHANGED" and [tuple(c) for c in added.source_changes] == [("Apartment", "ADDED", None, "varchar(20)")]
    note = [("ID", "int", 4), ("Note", "nvarchar", -1)]
    assert assessed(spark, captured=note, source=note, reader=[("id", "int", 10), ("Note", "nvarchar", 2147483647)]).first().assessed_state == "CURRENT"


def test_superseded_capture_is_retired_late(spark):
    frame = assessed(spark, starts=((MIN, "dbo_Address"), ("00000027:00000ab0:0001", "dbo_Address_2")))
    assert frame.first().assessed_state == "REFRESHING"
    later = NOW + dt.timedelta(seconds=600)
    assert planned(spark, frame, saved_commit="00000027:00000aa0:0001", started=NOW, now=later).action is None
    assert planned(spark, frame, started=NOW, now=NOW + dt.timedelta(seconds=30)).action is None
    retire = planned(spark, frame, started=NOW, now=later)
    assert (retire.action, retire.action_instance) == ("RETIRE", "dbo_Address")


def test_reader_schema_follows_the_latest_record_of_its_database(spark):
    create = '{"tableChanges":[{"type":"CREATE","id":"\\"people\\".\\"dbo\\".\\"Address\\"","table":{"columns":[{"name":"ID","typeName":"int identity","length":10},{"name":"Floor","typeName":"varchar","length":10}]}}]}'
    alter = create.replace("CREATE", "ALTER").replace('"length":10}]', '"length":20}]')
    texts = [create, "not json", alter, create.replace("people", "another")]
    chunks = spark.createDataFrame([("A", "hr", i, None, 0, t) for i, t in enumerate(texts)],
                                   "tenant_id string, source_id string, storage_sequence bigint, id string, history_data_seq int, history_data string")
    found = schema.reader_schemas(schema.schema_history_records(chunks), sources(spark)).collect()
    assert [(r.schema_name, r.table_name) for r in found] == [("dbo", "Address")]
    assert [(c.name, c.type, c.length) for c in found[0].reader_columns] == [("ID", "int", 10), ("Floor", "varchar", 20)]


def test_all_differences_decide_and_display_is_cut_on_demand(spark):
    many = [(f"Column_with_a_rather_long_name_{i:02d}_" + "x" * 150, "varchar", 20) for i in range(14)]
    row = assessed(spark, captured=WIDE, source=many, reader=WIDE).first()
    assert len([c for c in row.source_changes if c.kind == "ADDED"]) == 14
    frame = assessed(spark, captured=WIDE, source=many, reader=WIDE)
    full, shown = (frame.select(schema.schema_detail(F.col("source_changes"), F.col("reader_changes"), n).alias("d")).first().d for n in (None, 4))
    assert '"truncated":true' in shown and shown.count('"ADDED"') == 4
    assert "truncated" not in full and full.count('"ADDED"') == 14
    # A difference behind the fourteenth is seen, so a refresh made before it came is made again.
    wider = assessed(spark, captured=WIDE, source=[*many, ("Another", "int", 4)], reader=WIDE)
    assert wider.select(schema.schema_detail(F.col("source_changes"), F.col("reader_changes")).alias("d")).first().d != full


def test_unobserved_sources_keep_their_rows(spark):
    reg = start(spark)
    nobody = at(spark).filter("false")
    after = registry.registry_observe(reg, observed(spark, One=MIN).filter("false"), nobody, NOW + dt.timedelta(seconds=60))
    assert sorted(after.collect()) == sorted(reg.collect())
    assert registry.missing_tables(reg, observed(spark, One=MIN).filter("false"), nobody).count() == 0
    assert rows(registry.missing_tables(reg, observed(spark, One=MIN), at(spark))).keys() == {"Two"}


def test_several_requests_for_a_table_leave_one_row(spark):
    reg = start(spark)
    one = rows(reg)["One"].table_id
    asked = spark.createDataFrame([(1, "A", one, "stop", "x"), (2, "A", one, "stop", "y"), (3, "A", one, "enable", "z")], "request_id long, tenant_id string, table_id string, action string, requested_by string")
    after, outcomes = registry.apply_requests(reg, asked, NOW)
    assert after.count() == reg.count()
    assert [r.outcome for r in outcomes.orderBy("request_id").collect()][1:] == ["UNCHANGED", "CONFLICT"]


def test_diagnostics_never_carry_messages(spark):
    causes = F.expr("""array(named_struct('class_name', 'IllegalStateException', 'known_code', CAST(NULL AS STRING), 'sql_state', CAST(NULL AS STRING), 'sql_code', CAST(NULL AS INT)),
      named_struct('class_name', 'SQLException', 'known_code', CAST(NULL AS STRING), 'sql_state', '28000', 'sql_code', 18456))""")
    assert spark.range(1).select(monitor.safe_diagnostic(causes)).first()[0] == "DEPENDENCY_FAILURE_IllegalStateException_SQLException_SQLSTATE_28000_SQLCODE_18456"
