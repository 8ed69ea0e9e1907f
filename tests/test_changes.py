"""Validation, typed differences, identity, boundaries and the wire form on small literal feeds."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rowtrail.functions import lsn
from rowtrail.operators import changes, history, schema, settings, wire
from rowtrail.operators.settings import SOURCE_SCHEMA
from rowtrail.sources import feeds as inputs

CAPTURED = dt.datetime(2026, 1, 1)
LSN = "00000027:00000ac0:0003"
CONTRACT, ALLOCATION = "Contract", "Allocation"


def source(spark, tenant="ACME", tables=("dbo.Contract", "dbo.Allocation"), incarnation="inc-1", boundaries=None):
    return spark.createDataFrame([(tenant, "hr", "localhost", 1433, "people", list(tables), incarnation, boundaries)], SOURCE_SCHEMA)


def value(op="c", before=None, after=None, table=CONTRACT, commit=LSN, db="people", serial=1, millis=1758500000000, change="00000027:00000ab8:0002"):
    return json.dumps({"op": op, "before": before, "after": after, "source": {
        "db": db, "schema": "dbo", "table": table, "commit_lsn": commit, "change_lsn": change, "event_serial_no": serial, "ts_ms": millis}})


def feed(spark, *records, tenant="ACME"):
    """Records are (key, value) or (key, value, destination)."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else f"capture-{tenant}-hr.people.dbo.x", CAPTURED) for r in records]
    return spark.createDataFrame(rows, "key string, value string, destination string, captured_at timestamp")


def parse(spark, *records, src=None):
    return changes.parse_change_feed(feed(spark, *records), src or source(spark)).collect()


def codes(spark, *records, src=None):
    rows = changes.validate_envelope(feed(spark, *records).withColumn("n", F.monotonically_increasing_id()), src or source(spark)).orderBy("n").collect()
    return [r.error_code or r.drop_reason for r in rows]


def test_identity_ignores_field_order_and_time_but_not_incarnation(spark):
    first = parse(spark, ('{"EmployeeID":42,"StartDate":"2026-01-01"}', value(after={"name": "A"})))[0]
    again = parse(spark, ('{"StartDate":"2026-01-01","EmployeeID":42}', value(after={"name": "A"}, millis=1758500009999)))[0]
    other = parse(spark, ('{"EmployeeID":42,"StartDate":"2026-01-01"}', value(after={"name": "A"})), src=source(spark, incarnation="inc-2"))[0]
    assert first.event_id == again.event_id != other.event_id
    assert first.record_key == '{"EmployeeID":42,"StartDate":"2026-01-01"}'


def test_nested_keys_are_canonical(spark):
    row = parse(spark, ('{"b":{"z":1,"a":[{"y":1,"x":2},3]},"a":1}', value(after={})))[0]
    assert row.record_key == '{"a":1,"b":{"a":[{"x":2,"y":1},3],"z":1}}'


@pytest.mark.parametrize("key, written", [
    ("1", "1"), ("1.0", "1.0"), ("1.50", "1.5"), ("1e3", "1000.0"), ("1000.0", "1000.0"), ("1000", "1000"), ("12345678901234567890123", "12345678901234567890123"),
])
def test_whole_and_fractional_numbers_are_different_keys(spark, key, written):
    assert parse(spark, (f'{{"id":{key},"a":"1.0"}}', value(after={})))[0].record_key == f'{{"a":"1.0","id":{written}}}'


@pytest.mark.parametrize("key, written", [
    ('[1]', '[1]'), ('[1.0]', '[1.0]'), ('[1e0, -2.50,3]', '[1.0,-2.5,3]'), ('{"z":1.0,"a":{"b":[1,1.0,"1.0"]}}', '{"a":{"b":[1,1.0,"1.0"]},"z":1.0}'),
    ('["a \\\\\\" 1.5 \\\\", 1.5]', '["a \\\\\\" 1.5 \\\\",1.5]'), ('[12345678901234567890123]', '[12345678901234567890123]'),
    ('[12345678901234567.88]', '[12345678901234567.88]'), ('12345678901234567.890', '12345678901234567.89'), ('[0.1, 1E400, true, null, 1.0e2]', '[0.1,1e400,true,null,100.0]'), ('[1.0,"a"]', '[1.0,"a"]'), ('{"a":[[],{"b":["x",2.0]}]}', '{"a":[[],{"b":["x",2.0]}]}'), ("[" * 40 + "1.0" + "]" * 40, "[" * 40 + "1.0" + "]" * 40),
])
def test_numbers_keep_their_kind_at_every_depth(spark, key, written):
    row = parse(spark, (f'{{"id":{key},"a":1}}', value(after={})))[0]
    assert row.record_key == f'{{"a":1,"id":{written}}}'
    again = changes.canonical_key(spark.createDataFrame([(row.record_key,)], "key string")).first().record_key
    assert again == row.record_key, "the written form reads as itself"


def test_long_documents_are_marked_without_deep_recursion(spark):
    text = '{"k":[' + ",".join(f'{i},"s{i}",{i}.50' for i in range(20_000)) + "]}"
    images = spark.createDataFrame([(text, text.replace("77.50", "77.5")), (text, text.replace("77.50", "77.51"))], "before_json string, after_json string")
    assert [r.changed_properties for r in changes.changed_properties(images).collect()] == ["[]", '["k"]']


def test_equal_numbers_of_another_form_are_no_difference(spark):
    images = spark.createDataFrame([('{"k":1e3,"n":1.50}', '{"k":1000.0,"n":1.5}')], "before_json string, after_json string")
    assert changes.changed_properties(images).first().changed_properties == "[]"


def test_positions_that_cannot_be_read_are_reported(spark):
    rows = spark.createDataFrame([("00000001:00000001:0001",), ("00000003:00000001:0001",), ("3:1",), (None,)], "commit_lsn string")
    found = inputs.start_at_activation(rows, "00000002:00000001:0001").collect()
    assert sorted((r.commit_lsn or "", r.error_code) for r in found) == [
        ("", "INVALID_SOURCE_POSITION"), ("00000003:00000001:0001", None), ("3:1", "INVALID_SOURCE_POSITION")]
    with pytest.raises(ValueError, match="INVALID_SOURCE_POSITION"):
        inputs.start_at_activation(rows, "2:1")


def test_typed_differences(spark):
    before = {"unchanged": False, "nullToEmpty": None, "zeroToFalse": 0, "absentNext": None, "numberToText": 12}
    after = {"unchanged": False, "nullToEmpty": "", "zeroToFalse": False, "numberToText": "12"}
    row = parse(spark, ('{"id":1}', value("u", before, after)))[0]
    assert row.operation == "UPDATE"
    assert row.changed_properties == '["absentNext","nullToEmpty","numberToText","zeroToFalse"]'


@pytest.mark.parametrize("before, after, expected", [
    ({"a": 1, "b": "x"}, {"a": 1, "b": "y"}, ["b"]),
    ({"b": "x", "a": 1}, {"a": 1, "b": "x"}, []),
    ({"n": {"x": 1, "y": 2}}, {"n": {"y": 2, "x": 1}}, []),
    ({"n": {"x": 1}}, {"n": {"x": 2}}, ["n"]),
    ({"n": [1, 2]}, {"n": [2, 1]}, ["n"]),
    ({"a:1": 1, "a": ":1"}, {"a:1": 2, "a": ":1"}, ["a:1"]),
    ({"k": None}, {}, ["k"]),
    ({"k": "null"}, {"k": None}, ["k"]),
    ({"k": True}, {"k": "true"}, ["k"]),
    ({"k": 1.5}, {"k": 1.50}, []),
    ({"k": 12}, {"k": 12.0}, ["k"]),
    ({"k": 10 ** 25}, {"k": 10 ** 25}, []),
    ({"k": 10 ** 25}, {"k": 10 ** 25 + 1}, ["k"]),
    ({"k": "a\u0000b"}, {"k": "a\u0000c"}, ["k"]),
    ({}, {}, []),
])
def test_differences_either_way(spark, before, after, expected):
    row = parse(spark, ('{"id":1}', value("u", before, after)))[0]
    assert json.loads(row.changed_properties) == expected
    assert json.loads(row.before_json) == before and json.loads(row.after_json) == after


def test_delete_and_insert_images(spark):
    deleted = parse(spark, ('{"id":1}', value("d", {"x": None}, None)))[0]
    assert (deleted.operation, deleted.after_json, deleted.changed_properties) == ("DELETE", None, '["x"]')
    odd = parse(spark, ('{"id":1}', value("c", {"x": 1}, {"x": 1})))[0]
    assert (odd.before_json, odd.changed_properties) == ('{"x":1}', "[]")


def test_validation_codes(spark):
    good = '{"id":1}'
    assert codes(
        spark,
        (None, None), (good, "not json"), (good, ""), (good, value("r", None, {})), (good, value(5, None, {})), (good, value(after={}, db="wrong")),
        (good, value(after={}, table="Other")), ("{", value(after={})), (None, value(after={})), ("", value(after={})), ("[]", value(after={})), ("{}", value(after={})),
        (good, value(after={}, commit="")), (good, value(after={}, commit="garbage")), (good, value(after={}, change=None)), (good, value(after={}, serial="1")),
        (good, value(after={}, millis=1e30)), (good, value("u", None, {})), (good, value("u", {}, None)), (good, value("c", None, [])), (good, value("c", None, "{}")),
        (good, value(after={})),
    ) == [
        "TOMBSTONE", "INVALID_EVENT_JSON", "INVALID_SOURCE_ENVELOPE", "UNEXPECTED_SOURCE_OPERATION", "INVALID_SOURCE_ENVELOPE", "UNEXPECTED_SOURCE_TABLE",
        "UNEXPECTED_SOURCE_TABLE", "INVALID_EVENT_JSON", "SOURCE_KEY_MISSING", "SOURCE_KEY_MISSING", "SOURCE_KEY_MISSING", "SOURCE_KEY_MISSING",
        "INVALID_SOURCE_ENVELOPE", "INVALID_SOURCE_POSITION", "INVALID_SOURCE_ENVELOPE", "SOURCE_COORDINATES_MISSING",
        "SOURCE_COORDINATES_MISSING", "SOURCE_ROW_IMAGE_MISSING", "SOURCE_ROW_IMAGE_MISSING", "SOURCE_ROW_IMAGE_MISSING", "SOURCE_ROW_IMAGE_MISSING",
        None,
    ]


def test_fraction_in_serial_is_cut_off(spark):
    assert parse(spark, ('{"id":1}', value(after={}, serial=1.5)))[0].event_serial_no == 1


def test_heartbeats(spark):
    beat = value("u", {"tick_sequence": 1}, {"tick_sequence": 2}, table="Capture_Heartbeat")
    assert codes(
        spark, ('{"singleton_id":1}', beat), ('{"singleton_id":2}', beat), ('{"singleton_id":"1"}', beat),
        ('{"singleton_id":1}', value("d", {}, None, table="Capture_Heartbeat")), ('{"singleton_id":1}', value("u", {}, {}, table="Capture_Event")),
        ("{}", "{}", "__debezium-heartbeat.capture-ACME-hr"), ("{}", "broken", "__debezium-heartbeat.capture-ACME-hr"),
    ) == ["HEARTBEAT", "INVALID_INTERNAL_HEARTBEAT", "INVALID_INTERNAL_HEARTBEAT", "INVALID_INTERNAL_HEARTBEAT", "UNEXPECTED_SOURCE_TABLE",
          "CONNECTOR_HEARTBEAT", "INVALID_EVENT_JSON"]


def test_activation_boundary_of_one_table(spark):
    src = source(spark, boundaries={"dbo.Allocation": LSN})
    at = lambda table, commit: ('{"id":1}', value(after={}, table=table, commit=commit))
    assert codes(
        spark, at(ALLOCATION, LSN), at(ALLOCATION, "00000027:00000ac0:0002"), at(ALLOCATION, "00000027:00000AC0:0004"), at(CONTRACT, LSN), src=src,
    ) == ["BEFORE_ACTIVATION", "BEFORE_ACTIVATION", None, None]


def test_fail_mode_stops_and_quarantine_goes_on(spark):
    records = [('{"id":1}', value(after={})), ('{"id":2}', value("r", None, {}))]
    with pytest.raises(Exception, match="UNEXPECTED_SOURCE_OPERATION"):
        parse(spark, *records)
    assert len(changes.parse_change_feed(feed(spark, *records), source(spark), on_error="quarantine").collect()) == 1


def test_tenants_are_routed_by_their_connector(spark):
    both = source(spark).unionByName(source(spark, tenant="OTHER"))
    rows = changes.parse_change_feed(
        feed(spark, ('{"id":1}', value(after={}))).unionByName(feed(spark, ('{"id":1}', value(after={})), tenant="OTHER")), both).collect()
    assert {r.tenant_id for r in rows} == {"ACME", "OTHER"} and len({r.event_id for r in rows}) == 2
    assert codes(spark, ('{"id":1}', value(after={}), "capture-NOBODY-hr.people.dbo.x")) == ["UNEXPECTED_SOURCE_TABLE"]


def test_wire_round_trip_and_foreign_tenant(spark):
    src = source(spark)
    events = changes.parse_change_feed(feed(spark, ('{"id":"x\\"y"}', value("u", {"a": "é"}, {"a": None}))), src)
    decoded = wire.wire_decode(wire.wire_encode(events, src), src)
    assert decoded.select(*changes.HISTORY_COLUMNS).collect() == events.collect()
    assert decoded.select("error_code").collect()[0][0] is None
    foreign = wire.wire_decode(wire.wire_encode(events, src), source(spark, tenant="OTHER"))
    assert foreign.select("error_code").collect()[0][0] == "INVALID_BROKER_EVENT"


def test_wire_of_an_unlisted_source_stops_and_bad_times_are_marked(spark):
    src = source(spark)
    events = changes.parse_change_feed(feed(spark, ('{"id":1}', value(after={"a": 1}))), src)
    with pytest.raises(Exception, match="UNKNOWN_WIRE_SOURCE"):
        wire.wire_encode(events, source(spark, tenant="OTHER")).collect()
    body = wire.wire_encode(events, src)
    for pattern, put in (('"occurredAt":"[^"]*"', '"occurredAt":"yesterday"'), ('"occurredAt":"[^"]*"', '"occurredAt":null'), ('"capturedAt":"[^"]*"', '"capturedAt":null')):
        broken = wire.wire_decode(body.withColumn("body", F.regexp_replace("body", pattern, put)), src)
        assert [r.error_code for r in broken.collect()] == ["INVALID_BROKER_EVENT"]


def test_replays_in_any_order_leave_one_row_each(spark):
    records = [(f'{{"id":{i}}}', value(after={"v": i}, serial=i)) for i in range(20)]
    once = changes.parse_change_feed(feed(spark, *records), source(spark))
    many = changes.parse_change_feed(feed(spark, *(records[::-1] + records[5:] + records[:9])), source(spark))
    assert sorted(r.event_id for r in history.dedupe_events(many).collect()) == sorted(r.event_id for r in once.collect())
    assert history.dedupe_events(many, once).count() == 0
    held = once.filter("event_serial_no % 2 = 0")
    assert {r.event_serial_no % 2 for r in history.dedupe_events(many, held).collect()} == {1}


def test_first_copy_wins_and_a_hot_event_is_pruned_before_the_shuffle(spark):
    one = changes.parse_change_feed(feed(spark, ('{"id":1}', value(after={}))), source(spark))
    later = one.withColumn("captured_at", F.col("captured_at") + F.expr("interval 1 hour"))
    copies = later.unionByName(one).unionByName(later)
    assert history.first_copies(copies).collect()[0].captured_at == CAPTURED
    plan = history.first_copies(copies)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_expensive_fields_are_computed_below_the_rules(spark):
    """The filter on rules must not be pushed under the projections that parse, or documents parse repeatedly."""
    plan = changes.parse_change_feed(feed(spark, ('{"id":1}', value(after={}))), source(spark), on_error="quarantine")._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("parseJson" in line for line in filters)
    assert plan.count("parseJson(value") == 1


def test_prefix_and_marker_of_the_service_are_settings(spark):
    listed = source(spark)
    assert {r.connector for r in settings.prepare_sources(listed, connector_prefix="feed").collect()} == {f"feed-{r.tenant_id}-{r.source_id}" for r in listed.collect()}
    catalog = spark.createDataFrame([("dbo", "Own_Beat", False), ("dbo", "Capture_Heartbeat", False), ("dbo", "Orders", False)], "schema_name string, table_name string, is_shipped boolean")
    shown = lambda **marker: {r.table_name for r in schema.capturable_tables(catalog, **marker).collect()}
    assert shown() == {"Own_Beat", "Orders"} and shown(service_marker="Own_") == {"Capture_Heartbeat", "Orders"}


def test_a_value_is_read_by_one_pass_over_its_variant(spark):
    plan = changes.examine(feed(spark), source(spark))._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_variant_get(_value_read#") == 1


def test_the_longest_method_that_is_compiled_is_set_unless_the_session_has_its_own(spark):
    from rowtrail.session import HUGE_METHOD, configure

    name, limit = HUGE_METHOD
    try:
        spark.conf.set(name, "20000")
        assert configure(spark).conf.get(name) == "20000"
        spark.conf.unset(name)
        assert configure(spark).conf.get(name) == limit
    finally:
        spark.conf.set(name, limit)


def test_position_text_is_what_a_formatter_writes(spark):
    parts = [(39, 5, 3), (1 << 33, 65535, 70000), (0, -1, None), (None, None, 15)]
    rows = spark.createDataFrame(parts, "a long, b long, c int").select(
        lsn.make_lsn(F.col("a"), F.col("b"), F.col("c")).alias("text"), F.format_string("%08x:%08x:%04x", F.col("a"), F.col("b"), F.col("c").cast("long")).alias("formatted"))
    assert all(r.text == r.formatted for r in rows.collect())


def test_keys_without_a_fraction_read_as_before(spark):
    texts = ['{"b":1,"a":"1"}', '{"a":12345678901234567890,"DOUBLE":[1,"x"]}', '{"a":"v1.5"}', '{"a":1.0,"b":{"c":2e1}}', '[1,2]', '{"a":' + "9" * 40 + "}", "", None]
    keys = [r.record_key for r in changes.canonical_key(spark.createDataFrame([(t,) for t in texts], "key string")).collect()]
    assert keys == ['{"a":"1","b":1}', '{"DOUBLE":[1,"x"],"a":12345678901234567890}', '{"a":"v1.5"}', '{"a":1.0,"b":{"c":20.0}}', "[1,2]", '{"a":1.0E40}', None, None]
