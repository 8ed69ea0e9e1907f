"""Durable delivery: reruns, crashes between write and commit, fences, held sources, retention, snapshots."""

import datetime as dt
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from rowtrail.functions import lsn
from rowtrail.operators import changes, history, reconcile
from rowtrail.plans import change_queries
from rowtrail.plans.catalog import QUERIES
from rowtrail.sources import feeds as inputs
from rowtrail.sources import storage
from rowtrail.streaming import history as streams
from tests.test_changes import feed, source, value


def records(low, high):
    return [(f'{{"id":{i}}}', value(after={"v": i}, serial=i)) for i in range(low, high)]


def write_feed(spark, path, *batches):
    for batch in batches:
        feed(spark, *batch).coalesce(1).write.mode("append").parquet(str(path))


def start(spark, tmp_path, **options):
    return streams.stream_history(
        inputs.stream_change_feed(spark, str(tmp_path / "feed"), max_files=1), source(spark), str(tmp_path / "history"), str(tmp_path / "checkpoint"),
        wire_path=str(tmp_path / "wire"), available_now=True, **options)


def ids(spark, path):
    return [r.event_serial_no for r in storage.read_history(spark, str(path)).orderBy("event_serial_no").collect()]


def test_overlapping_batches_give_each_event_once(spark, tmp_path):
    write_feed(spark, tmp_path / "feed", records(0, 10) + records(3, 6), records(5, 15), records(0, 15))
    start(spark, tmp_path).awaitTermination()
    assert ids(spark, tmp_path / "history") == list(range(15))
    assert spark.read.parquet(str(tmp_path / "wire")).select("event_id").distinct().count() == 15


def test_a_crash_between_write_and_commit_runs_the_batch_again(spark, tmp_path, monkeypatch):
    write_feed(spark, tmp_path / "feed", records(0, 10), records(5, 15))
    publish = storage.publish_wire
    calls = []

    def crash(*arguments):
        calls.append(arguments[3])
        if len(calls) in (1, 3):
            raise RuntimeError("lost before commit")
        publish(*arguments)

    monkeypatch.setattr(storage, "publish_wire", crash)
    for _ in range(2):
        with pytest.raises(Exception, match="lost before commit"):
            start(spark, tmp_path).awaitTermination()
    start(spark, tmp_path).awaitTermination()
    assert calls == [0, 0, 1, 1]
    assert ids(spark, tmp_path / "history") == list(range(15))
    assert spark.read.parquet(str(tmp_path / "wire")).count() == 15


def test_a_new_checkpoint_adds_to_what_is_stored(spark, tmp_path):
    for name, part in (("one", records(0, 10)), ("two", records(5, 15))):
        write_feed(spark, tmp_path / name, part)
        streams.stream_history(inputs.stream_change_feed(spark, str(tmp_path / name)), source(spark), str(tmp_path / "history"), str(tmp_path / f"checkpoint-{name}"),
                               wire_path=str(tmp_path / "wire"), available_now=True).awaitTermination()
    assert ids(spark, tmp_path / "history") == list(range(15))
    assert spark.read.parquet(str(tmp_path / "wire")).select("event_id").distinct().count() == 15


def test_streamed_dedupe_keeps_late_events(spark, tmp_path):
    day = 86_400_000
    late = [(f'{{"id":{i}}}', value(after={}, serial=i, millis=1758500000000 - i * 30 * day)) for i in range(8)]
    write_feed(spark, tmp_path / "feed", late[:4], late[2:6], late[::-1])
    parsed = changes.parse_change_feed(inputs.stream_change_feed(spark, str(tmp_path / "feed"), max_files=1), source(spark))
    streams.stream_dedupe(parsed).select("event_id").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8


def test_a_record_without_destination_is_held(spark, tmp_path):
    feed(spark, *records(0, 3)).unionByName(feed(spark, ('{"id":9}', "broken")).withColumn("destination", F.lit(None).cast("string"))).coalesce(1).write.parquet(str(tmp_path / "feed"))
    streams.stream_quarantine(inputs.stream_change_feed(spark, str(tmp_path / "feed")), source(spark), str(tmp_path / "history"), str(tmp_path / "held"),
                              str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert ids(spark, tmp_path / "history") == [0, 1, 2]
    assert storage.read_snapshot(spark, str(tmp_path / "held")).count() == 1


def test_a_broken_record_stops_the_stream_every_time(spark, tmp_path):
    write_feed(spark, tmp_path / "feed", records(0, 3) + [('{"id":9}', value("r", None, {}))])
    for _ in range(2):
        with pytest.raises(Exception, match="UNEXPECTED_SOURCE_OPERATION"):
            start(spark, tmp_path).awaitTermination()
    assert ids(spark, tmp_path / "history") == []


def test_a_moved_fence_stops_the_stream(spark, tmp_path):
    write_feed(spark, tmp_path / "feed", records(0, 3))
    current = spark.createDataFrame([("hr", 8)], "source_id string, fence bigint")
    with pytest.raises(Exception, match="SOURCE_FENCED"):
        start(spark, tmp_path, read_activation=lambda: current, fences={"hr": 7}).awaitTermination()
    start(spark, tmp_path, read_activation=lambda: current, fences={"hr": 8}).awaitTermination()
    assert ids(spark, tmp_path / "history") == [0, 1, 2]


def test_a_failing_source_is_held_and_released(spark, tmp_path):
    both = source(spark).unionByName(source(spark, tenant="OTHER"))
    path = tmp_path / "feed"

    def run(sources, **options):
        streams.stream_quarantine(
            inputs.stream_change_feed(spark, str(path)), sources, str(tmp_path / "history"), str(tmp_path / "held"), str(tmp_path / "checkpoint"), available_now=True,
            wire_path=str(tmp_path / "wire"), **options).awaitTermination()

    stranger = ('{"id":50}', value(after={}, serial=50, table="Late"))
    feed(spark, *records(0, 3)).unionByName(feed(spark, *(records(10, 13) + [stranger]), tenant="OTHER")).coalesce(1).write.parquet(str(path))
    current = spark.createDataFrame([("hr", 8)], "source_id string, fence bigint")
    with pytest.raises(Exception, match="SOURCE_FENCED"):
        run(both, read_activation=lambda: current, fences={"hr": 7})
    run(both, read_activation=lambda: current, fences={"hr": 8})
    assert ids(spark, tmp_path / "history") == [0, 1, 2]
    assert storage.read_snapshot(spark, str(tmp_path / "held")).count() == 4
    assert spark.read.parquet(str(tmp_path / "wire")).count() == 3
    # Once the table is allowed, what waited goes through with the next batch, before nothing else is lost.
    feed(spark, *records(13, 14), tenant="OTHER").coalesce(1).write.mode("append").parquet(str(path))
    run(source(spark).unionByName(source(spark, tenant="OTHER", tables=("dbo.Contract", "dbo.Late"))))
    assert ids(spark, tmp_path / "history") == [0, 1, 2, 10, 11, 12, 13, 50]
    assert storage.read_snapshot(spark, str(tmp_path / "held")).count() == 0


def test_retention_removes_the_oldest_and_only_those(spark, tmp_path):
    path = str(tmp_path / "history")
    day = 86_400_000
    old = [(f'{{"id":{i}}}', value(after={"v": i}, serial=i, millis=1758500000000 + i * 10 * day)) for i in range(12)]
    events = changes.parse_change_feed(feed(spark, *old), source(spark))
    storage.save_events(events, path, 0)
    cutoff = dt.datetime.fromtimestamp(1758500000 + 95 * 86400, dt.timezone.utc)
    assert storage.retention_prune_write(spark, path, "ACME", cutoff, 4) == 4
    assert ids(spark, path) == list(range(4, 12))
    assert storage.retention_prune_write(spark, path, "OTHER", cutoff, 4) == 0
    assert storage.retention_prune_write(spark, path, "ACME", cutoff, 500) == 6
    assert storage.retention_prune_write(spark, path, "ACME", cutoff, 500) == 0
    assert ids(spark, path) == [10, 11]


def test_a_stopped_retention_pass_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    day = 86_400_000
    for tenant in ("ACME", "O:T H+E%R"):
        old = [(f'{{"id":{i}}}', value(after={"v": i}, serial=i, millis=1758500000000 + i * 10 * day)) for i in range(12)]
        events = changes.parse_change_feed(feed(spark, *old, tenant=tenant), source(spark, tenant=tenant))
        storage.save_events(events, path, 0, tenant[:1])
    cutoff = dt.datetime.fromtimestamp(1758500000 + 95 * 86400, dt.timezone.utc)
    # Stopped after the survivors were written aside: nothing has changed, and the pass is done by the next one.
    assert storage.stage_retention(spark, path, None, cutoff, 3) == 6
    assert ids(spark, path) == sorted([*range(12)] * 2)
    # Stopped in the middle of putting them in place, after some partitions.
    staged = next((tmp_path / "history" / "_rewrites").iterdir())
    first = spark.read.parquet(str(staged / "moves")).filter("survives").orderBy("place").first()["place"]
    shutil.rmtree(tmp_path / "history" / first)
    (staged / "survivors" / first).rename(tmp_path / "history" / first)
    storage.finish_rewrites(spark, path)
    assert ids(spark, path) == sorted([*range(3, 12)] * 2)
    # Stopped before it was all written aside: forgotten.
    storage.stage_retention(spark, path, "ACME", cutoff, 2)
    left = next((tmp_path / "history" / "_rewrites").iterdir())
    (left / "moves" / "_SUCCESS").unlink()
    storage.finish_rewrites(spark, path)
    assert ids(spark, path) == sorted([*range(3, 12)] * 2)

    def fenced():
        raise streams.SourceFenced(history.SOURCE_FENCED)

    with pytest.raises(streams.SourceFenced):
        storage.retention_prune_write(spark, path, None, cutoff, 500, before_write=fenced)
    storage.finish_rewrites(spark, path)
    assert ids(spark, path) == sorted([*range(3, 12)] * 2)


def test_a_batch_run_again_after_compaction_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    batches = [changes.parse_change_feed(feed(spark, *records(low, low + 6)), source(spark)) for low in (0, 4, 8)]
    for n, batch in enumerate(batches):
        storage.save_events(batch, path, n, "stream")
    before = sorted(storage.read_history(spark, path).select(*changes.HISTORY_COLUMNS).collect())
    assert storage.compact_history(spark, path, dt.date(2025, 10, 15)) == 3
    assert storage.compact_history(spark, path, dt.date(2025, 10, 15)) == 0
    storage.save_events(batches[2], path, 2, "stream")
    assert sorted(storage.read_history(spark, path).select(*changes.HISTORY_COLUMNS).collect()) == before
    assert storage.compact_history(spark, path, dt.date(2025, 9, 30)) == 0
    assert [p.name for p in (tmp_path / "history" / "tenant_id=ACME" / "occurred_month=2025-09-01").iterdir() if not p.name.startswith(".")] == ["stream_id=compacted"]


def test_a_subscriber_refuses_what_it_cannot_trust(spark, tmp_path):
    events = changes.parse_change_feed(feed(spark, *records(0, 4)), source(spark))
    storage.publish_wire(events, source(spark), str(tmp_path / "wire"), 0)

    def subscribe(of, name, **options):
        bodies = spark.readStream.schema("event_id string, body string, stream_id string, batch_id bigint").parquet(str(tmp_path / "wire"))
        streams.wire_subscribe(bodies, of, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), available_now=True, **options).awaitTermination()

    subscribe(source(spark), "good")
    assert ids(spark, tmp_path / "good") == [0, 1, 2, 3]
    with pytest.raises(Exception, match="INVALID_BROKER_EVENT"):
        subscribe(source(spark, incarnation="inc-2"), "other")
    current = spark.createDataFrame([("hr", 8)], "source_id string, fence bigint")
    with pytest.raises(Exception, match="SOURCE_FENCED"):
        subscribe(source(spark), "fenced", read_activation=lambda: current, fences={"hr": 7})
    assert ids(spark, tmp_path / "other") == ids(spark, tmp_path / "fenced") == []


@pytest.mark.parametrize("size", [0, -1, 1001])
def test_a_page_is_bounded(spark, tmp_path, size):
    with pytest.raises(ValueError, match="a page has 1 to 1000 rows"):
        history.history_page(storage.read_history(spark, str(tmp_path / "none")), size=size)


def test_an_unfinished_snapshot_does_not_count(spark, tmp_path):
    path = str(tmp_path / "table")
    storage.write_snapshot(spark.range(1), path, 0)
    (tmp_path / "table" / "version=1").mkdir()
    assert storage.latest_version(spark, path) == 0
    assert storage.read_snapshot(spark, path).count() == 1


def test_history_reads_prune_partitions_and_push_filters(spark, tmp_path):
    path = str(tmp_path / "history")
    storage.save_events(changes.parse_change_feed(feed(spark, *records(0, 5)), source(spark)), path, 0)
    found = storage.read_history(spark, path).filter((F.col("tenant_id") == "ACME") & (F.col("operation") == "INSERT")).select("event_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(tenant_id" in plan or "PartitionFilters: [(tenant_id" in plan and "EqualTo(operation,INSERT)" in plan
    assert "ReadSchema: struct<event_id:string,operation:string>" in plan


def test_splitting_a_feed_gives_the_batch_result(spark, tmp_path):
    whole = changes.parse_change_feed(feed(spark, *records(0, 30)), source(spark))
    path = str(tmp_path / "history")
    for n, low in enumerate(range(0, 30, 7)):
        storage.save_events(changes.parse_change_feed(feed(spark, *records(max(0, low - 2), min(30, low + 7))), source(spark)), path, n)
    assert sorted(r.event_id for r in storage.read_history(spark, path).collect()) == sorted(r.event_id for r in whole.collect())


def files_listed(spark, action):
    """Files that Spark's listings found while an action ran."""
    counter = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = counter.getCount()
    action()
    return counter.getCount() - before


def month_records(month, low, high, tenant="ACME"):
    millis = int(dt.datetime(2025, month, 3, tzinfo=dt.timezone.utc).timestamp() * 1000)
    return [(f'{{"id":{i}}}', value(after={"v": i}, serial=1, millis=millis, commit=f"{month:08x}:{i:08x}:0002")) for i in range(low, high)]


def test_new_events_are_saved_without_looking_at_the_history(spark, tmp_path):
    path, found = str(tmp_path / "history"), []
    for n in range(8):
        events = changes.parse_change_feed(feed(spark, *month_records(1 + n, 100 + 10 * n, 105 + 10 * n)), source(spark))
        found.append(files_listed(spark, lambda events=events, n=n: storage.save_events(events, path, n, "stream")))
    assert max(found) <= 4, "only the batch's own receipt is listed, however long the history is"
    assert storage.read_history(spark, path).count() == 40


def test_a_replay_opens_its_own_months_only(spark, tmp_path):
    path = str(tmp_path / "history")
    both = source(spark).unionByName(source(spark, tenant="OTHER"))
    for n in range(6):
        batch = feed(spark, *month_records(1 + n, 0, 4)).unionByName(feed(spark, *month_records(1 + n, 0, 4)).withColumn("destination", F.lit("capture-OTHER-hr.people.dbo.x")))
        storage.save_events(changes.parse_change_feed(batch, both), path, n, "stream")
    replay = changes.parse_change_feed(feed(spark, *month_records(2, 0, 5)), source(spark))
    new, own = files_listed(spark, lambda: storage.save_events(replay, path, 99, "stream")), storage.read_history(spark, path)
    assert own.filter("tenant_id = 'ACME'").count() == 25, "the new one of the five is stored, the four others are not stored again"
    more = files_listed(spark, lambda: storage.save_events(changes.parse_change_feed(feed(spark, *month_records(2, 0, 5)), source(spark)), path, 100, "stream"))
    # Its own month's files and its receipt; the late one of the first replay made that look at all months of the tenant, but of no other.
    other = len(list((tmp_path / "history" / "tenant_id=OTHER").rglob("*.parquet")))
    assert more <= 10 and more < new and other >= 6, (more, new, other)
    opened = storage._stored_copies(replay, path, F.lit(False), history.position_spans(replay)).inputFiles()
    assert opened and all("tenant_id=ACME/occurred_month=2025-02-01" in file for file in opened)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = storage._stored_copies(replay, path, F.lit(False), history.position_spans(replay))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "GreaterThanOrEqual(commit_lsn" in plan and "EqualTo(source_id" in plan


def test_a_copy_with_another_time_is_still_a_copy(spark, tmp_path):
    path = str(tmp_path / "history")
    for n, month in enumerate((1, 2, 3)):
        storage.save_events(changes.parse_change_feed(feed(spark, *month_records(month, 0, 4)), source(spark)), path, n, "stream")
    moved = [(key, text.replace(str(int(dt.datetime(2025, 2, 3, tzinfo=dt.timezone.utc).timestamp() * 1000)), str(int(dt.datetime(2025, 3, 9, tzinfo=dt.timezone.utc).timestamp() * 1000)))) for key, text in month_records(2, 0, 4)]
    storage.save_events(changes.parse_change_feed(feed(spark, *moved), source(spark)), path, 3, "stream")
    assert storage.read_history(spark, path).count() == 12


def test_marks_of_all_writers_count(spark, tmp_path):
    """A history written without de-duplication, by hand and by streams has one set of marks; one without marks is compared whole."""
    path = str(tmp_path / "history")
    whole = changes.parse_change_feed(feed(spark, *month_records(1, 0, 9)), source(spark))
    storage.append_history(whole, path, 0)
    storage.save_events(whole, path, 0, "a stream/with: odd=name")
    assert storage.read_history(spark, path).count() == 9 and list(storage.read_marks(spark, path).values()) == ["00000001:00000008:0002"]
    shutil.rmtree(tmp_path / "history" / "_marks")
    storage.save_events(whole, path, 1, "another")
    assert storage.read_history(spark, path).count() == 9


def test_a_rerun_after_compaction_still_delivers(spark, tmp_path):
    path = str(tmp_path / "history")
    events = changes.parse_change_feed(feed(spark, *month_records(1, 0, 20)), source(spark))
    first = {r.event_id for r in storage.save_events(events, path, 0, "stream").collect()}
    assert storage.compact_history(spark, path, dt.date(2025, 9, 1)) == 1
    assert {r.event_id for r in storage.save_events(events, path, 0, "stream").collect()} == first and len(first) == 20
    assert storage.read_history(spark, path).count() == 20
    assert storage.save_events(events, path, 1, "stream").collect() == []
    storage.drop_receipts(spark, path, "stream", 1)
    assert storage.save_events(events, path, 1, "stream").collect() == [] and storage.read_history(spark, path).count() == 20


def test_the_wire_loses_nothing_between_a_crash_and_compaction(spark, tmp_path, monkeypatch):
    write_feed(spark, tmp_path / "feed", month_records(1, 0, 10), month_records(1, 5, 15))
    publish, calls = storage.publish_wire, []

    def crash(*arguments):
        calls.append(arguments[3])
        if len(calls) in (1, 3):
            raise RuntimeError("lost before commit")
        publish(*arguments)

    monkeypatch.setattr(storage, "publish_wire", crash)
    for _ in range(2):
        with pytest.raises(Exception, match="lost before commit"):
            start(spark, tmp_path).awaitTermination()
        storage.compact_history(spark, str(tmp_path / "history"), dt.date(2025, 9, 1))
    start(spark, tmp_path).awaitTermination()
    wire = spark.read.parquet(str(tmp_path / "wire"))
    assert wire.count() == 15 == wire.select("event_id").distinct().count() == storage.read_history(spark, str(tmp_path / "history")).count()


def test_a_used_batch_id_with_other_events_is_refused(spark, tmp_path):
    path = str(tmp_path / "history")
    storage.save_events(changes.parse_change_feed(feed(spark, *month_records(1, 0, 3)), source(spark)), path, 0)
    with pytest.raises(storage.BatchChanged):
        storage.save_events(changes.parse_change_feed(feed(spark, *month_records(1, 0, 5)), source(spark)), path, 0)
    storage.save_events(changes.parse_change_feed(feed(spark, *month_records(1, 0, 5)), source(spark)), path, 1)
    assert storage.read_history(spark, path).count() == 5


def test_late_events_become_a_part_beside_the_compacted_ones(spark, tmp_path):
    path, before = str(tmp_path / "history"), dt.date(2025, 9, 1)
    parts = []
    for n in range(storage.COMPACTED_PARTS + 2):
        storage.save_events(changes.parse_change_feed(feed(spark, *month_records(1, 10 * n, 10 * n + 3), *month_records(2, 10 * n, 10 * n + (3 if n == 0 else 0))), source(spark)), path, n, "stream")
        assert storage.compact_history(spark, path, before) == (2 if n == 0 else 1 if n <= storage.COMPACTED_PARTS - 1 else 1 + len(parts[-1]) if len(parts[-1]) >= storage.COMPACTED_PARTS else 1)
        parts.append(storage._listed(spark, f"{path}/tenant_id=ACME/occurred_month=2025-01-01/stream_id=compacted"))
        assert files_listed(spark, lambda: storage.compact_history(spark, path, before)) == 0, "months brought together are not opened"
    assert [len(p) for p in parts] == [1, 2, 3, 4, 1, 2]
    assert storage.read_history(spark, path).count() == 3 * (storage.COMPACTED_PARTS + 2) + 3


def test_a_lookup_of_an_absent_event_passes_over_compacted_files(spark, tmp_path):
    path = str(tmp_path / "history")
    storage.save_events(changes.parse_change_feed(feed(spark, *month_records(1, 0, 200)), source(spark)), path, 0, "stream")
    storage.compact_history(spark, path, dt.date(2025, 9, 1))
    some = storage.read_history(spark, path).select("event_id").orderBy("event_id").collect()
    inside = some[0].event_id[:8] + "0" * 56
    for wanted, rows in ((some[7].event_id, True), (max(inside, some[0].event_id[:-1] + "g")[:64], False)):
        found = storage.read_history(spark, path).filter(F.col("event_id") == wanted).select("operation")
        execution = found._jdf.queryExecution()
        collected = found.collect()
        nodes = execution.executedPlan().collectLeaves()
        read = [nodes.apply(i).metrics().get("numOutputRows").get().value() for i in range(nodes.size())]
        assert bool(collected) == rows and (sum(read) > 0 or not rows)
        if not rows:
            assert sum(read) == 0


def test_a_replaced_writer_cannot_replace_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "registry")
    numbers = lambda: [r.id for r in storage.read_snapshot(spark, path).collect()]
    storage.write_registry(spark.range(1, 2), path, 0)
    storage.write_registry(spark.range(7, 8), path, 1, fence=7, writer="old")
    storage.write_registry(spark.range(8, 9), path, 1, fence=8, writer="new")
    for version in (1, 2, 99):
        with pytest.raises(storage.SourceFenced, match="SOURCE_FENCED"):
            storage.write_registry(spark.range(70, 71), path, version, fence=7, writer="old")
    assert numbers() == [8]
    with pytest.raises(storage.SourceFenced, match="another writer"):
        storage.write_registry(spark.range(80, 81), path, 1, fence=8, writer="third")
    storage.write_registry(spark.range(9, 10), path, 1, fence=8, writer="new")  # again after a crash
    assert numbers() == [9]
    # A replaced writer that was already past its claim finishes late: its version never counts as the newest.
    spark.range(71, 72).write.parquet(f"{path}/fence=7/version=500")
    assert numbers() == [9] and [r.id for r in storage.read_snapshot(spark, path, below=1, fence=8).collect()] == [71]


def test_two_writers_at_one_version(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "status")

    def write(n):
        try:
            storage.write_snapshot(spark.range(n, n + 1), path, 0, fence=3, writer=f"w{n}")
            return n
        except storage.SourceFenced:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [n for n in pool.map(write, range(4)) if n is not None]
    assert len(won) == 1 and [r.id for r in storage.read_snapshot(spark, path).collect()] == won


def test_old_versions_go_after_their_time(spark, tmp_path):
    import time

    path = str(tmp_path / "status")
    for version in range(4):
        storage.write_snapshot(spark.range(version, version + 1), path, version, fence=None if version < 2 else 5, writer="w")
    assert storage.drop_old_versions(spark, path, 3600) == 0
    assert storage.drop_old_versions(spark, path, 3600, now=time.time() + 7200) == 3
    assert [r.id for r in storage.read_snapshot(spark, path).collect()] == [3] and storage.latest_version(spark, path) == 3


def test_status_of_a_replaced_reader_does_not_count(spark, tmp_path):
    columns = "source_id string, state string, message string, updated_at timestamp, last_event_at timestamp, last_commit_lsn string, retention_minutes int, retention_headroom_seconds bigint"
    row = lambda state, minute: ("hr", state, None, dt.datetime(2026, 1, 1, 0, minute), None, None, None, None)
    path = str(tmp_path / "status")

    def run(state, minute, name, fence):
        folder = str(tmp_path / f"metrics-{name}")
        spark.createDataFrame([row(state, minute)], columns).write.mode("append").parquet(folder)
        streams.stream_status(spark.readStream.schema(columns).parquet(folder), path, str(tmp_path / f"checkpoint-{name}"), available_now=True, fences={"hr": fence},
                              read_activation=lambda: spark.createDataFrame([("hr", fence)], "source_id string, fence bigint")).awaitTermination()

    run("RUNNING", 1, "old", 7)
    run("RUNNING", 2, "new", 8)
    with pytest.raises(Exception, match="SOURCE_FENCED"):
        run("ERROR", 3, "old", 7)
    assert [(r.state, r.updated_at.minute) for r in storage.read_snapshot(spark, path).collect()] == [("RUNNING", 2)]


def test_bounded_dedupe_keeps_late_events_and_little_state(spark, tmp_path):
    import time

    now = int(time.time() * 1000)
    day = 86_400_000
    parts = []
    for n in range(8):
        recent = [(f'{{"id":{n * 50 + i}}}', value(after={}, serial=n * 50 + i, millis=now)) for i in range(50)]
        old = [(f'{{"id":{9000 + i}}}', value(after={}, serial=9000 + i, millis=now - 30 * day)) for i in range(5)]
        parts.append(recent + recent[:10] + old)
    write_feed(spark, tmp_path / "feed", *parts)
    parsed = changes.parse_change_feed(inputs.stream_change_feed(spark, str(tmp_path / "feed"), max_files=1), source(spark))
    query = streams.stream_dedupe_bounded(parsed, str(tmp_path / "history"), str(tmp_path / "checkpoint"), horizon="200 milliseconds", available_now=True)
    query.awaitTermination()
    state = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.numInputRows]
    stored = storage.read_history(spark, str(tmp_path / "history"))
    assert stored.count() == 405 == stored.select("event_id").distinct().count()
    assert len(state) == 8 and max(state) <= 255, state
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_repaired_source_is_released_without_new_input(spark, tmp_path):
    import time

    feed(spark, *records(0, 3)).unionByName(feed(spark, *(records(10, 13) + [('{"id":50}', value(after={}, serial=50, table="Late"))]), tenant="OTHER")).coalesce(1).write.parquet(str(tmp_path / "feed"))
    allowed = [source(spark).unionByName(source(spark, tenant="OTHER"))]
    history_path, held_path = str(tmp_path / "history"), str(tmp_path / "held")
    query = streams.stream_isolated(inputs.stream_change_feed(spark, str(tmp_path / "feed")), lambda: allowed[0], history_path, held_path, str(tmp_path / "checkpoint"),
                                    retry_seconds=1, interval="1 second", wire_path=str(tmp_path / "wire"))
    schema = "key string, value string, destination string, captured_at timestamp"

    def until(done):
        deadline = time.time() + 90
        while not done():
            assert query.isActive and time.time() < deadline, query.exception()
            time.sleep(0.5)

    def size():
        return sum(f.stat().st_size for f in (tmp_path / "held").rglob("*.parquet"))

    try:
        until(lambda: storage.path_exists(spark, history_path) and ids(spark, history_path) == [0, 1, 2] and storage.held_connectors(spark, held_path))
        assert storage.read_held(spark, held_path, schema).count() == 4
        before, batch = size(), query.lastProgress.batchId
        until(lambda: query.lastProgress.batchId >= batch + 3)
        assert size() == before, "what waits is not written again"
        feed(spark, *records(13, 15), tenant="OTHER").unionByName(feed(spark, *records(3, 4))).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        until(lambda: ids(spark, history_path) == [0, 1, 2, 3])
        until(lambda: storage.read_held(spark, held_path, schema).count() == 6)
        # Nothing comes any more; the sources are repaired.
        allowed[0] = source(spark).unionByName(source(spark, tenant="OTHER", tables=("dbo.Contract", "dbo.Late")))
        until(lambda: ids(spark, history_path) == [0, 1, 2, 3, 10, 11, 12, 13, 14, 50])
        until(lambda: not storage.held_connectors(spark, held_path) and not list((tmp_path / "held").rglob("*.parquet")))
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "wire")).select("event_id").distinct().count() == 10


def test_reconciliation_reads_the_changes_range_only(spark, tmp_path):
    path = str(tmp_path / "history")
    both = source(spark).unionByName(source(spark, tenant="OTHER"))
    for n in range(4):
        rows = feed(spark, *month_records(10 + n, 0, 4)).unionByName(feed(spark, *month_records(10 + n, 0, 4), tenant="OTHER")) if n < 3 else feed(spark, *[(k, t.replace("0000000c:", "0000000C:")) for k, t in month_records(12, 6, 8)])
        storage.save_events(changes.parse_change_feed(rows, both), path, n, "stream")
    stored = storage.read_history(spark, path)
    raw = stored.filter("tenant_id = 'ACME' AND commit_lsn >= '0000000b'").select(lsn.lsn_bytes(F.col("commit_lsn")).alias("start_lsn"), lsn.lsn_bytes(F.col("change_lsn")).alias("seqval"), F.lit(2).alias("operation"))
    raw = raw.unionByName(spark.createDataFrame([(bytes(10), bytes(10), 2), (None, None, 2)], raw.schema)).persist()
    wanted = reconcile.changes_to_reconcile(raw, "ACME", "hr", "dbo", "Contract")
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    found = reconcile.reconcile_source(wanted.filter("commit_bytes > X'00000000000000000001'"), stored)
    assert [r.matches for r in found.collect()] == [1] * raw.filter("start_lsn > X'00000000000000000001'").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(tenant_id" in plan or "PartitionFilters: [(tenant_id" in plan and "EqualTo(source_id,hr)" in plan and "GreaterThanOrEqual(commit_lsn,0000000B" in plan
    assert sorted(r.matches for r in reconcile.reconcile_source(wanted, stored).collect())[:3] == [0, 0, 1]
    assert reconcile.reconcile_source(wanted.limit(0), stored).collect() == []


def test_a_search_by_path_reads_the_path_s_own_column(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "images")
    images = [{"status": "open" if i % 7 else "closed", "amount": i / 4, "deep": {"k": i % 3}, "text": f"{i} " * 100} for i in range(400)] + [{"status": None}, {"amount": "2.50"}, {}]
    rows = [(f'{{"id":{i}}}', value("u", image, image | {"status": "late"} if i % 11 == 0 else image, serial=i)) for i, image in enumerate(images)]
    stored = changes.parse_change_feed(feed(spark, *rows, ('{"id":999}', value(after={"amount": 2.50}, serial=999)), ('{"id":998}', value("d", {"deep": [1, 2]}, None, serial=998))), source(spark)).persist()
    for _ in range(2):  # a rerun replaces its own
        storage.append_images(stored, path, 0, "stream")
    read = storage.read_images(spark, path)
    assert read.count() == stored.count()
    for where, wanted in (("$.status", "closed"), ("$.status", "late"), ("$.amount", "2.5"), ("$.amount", "2.50"), ("$.deep.k", "1"), ("$.deep", "[1,2]"), ("$.deep[1]", "2"), ("$.none", "x")):
        plain = sorted(r.event_id for r in history.image_path_filter(stored, where, wanted).collect())
        assert sorted(r.event_id for r in history.image_path_filter(stored, where, wanted, read).collect()) == plain
    assert len(history.image_path_filter(stored, "$.status", "closed", read).collect()) == 58
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = read.filter(F.try_variant_get("after_image", "$.status", "string") == "closed").select("event_id")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "after_image:struct<0:string>" in plan and "before_image" not in plan.split("ReadSchema")[1]
    sizes, needed = 0, 0
    for file in (tmp_path / "images").rglob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        for k in range(group.num_columns):
            column = group.column(k)
            sizes += column.total_compressed_size if column.path_in_schema.startswith("after_image") else 0
            needed += column.total_compressed_size if column.path_in_schema.startswith(("after_image.typed_value.status", "after_image.metadata", "after_image.value")) else 0
    assert 0 < needed < 0.2 * sizes
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") in ("true", "false")


def test_control_tables_in_memory_are_measured_once(spark, tmp_path):
    from rowtrail.functions.sizing import bounded_broadcast

    def jobs(action):
        tracker, group = spark.sparkContext.statusTracker(), f"measured-{uuid.uuid4()}"
        spark.sparkContext.setJobGroup(group, group)
        action()
        spark.sparkContext.setJobGroup("none", "none")
        return len(tracker.getJobIdsForGroup(group))

    table = spark.createDataFrame([(i, "x") for i in range(50)], "id int, name string")
    assert jobs(lambda: bounded_broadcast(table.filter("id > 3"))) > 0
    assert jobs(lambda: bounded_broadcast(table.filter("id > 3"))) == 0
    assert jobs(lambda: bounded_broadcast(table.filter("id > 4"))) > 0
    assert jobs(lambda: bounded_broadcast(table.filter("id > 3"), max_rows=7)) > 0
    other = spark.createDataFrame([(i, "y") for i in range(50)], "id int, name string")
    assert jobs(lambda: bounded_broadcast(other.filter("id > 3"))) > 0
    table.write.parquet(str(tmp_path / "table"))
    for _ in range(2):  # files can change
        assert jobs(lambda: bounded_broadcast(spark.read.parquet(str(tmp_path / "table")))) > 0


def test_a_streamed_batch_writes_each_month_as_one_file(spark, tmp_path):
    """A stream's batch has adaptive execution off; without it every task would write every month."""
    write_feed(spark, tmp_path / "feed", [r for month in range(1, 7) for r in month_records(month, 0, 40)])
    path = tmp_path / "history"
    parsed = changes.parse_change_feed(inputs.stream_change_feed(spark, str(tmp_path / "feed")), source(spark))
    streams.stream_dedupe_bounded(parsed, str(path), str(tmp_path / "checkpoint"), "1 second", available_now=True).awaitTermination()
    assert storage.read_history(spark, str(path)).select("event_id").distinct().count() == 240
    assert len(list(path.rglob("occurred_month=*/*/*/*.parquet"))) == 6


def test_a_batch_is_computed_once_for_its_marks_and_rows(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def noted(text):
        seen.add(1)
        return text

    events = changes.parse_change_feed(feed(spark, *records(0, 20)), source(spark))
    marked = F.udf(noted, "string").asNondeterministic()
    storage.append_history(events.withColumn("commit_lsn", marked("commit_lsn")), str(tmp_path / "history"), 0)
    assert ids(spark, tmp_path / "history") == list(range(20)) and seen.value == 20


def _given_orders(spark, folder):
    """A folder with a table of orders and no other."""
    rows = [(k, 5, "OFP"[k % 3], 10.5 + k, dt.datetime(1996, 1 + k % 12, 3), "1-URGENT") for k in range(20)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_a_query_on_stored_orders_parses_no_other_feed(spark, tmp_path):
    folder = _given_orders(spark, tmp_path)
    stored = change_queries.stored_orders(spark, folder)
    assert stored.count() == change_queries.order_history(spark, folder).count() == 35
    assert {(r.stream_id, r.table_name) for r in stored.collect()} == {("orders", "orders")}
    path, there = change_queries._STORED[spark.sparkContext.applicationId, folder]
    assert there == {"orders"}
    # The other feed joins it in the same table once it is asked for.
    late = stored.limit(1).drop("occurred_month", "stream_id", "batch_id").withColumn("table_name", F.lit("events")).withColumn("event_id", F.lit("e"))
    storage.append_history(late, path, 0, "events")
    assert change_queries.stored_orders(spark, folder).count() == 35 and storage.read_history(spark, path).count() == 36


def test_replays_are_laid_out_beside_one_feed(spark, tmp_path):
    folder = _given_orders(spark, tmp_path)
    whole = change_queries.feeds.replayed_changes(spark, folder)
    assert whole._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    parts = [change_queries.feeds.replayed_changes(spark, folder, again) for again in (False, True)]
    assert sorted(whole.collect()) == sorted(parts[0].unionByName(parts[1]).collect())
    assert [p.count() for p in parts] == [35, 8] and parts[1].columns == whole.columns


def test_two_streams_publish_from_one_parse(spark, tmp_path, monkeypatch):
    folder, parsed = _given_orders(spark, tmp_path), []
    parse = change_queries.order_history
    monkeypatch.setattr(change_queries, "order_history", lambda *given: parsed.append(given) or parse(*given))
    published = QUERIES["publish_wire_two_streams"](spark, folder)
    assert published.count() == published.select("event_id").distinct().count() == 35 and len(parsed) == 1


def _nothing_in_memory(monkeypatch):
    """Whole rows must not be persisted: beyond the memory they would lie on local disks undensely, and be read back a hundred blocks at a time."""
    def refuse(self, *args):
        raise AssertionError("persisted")

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", refuse)


def test_a_saved_batch_is_not_held_in_memory(spark, tmp_path, monkeypatch):
    _nothing_in_memory(monkeypatch)
    path = str(tmp_path / "history")
    events = changes.parse_change_feed(feed(spark, *records(0, 8), *records(5, 12)), source(spark))
    saved = storage.save_events(events, path, 0)
    assert saved.columns == events.columns and sorted(r.event_serial_no for r in saved.collect()) == list(range(12))
    storage.append_history(changes.parse_change_feed(feed(spark, *records(12, 14)), source(spark)), path, 1)
    assert ids(spark, path) == list(range(14))
    assert not list((tmp_path / "history" / storage._KEPT).rglob("*.parquet"))


def test_pruning_after_two_deliveries_holds_nothing_in_memory(spark, tmp_path, monkeypatch):
    _nothing_in_memory(monkeypatch)
    folder = _given_orders(spark, tmp_path)
    late = sum(r.occurred_at >= dt.datetime(1996, 1, 1) for r in change_queries.order_history(spark, folder).collect())
    assert QUERIES["retention_prune_write"](spark, folder).count() == late == 35


def test_a_large_batch_is_compared_and_written_in_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "STEP_ROWS", 4)
    path = str(tmp_path / "history")
    months = [1704067200000 + 31 * 86400000 * k for k in range(5)]
    rows = [(f'{{"id":{i}}}', value(after={"v": i}, serial=i, millis=months[i % 5])) for i in range(20)]

    def parsed(*given):
        return changes.parse_change_feed(feed(spark, *given), source(spark))

    for _ in range(2):  # the second time with the receipt there
        saved = storage.save_events(parsed(*rows, *rows[3:9]), path, 0)
        assert sorted(r.event_serial_no for r in saved.collect()) == ids(spark, path) == list(range(20))
    more = [(f'{{"id":{i}}}', value(after={"v": i}, serial=i, millis=months[0])) for i in range(20, 23)]
    with storage.at_rest(parsed(*rows, *more, *more), path, 1) as kept:
        saved = storage.save_events(kept, path, 1)
        assert saved.columns == parsed(*more).columns and sorted(r.event_serial_no for r in saved.collect()) == [20, 21, 22]
    assert ids(spark, path) == list(range(23))


def test_months_are_compacted_group_by_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "COMPACTED_BYTES", 1)
    path, passes, ready = str(tmp_path / "history"), [], storage._ready
    monkeypatch.setattr(storage, "_ready", lambda session, staged, places: passes.append({p.split("/")[1] for p in places}) or ready(session, staged, places))
    folder = _given_orders(spark, tmp_path)
    events = change_queries.order_history(spark, folder)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for part in (0, 1):
        storage.append_history(events.filter(half == part), path, part)
    before = sorted(r.event_id for r in storage.read_history(spark, path).collect())
    folders = len({str(f.parent) for f in (tmp_path / "history").rglob("occurred_month=*/*/*/*.parquet")})
    assert storage.compact_history(spark, path, dt.date(2100, 1, 1)) == folders
    assert len(passes) == 12 and all(len(months) == 1 for months in passes)
    after = storage.read_history(spark, path)
    assert sorted(r.event_id for r in after.collect()) == before and {(r.stream_id, r.batch_id) for r in after.collect()} == {(storage.COMPACTED, 0)}


@pytest.mark.parametrize("name", ["history_compact", "publish_wire_after_compaction"])
def test_batches_before_and_after_compaction_come_from_one_parse(spark, tmp_path, monkeypatch, name):
    _nothing_in_memory(monkeypatch)
    folder = _given_orders(spark, tmp_path)
    kept = []
    rest = storage.at_rest
    monkeypatch.setattr(storage, "at_rest", lambda rows, *given: kept.append(storage._ROW not in rows.columns) or rest(rows, *given))
    found = QUERIES[name](spark, folder)
    assert found.count() == found.select("event_id").distinct().count() == 35
    assert kept.count(True) == 1 and len(kept) > 2


def test_held_sources_are_not_held_in_memory(spark, tmp_path, monkeypatch):
    _nothing_in_memory(monkeypatch)
    broken = feed(spark, *records(20, 22), ('{"id":9}', "broken")).withColumn("destination", F.lit("capture-T2-other.shop.dbo.orders"))
    feed(spark, *records(0, 3)).unionByName(broken).coalesce(1).write.parquet(str(tmp_path / "feed"))
    streams.stream_quarantine(inputs.stream_change_feed(spark, str(tmp_path / "feed")), source(spark), str(tmp_path / "history"), str(tmp_path / "held"),
                              str(tmp_path / "checkpoint"), available_now=True).awaitTermination()
    assert ids(spark, tmp_path / "history") == [0, 1, 2]
    assert storage.read_snapshot(spark, str(tmp_path / "held")).count() == 3
    assert not list((tmp_path / "history" / storage._KEPT).rglob("*.parquet"))
