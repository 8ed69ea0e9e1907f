"""Continuous change feeds to history.

One micro-batch is parsed, checked against the fence, de-duplicated, written and published before its
offsets commit. A crash in between runs the batch again: its partitions are replaced, its events exist once.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtrail.functions import names
from rowtrail.functions.sizing import bounded_broadcast
from rowtrail.operators import changes, history
from rowtrail.operators.monitor import status_merge
from rowtrail.operators.wire import wire_decode
from rowtrail.sources import storage


SourceFenced = storage.SourceFenced


def _start(writer, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id Spark gave the stream when its checkpoint was made; a new checkpoint is a new stream."""
    return json.loads(storage.read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"]


def _captured(batch: DataFrame) -> DataFrame:
    """Give a batch one capture time where its records carry none."""
    if "captured_at" in batch.columns:
        return batch
    return batch.withColumn("captured_at", F.lit(dt.datetime.now(dt.timezone.utc)))


def _check_fence(activation: DataFrame | None, fences: dict[str, int] | None) -> None:
    """``fences`` names the fence each source was claimed with; a different current one stops the batch."""
    if activation is None or not fences:
        return
    claimed = activation.sparkSession.createDataFrame(list(fences.items()), "source_id string, fence bigint")
    if history.fence_guard(claimed, activation).filter(F.col("error_code").isNotNull()).limit(1).count():
        raise SourceFenced(history.SOURCE_FENCED)


def stream_history(feed: DataFrame, sources: DataFrame, history_path: str, checkpoint: str, wire_path: str | None = None,
                   read_activation=None, fences: dict[str, int] | None = None, available_now: bool = False,
                   interval: str = "1 second", heartbeat_table: str = names.HEARTBEAT_TABLE) -> StreamingQuery:
    """At-least-once feed to exactly one history row per event.

    A broken record fails the query at the same batch on every restart. ``read_activation`` returns the
    current activation table and is asked before each batch.
    """
    def fence() -> None:
        _check_fence(read_activation() if read_activation else None, fences)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        fence()
        parsed = changes.parse_change_feed(_captured(batch), sources, on_error="fail", heartbeat_table=heartbeat_table)
        stream_id = _stream_id(batch, checkpoint)
        storage.drop_receipts(batch.sparkSession, history_path, stream_id, batch_id)
        with storage.at_rest(parsed, history_path, batch_id, stream_id) as events:
            saved = storage.save_events(events, history_path, batch_id, stream_id, fence)
            if wire_path is not None:
                storage.publish_wire(saved.select(*changes.HISTORY_COLUMNS), sources, wire_path, batch_id, stream_id, fence)

    return _start(feed.writeStream.foreachBatch(deliver), checkpoint, available_now, interval)


def wire_subscribe(wire: DataFrame, sources: DataFrame, history_path: str, checkpoint: str, read_activation=None, fences: dict[str, int] | None = None,
                   available_now: bool = False, interval: str = "1 second", heartbeat_table: str = names.HEARTBEAT_TABLE) -> StreamingQuery:
    """A stream of wire bodies to a history of its own: read, verified, checked against the fence, saved once each.

    A body that cannot be trusted fails the query at the same batch on every restart.
    """
    def fence() -> None:
        _check_fence(read_activation() if read_activation else None, fences)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        fence()
        read = wire_decode(batch.select("body"), sources, heartbeat_table)
        trusted = F.when(F.col("error_code").isNull(), F.col("event_id")).otherwise(F.raise_error(F.col("error_code")).cast("string"))
        events = read.withColumn("event_id", trusted).select(*changes.HISTORY_COLUMNS)
        stream_id = _stream_id(batch, checkpoint)
        storage.drop_receipts(batch.sparkSession, history_path, stream_id, batch_id)
        storage.save_events(events, history_path, batch_id, stream_id, fence)

    return _start(wire.writeStream.foreachBatch(deliver), checkpoint, available_now, interval)


def stream_dedupe(events: DataFrame) -> DataFrame:
    """Events once each, however late they come.

    There is no watermark, since one would drop late events; the state holds every id seen. Where that is too much, use
    :func:`stream_dedupe_bounded`, or the history comparison of :func:`stream_history`, which needs no state.
    """
    return events.dropDuplicates(["event_id"])


#: Fixed: Spark's state store that keeps state on disk and not on the heap.
_STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_dedupe_bounded(events: DataFrame, history_path: str, checkpoint: str, horizon: str = "1 hour", available_now: bool = False, interval: str = "1 second",
                          read_activation=None, fences: dict[str, int] | None = None) -> StreamingQuery:
    """Events once each in a history, however late they come, with state for the last ``horizon`` only.

    The state holds the ids that arrived within the horizon, by the time of arrival, so no event is ever too late for it. What it lets through is new, or a copy
    of something that arrived longer ago; such a copy has occurred longer ago too. So events that occurred within the horizon are new without a
    look at the history, and only older ones are compared with it. Clocks of sources may be ahead of this one; if they may be
    behind it by more than the horizon, more events are compared, not fewer.
    """
    spark = events.sparkSession
    unique = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(["event_id"])
    late = F.col("occurred_at") < F.col("_arrived") - F.expr(f"INTERVAL {horizon}")

    def deliver(batch: DataFrame, batch_id: int) -> None:
        def fence() -> None:
            _check_fence(read_activation() if read_activation else None, fences)

        fence()
        # What occurred lately has passed the state and needs no comparison; the mark is taken along as a column of its own.
        rows = batch.withColumn("_late", late).drop("_arrived")
        stream_id = _stream_id(batch, checkpoint)
        storage.drop_receipts(batch.sparkSession, history_path, stream_id, batch_id)
        storage.save_events(rows, history_path, batch_id, stream_id, fence, F.col("_late"))

    name, provider = _STATE_STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        return _start(unique.writeStream.foreachBatch(deliver), checkpoint, available_now, interval)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stream_progress(feed: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Greatest position per source; heartbeats count. Write it in update (or complete) mode."""
    return changes.source_progress(changes.examine(feed, sources, heartbeat_table))


def stream_status(metrics: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "30 seconds",
                  read_activation=None, fences: dict[str, int] | None = None, keep_seconds: float = 3600) -> StreamingQuery:
    """Status row per source, carried forward over gaps; batch N writes snapshot N from the one before it.

    Of several rows of a source in one batch the newest decides. With ``fences`` a replaced reader's snapshots never count: a snapshot's
    fence is the sum of its sources' fences, which every new claim raises. Snapshots older than ``keep_seconds`` go, but for the newest.
    """
    fence = sum(fences.values()) if fences else None

    def merge(batch: DataFrame, batch_id: int) -> None:
        _check_fence(read_activation() if read_activation else None, fences)
        rest = [c for c in batch.columns if c not in ("source_id", "updated_at")]
        newest = batch.groupBy("source_id").agg(F.max(F.struct("updated_at", *rest)).alias("s")).select("source_id", "s.*")
        storage.write_status(newest.select(*batch.columns), path, batch_id, fence, _stream_id(batch, checkpoint))
        storage.drop_old_versions(batch.sparkSession, path, keep_seconds)

    return _start(metrics.writeStream.foreachBatch(merge), checkpoint, available_now, interval)


def stream_quarantine(feed: DataFrame, sources: DataFrame, history_path: str, held_path: str, checkpoint: str,
                      available_now: bool = False, interval: str = "1 second", heartbeat_table: str = names.HEARTBEAT_TABLE,
                      wire_path: str | None = None, read_activation=None, fences: dict[str, int] | None = None) -> StreamingQuery:
    """Like :func:`stream_history`, but a source with a broken record is held while the others go on.

    The whole of what is held is written anew with each batch; :func:`stream_isolated` writes only what comes and tries again by time. All of a failing source's records wait, in ``held_path``, and are tried again with the next batch;
    none is skipped. Batch N reads the held snapshot before N and writes snapshot N.
    """
    def fence() -> None:
        _check_fence(read_activation() if read_activation else None, fences)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        fence()
        spark = batch.sparkSession
        incoming = _captured(batch)
        waiting = storage.read_snapshot(spark, held_path, below=batch_id)
        records = incoming if waiting is None else waiting.select(*incoming.columns).unionByName(incoming)
        stream_id = _stream_id(batch, checkpoint)
        storage.drop_receipts(spark, history_path, stream_id, batch_id)
        # Of what was examined, the fields that history needs and the record itself go to rest; kept in memory, batches of such wide rows exceed it.
        needed = [*incoming.columns, *[c for c in changes.EXAMINED_COLUMNS if c not in incoming.columns]]
        with storage.at_rest(changes.examine(records, sources, heartbeat_table).select(*needed), history_path, batch_id, stream_id, "examined") as examined:
            broken = F.col("verdict").isNotNull() & ~changes._is_drop(F.col("verdict"))
            # A record without a destination has no connector; all such records are one source, and compare as equal.
            failing = examined.filter(broken).select(F.col("_connector").alias("_failing"), F.lit(True).alias("_held")).distinct()
            flagged = examined.join(bounded_broadcast(failing), F.col("_connector").eqNullSafe(F.col("_failing")), "left")
            storage.write_snapshot(flagged.filter("_held").select(*incoming.columns), held_path, batch_id)
            good = flagged.filter("_held IS NULL").select(*needed)
            with storage.at_rest(changes.history_events(good), history_path, batch_id, stream_id) as events:
                saved = storage.save_events(events, history_path, batch_id, stream_id, fence)
                if wire_path is not None:
                    storage.publish_wire(saved.select(*changes.HISTORY_COLUMNS), sources, wire_path, batch_id, stream_id, fence)

    return _start(feed.writeStream.foreachBatch(deliver), checkpoint, available_now, interval)


def with_ticks(feed: DataFrame, every_seconds: int) -> DataFrame:
    """A feed with a row ``_tick`` every so many seconds, so that batches come without input too; other rows have ``_tick`` null."""
    ticks = feed.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().filter(F.col("value") % every_seconds == 0)
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in feed.dtypes]
    return feed.withColumn("_tick", F.lit(None).cast("boolean")).unionByName(ticks.select(*empty, F.lit(True).alias("_tick")))


def stream_isolated(feed: DataFrame, sources, history_path: str, held_path: str, checkpoint: str, retry_seconds: int = 10,
                    available_now: bool = False, interval: str = "1 second", heartbeat_table: str = names.HEARTBEAT_TABLE,
                    wire_path: str | None = None, read_activation=None, fences: dict[str, int] | None = None) -> StreamingQuery:
    """Like :func:`stream_history`, but a source with a broken record waits while the others go on, and is tried again by time.

    All of a failing source's records wait in a log that only grows by what comes; none is skipped, and none overtakes another of its source. Every
    ``retry_seconds`` what waits is examined again, without new input too, and delivered with all that has come since once no record is broken.
    ``sources`` may be a function that reads the current sources, so a repair of them is seen. Batch N reads the log and the marks of batches before
    N and writes its own, so a batch that runs again does the same.
    """
    read_sources = sources if callable(sources) else lambda: sources
    columns = feed.columns

    def fence() -> None:
        _check_fence(read_activation() if read_activation else None, fences)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        fence()
        spark, current = batch.sparkSession, read_sources()
        storage.drop_released(spark, held_path, batch_id)
        waiting = storage.held_connectors(spark, held_path, batch_id)
        incoming = _captured(batch.filter("_tick IS NULL").select(*columns))
        retried = bool(waiting) and not batch.filter("_tick").isEmpty()
        records = incoming.withColumn("_new", F.lit(True))
        if retried:
            records = records.unionByName(storage.read_held(spark, held_path, incoming.schema, batch_id).withColumn("_new", F.lit(False)))
        examined = changes.examine(records, current, heartbeat_table).persist()
        try:
            broken = F.col("verdict").isNotNull() & ~changes._is_drop(F.col("verdict"))
            # One row a failing source; a record without a destination has no connector, and all such are one source.
            failing = {storage.connector_folder(row["_connector"]) for row in examined.filter(broken).select("_connector").distinct().collect()}
            kept = failing if retried else failing | waiting.keys()
            held_now = F.lit(False)
            for row in examined.select("_connector").distinct().collect():
                if storage.connector_folder(row["_connector"]) in kept:
                    held_now = held_now | F.col("_connector").eqNullSafe(row["_connector"])
            good = examined.filter(~held_now)
            stream_id = _stream_id(batch, checkpoint)
            storage.drop_receipts(spark, history_path, stream_id, batch_id)
            saved = storage.save_events(changes.history_events(good), history_path, batch_id, stream_id, fence)
            if wire_path is not None:
                storage.publish_wire(saved.select(*changes.HISTORY_COLUMNS), current, wire_path, batch_id, stream_id, fence)
            fence()
            if kept:
                storage.hold(examined.filter(held_now & F.col("_new")).select(*incoming.columns, F.col("_connector").alias("connector")), held_path, batch_id)
            if retried and (released := waiting.keys() - kept):
                storage.release(spark, held_path, batch_id, released)
        finally:
            examined.unpersist()

    return _start(with_ticks(feed, retry_seconds).writeStream.foreachBatch(deliver), checkpoint, available_now, interval)
