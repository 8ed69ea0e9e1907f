"""Durable tables on a shared file system: history, wire events, status and registry snapshots.

A micro-batch owns the ``stream_id=S/batch_id=N`` partitions it writes, so running it again replaces exactly its
own rows, and streams with checkpoints of their own never meet. Snapshots are new ``version=N`` folders; readers take the greatest finished one.

Three small things lie beside the history, hidden from its readers, so that a batch opens what its own rows name and not the whole table:

* marks, one small file a stream: the greatest commit position written of each source. An event beyond all marks of its source is new.
* receipts, one a batch: the ids of its new events, written before the history. A batch that runs again, whatever happened to
  its partitions meanwhile, finds here what it had to deliver.
* rewritten partitions until they are in place.
* a batch's rows while it is saved: computed once, written densely, and read for what each step needs.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.operators import history as ops
from rowtrail.operators.monitor import status_merge
from rowtrail.operators.wire import wire_encode
from rowtrail.session import run_name

HISTORY_SCHEMA = (
    "event_id string, source_id string, schema_name string, table_name string, operation string, occurred_at timestamp, "
    "captured_at timestamp, record_key string, before_json string, after_json string, changed_properties string, "
    "commit_lsn string, change_lsn string, event_serial_no bigint, tenant_id string, occurred_month date, stream_id string, batch_id bigint"
)
_STORED = {part.split()[0] for part in HISTORY_SCHEMA.split(", ")}
_PARTITIONS = ["tenant_id", "occurred_month", "stream_id", "batch_id"]
#: Owner of what is written outside a stream.
BY_HAND = "by-hand"
#: Owner of a closed month's rows once they are brought together.
COMPACTED = "compacted"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history table with its partition columns; empty before the first write."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def _partition(column: str, value: str | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None or value == '' else _escaped(value)}"


def _escaped(value: str) -> str:
    """A partition's value as Spark writes it in a folder's name."""
    # Fixed: the characters that partition folders escape.
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 or c in '"#%\'*/:=?\\{[]^' else c for c in value)


def read_places(spark: SparkSession, path: str, places: Iterable[str]) -> DataFrame:
    """The history in the given folders below its root; only these are listed."""
    there = [f"{path}/{place}" for place in sorted(places) if path_exists(spark, f"{path}/{place}")]
    if not there:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).option("basePath", path).parquet(*there)


#: The session of a stream's batch has adaptive execution off, and a rebalance would be left out there: every task would write every month.
_ADAPTIVE = ("spark.sql.adaptive.enabled", "true")
#: A step's shuffle files go when it ends, not when the driver happens to collect garbage.
_CLEANING = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
#: Files of whole rows and of ids: half of an id's hexadecimal digits carry nothing, which only an entropy coder leaves out.
_DENSE = {"compression": "zstd"}


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    """A setting for one step."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Beside the history: rows of the batches that are being saved.
_KEPT = "_kept"
#: A row's number among those at rest.
_ROW = "_row"
#: Rows that one step shuffles: beyond them a batch is compared and written in several steps, so that their shuffle files need not lie side by side.
STEP_ROWS = 32_000_000


@contextmanager
def at_rest(rows: DataFrame, path: str, batch_id: int, stream_id: str = BY_HAND, name: str = "rows"):
    """A batch's rows in files beside the history at ``path`` while it is saved, each with a number of its own.

    They are computed once. What a step does not need of them it does not read; nothing of them is held in memory. A rerun after a crash replaces what was left.
    """
    if _ROW in rows.columns:
        yield rows
        return
    spark = rows.sparkSession
    place = _kept(path, stream_id, batch_id, name)
    numbered = rows.withColumn(_ROW, F.monotonically_increasing_id())
    try:
        with _setting(spark, *_CLEANING):
            numbered.write.mode("overwrite").options(**_DENSE).parquet(place)
        yield spark.read.schema(numbered.schema).parquet(place)
    finally:
        fs, folder = _file_system(spark, _kept(path, stream_id, batch_id))
        fs.delete(folder, True)


def _kept(path: str, stream_id: str, batch_id: int, *names: str) -> str:
    return "/".join([path, _KEPT, _escaped(stream_id), str(batch_id), *names])


def _steps(rows: DataFrame) -> int:
    return -(-rows.count() // STEP_ROWS) or 1


def _shares(steps: int, *columns: str) -> list[Column]:
    """Conditions that deal rows to the steps by a hash of these columns."""
    return [F.pmod(F.xxhash64(*columns), F.lit(steps)) == n for n in range(steps)] if steps > 1 else [F.lit(True)]


def append_history(batch: DataFrame, path: str, batch_id: int, stream_id: str = BY_HAND) -> None:
    """Write a batch's new events to its own partitions.

    The rebalance lets adaptive execution split a hot tenant's month and merge small ones; files are sorted
    so that searches by time skip row groups. The batch is read twice, for its marks and for its rows, and so computed once and kept between.
    """
    with at_rest(batch.select(*[c for c in batch.columns if c in _STORED or c == _ROW]), path, batch_id, stream_id) as rows:
        highest = {(s["tenant_id"], s["source_id"]): s["high"] for s in ops.position_spans(rows)}
        _append(rows, highest, path, batch_id, stream_id)


def _append(batch: DataFrame, highest: dict, path: str, batch_id: int, stream_id: str, steps: int | None = None) -> None:
    """Marks first: one that is ahead of the history costs a comparison, one behind it would cost a second copy.

    Each step writes whole partitions, so a rerun replaces what an earlier run wrote.
    """
    _write_marks(batch.sparkSession, path, stream_id, highest)
    keys = ["tenant_id", "occurred_month"]
    dated = batch.select(*[c for c in batch.columns if c in _STORED]).withColumn("occurred_month", F.trunc("occurred_at", "month"))
    rows = dated.withColumn("stream_id", F.lit(stream_id)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    with _setting(batch.sparkSession, *_ADAPTIVE), _setting(batch.sparkSession, *_CLEANING):
        for share in _shares(steps or _steps(batch), *keys):
            (
                rows.filter(share).hint("rebalance", *keys).sortWithinPartitions(*keys, "occurred_at", "event_id")
                .write.mode("overwrite").options(**_DENSE).option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTITIONS).parquet(path)
            )


#: Fixed: Spark's settings that lay a VARIANT's fields out as columns of their own.
_SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")


def append_images(events: DataFrame, path: str, batch_id: int, stream_id: str = BY_HAND) -> None:
    """Write a batch's row images as VARIANT beside its history, for searches by a path: each common field becomes a column, and a search reads one.

    Partitions are those of the history, and a rerun replaces its own. Call it with the events that :func:`save_events` returns.
    """
    spark = events.sparkSession
    rows = events.select(
        "event_id", "tenant_id", *[F.try_parse_json(f"{side}_json").alias(f"{side}_image") for side in ("before", "after")],
        F.trunc("occurred_at", "month").alias("occurred_month"), F.lit(stream_id).alias("stream_id"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    before = {name: spark.conf.get(name, None) for name in _SHREDDING}
    try:
        for name in _SHREDDING:
            spark.conf.set(name, "true")
        rows.hint("rebalance", "tenant_id", "occurred_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PARTITIONS).parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(event_id, before_image, after_image) with the history's partition columns."""
    schema = "event_id string, before_image variant, after_image variant, tenant_id string, occurred_month date, stream_id string, batch_id bigint"
    return spark.read.schema(schema).parquet(path)


#: Beside the history: greatest positions of each stream, and new events of each batch.
_MARKS = "_marks"
_RECEIPTS = "_receipts"


def _numbered(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in _listed(spark, path) if name.isdigit())


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _read_marks(spark: SparkSession, path: str, stream: str) -> dict[tuple, str]:
    versions = _numbered(spark, f"{path}/{_MARKS}/{stream}")
    return {tuple(key): high for *key, high in json.loads(read_text(spark, f"{path}/{_MARKS}/{stream}/{versions[-1]}"))} if versions else {}


def read_marks(spark: SparkSession, path: str) -> dict[tuple, str] | None:
    """Greatest commit position ever written by any stream, by (tenant, source); None for a history without marks.

    One entry a source, in one small file a stream.
    """
    streams = _listed(spark, f"{path}/{_MARKS}")
    if not streams:
        return None
    marks: dict[tuple, str] = {}
    for stream in streams:
        for key, high in _read_marks(spark, path, stream).items():
            marks[key] = max(high, marks.get(key, high))
    return marks


def _write_marks(spark: SparkSession, path: str, stream_id: str, highest: dict[tuple, str]) -> None:
    """Raise a stream's marks. The new file is complete before it gets its name, and the older ones go after that."""
    folder = f"{path}/{_MARKS}/{_escaped(stream_id)}"
    before = _read_marks(spark, path, _escaped(stream_id))
    marks = before | {key: max(high, before.get(key, high)) for key, high in highest.items()}
    versions = _numbered(spark, folder)
    if versions and marks == before:
        return
    fs, aside = _file_system(spark, f"{folder}/_{run_name()}")
    stream = fs.create(aside, True)
    stream.write(json.dumps([[*key, high] for key, high in marks.items()]).encode())
    stream.close()
    if not fs.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{(versions or [-1])[-1] + 1}")):
        raise RuntimeError(f"could not put the marks of {stream_id} in place")
    for version in versions[:-1]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{version}"), False)


def _receipt(path: str, stream_id: str, batch_id: int) -> str:
    return f"{path}/{_RECEIPTS}/{_escaped(stream_id)}/{batch_id}"


def drop_receipts(spark: SparkSession, path: str, stream_id: str, below: int) -> None:
    """Remove the receipts of a stream's batches that will not run again: those before the one that runs."""
    folder = f"{path}/{_RECEIPTS}/{_escaped(stream_id)}"
    for number in _numbered(spark, folder):
        if number < below:
            fs, old = _file_system(spark, f"{folder}/{number}")
            fs.delete(old, True)


def _stored_copies(events: DataFrame, path: str, own: Column, spans: list, share: Column | None = None) -> DataFrame:
    """Ids of the stored history, outside the batch's own partitions, that may be ids of these events (all of one ``share`` of the ids, if given).

    First the tenants' months that the events name are opened. An event's copies share its position but need not share its time, so those
    not found there are looked for in all months of their tenants. Both times each source's range of positions skips row groups.
    """
    spark = events.sparkSession
    near = ops.in_spans(spans) if share is None else ops.in_spans(spans) & share
    months = {f"{_partition('tenant_id', s['tenant_id'])}/{_partition('occurred_month', m and str(m))}" for s in spans for m in s["months"]}
    found = read_places(spark, path, months).filter(~own & near).select("event_id")
    rest = events.join(found, "event_id", "left_anti").select("tenant_id").distinct()
    tenants = {_partition("tenant_id", row["tenant_id"]) for row in rest.collect()}
    return read_places(spark, path, tenants).filter(~own & near).select("event_id").unionByName(found) if tenants else found


class BatchChanged(ValueError):
    """A batch id that was used before came again with other events."""


def _same_batch(events: DataFrame, receipt: str, path: str, own: Column, spans: list) -> None:
    """Refuse a used batch id with events that are neither in its receipt nor stored: its partitions belong to the earlier ones."""
    others = events.join(events.sparkSession.read.schema("event_id string").parquet(receipt), "event_id", "left_anti").select(*events.columns)
    if not others.isEmpty() and not others.join(_stored_copies(others, path, own, spans), "event_id", "left_anti").isEmpty():
        raise BatchChanged("this batch id was saved with other events; give the batch a new one")


def _finished(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def _left_out(rows: DataFrame, place: str) -> DataFrame:
    """Write the numbers of some rows aside."""
    spark = rows.sparkSession
    with _setting(spark, *_ADAPTIVE), _setting(spark, *_CLEANING):
        rows.select(_ROW).write.mode("overwrite").options(**_DENSE).parquet(place)
    return spark.read.schema(f"{_ROW} bigint").parquet(place)


def _without(rows: DataFrame, *outs: DataFrame) -> DataFrame:
    """Rows but for those left out; where that is none or all, nothing is joined."""
    for out in outs:
        gone = out.count()
        if gone:
            rows = rows.join(out, _ROW, "left_anti").select(*rows.columns) if gone < rows.count() else rows.filter(F.lit(False))
    return rows


def _later_copies(rows: DataFrame) -> DataFrame:
    """Rows that are not the first of their event.

    The ids are counted by their hash first, and only those that may come twice are looked at: of a batch without copies no more is shuffled than hashes.
    """
    hashed = F.xxhash64("event_id").alias("_hash")
    twice = rows.groupBy(hashed).agg(F.count(F.lit(1)).alias("_times")).filter(F.col("_times") > 1).select("_hash")
    some = rows.select(hashed, _ROW, "event_id", *ops.COPY_ORDER).join(twice, "_hash", "left_semi")
    return some.join(ops.first_copies(some).select(_ROW), _ROW, "left_anti")


def save_events(events: DataFrame, path: str, batch_id: int, stream_id: str = BY_HAND, before_write: Callable[[], None] | None = None, compare: Column | None = None) -> DataFrame:
    """De-duplicate a batch against the rest of the history and append what is new; returns the batch's new events.

    Events beyond all marks of their source are new without a look at the history; the others are compared, and the batch's own partitions are
    left out of the comparison, else a rerun would find itself there. What a batch delivers is decided once and kept in its
    receipt: a rerun returns the same events even if compaction has moved them since. ``before_write`` (a fence check) may still stop it.
    ``compare`` names the events that may be stored already, where the caller knows that the others can't be.

    The batch lies at rest meanwhile, and what is decided is the numbers of the rows that are left out, from their ids and positions alone; whole rows
    are read when they are written. Events that the caller has :func:`at_rest` are returned from there.
    """
    spark = events.sparkSession
    own = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
    receipt = _receipt(path, stream_id, batch_id)
    ids = spark.read.schema("event_id string")
    with at_rest(events, path, batch_id, stream_id) as rows:
        # Beside the rows, so that whoever laid them to rest takes both away.
        beside = next(iter(rows.inputFiles()), f"{_kept(path, stream_id, batch_id)}/rows/").rsplit("/", 2)[0]

        def aside(name: str) -> str:
            return f"{beside}/{name}-{_escaped(stream_id)}-{batch_id}"

        def joined(chosen: DataFrame, stored: Callable[[Column], DataFrame], how: str, name: str) -> DataFrame:
            """Numbers of rows with (or without) their id among others, found share by share of the ids."""
            shares = _shares(steps, "event_id")
            for n, share in enumerate(shares):
                part = chosen.filter(share)
                _left_out(part.join(stored(share), "event_id", how), f"{aside(name)}/share={n}")
            return spark.read.schema(f"{_ROW} bigint").parquet(*[f"{aside(name)}/share={n}" for n in range(len(shares))])

        spans = ops.position_spans(rows)
        steps = _steps(rows)
        copies = _left_out(_later_copies(rows), aside("copies"))
        narrow = _without(rows.select(_ROW, "event_id", "tenant_id", "source_id", "commit_lsn", *([compare.alias("_compared")] if compare is not None else [])), copies)
        if _finished(spark, receipt):
            if stream_id == BY_HAND:
                _same_batch(narrow, receipt, path, own, spans)
            others = joined(narrow, lambda share: ids.parquet(receipt).filter(share), "left_anti", "others")
            again = _without(narrow, others)
            stored = joined(again, lambda share: _stored_copies(again.filter(share), path, own, spans, share), "left_semi", "stored")
            delivered = _without(rows, copies, others)
            fresh = _without(delivered, stored)
        else:
            outs = [copies]
            marks = read_marks(spark, path)
            behind = [s for s in spans if marks is None or s["low"] <= marks.get((s["tenant_id"], s["source_id"]), "")]
            if behind:
                maybe = narrow.filter(ops.in_spans([s | {"high": min(s["high"], (marks or {}).get((s["tenant_id"], s["source_id"]), s["high"]))} for s in behind]))
                maybe = maybe if compare is None else maybe.filter("_compared")
                outs.append(joined(maybe, lambda share: _stored_copies(maybe.filter(share), path, own, behind, share), "left_semi", "stored"))
            delivered = fresh = _without(rows, *outs)
            if before_write is not None:
                before_write()
            with _setting(spark, *_ADAPTIVE), _setting(spark, *_CLEANING):
                _without(narrow, *outs[1:]).select("event_id").write.mode("overwrite").options(**_DENSE).parquet(receipt)
        if before_write is not None:
            before_write()
        _append(fresh, {(s["tenant_id"], s["source_id"]): s["high"] for s in spans}, path, batch_id, stream_id, steps)
    if _ROW in events.columns:
        return delivered.drop(_ROW)
    return ops.first_copies(events).join(ids.parquet(receipt), "event_id", "left_semi").select(*events.columns)


def publish_wire(batch: DataFrame, sources: DataFrame, path: str, batch_id: int, stream_id: str = BY_HAND, before_write: Callable[[], None] | None = None) -> None:
    """Write the batch's wire events to its own partition, for any number of independent readers; ``before_write`` may still stop it."""
    if before_write is not None:
        before_write()
    (
        wire_encode(batch, sources).withColumn("stream_id", F.lit(stream_id)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream_id", "batch_id").parquet(path)
    )


class SourceFenced(RuntimeError):
    """The activation has moved on to another writer; this one must stop."""


#: Fence of a snapshot written without one.
NO_FENCE = -1


def _snapshots(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """Finished snapshots by (fence, version), in that order: what a fenced-out writer still finishes never counts as the newest."""
    folders = {NO_FENCE: path} | {int(name.split("=", 1)[1]): f"{path}/{name}" for name in _listed(spark, path) if name.startswith("fence=")}
    versions = {(fence, int(name.split("=", 1)[1])): f"{folder}/{name}" for fence, folder in folders.items() for name in _listed(spark, folder) if name.startswith("version=")}
    return {key: folder for key, folder in sorted(versions.items()) if _finished(spark, folder)}


def _before(found: dict, below: int | None, fence: int) -> list[tuple[int, int]]:
    return [key for key in found if below is None or key < (fence, below)]


def latest_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """Version of the newest finished snapshot (optionally below a bound), null when there is none."""
    found = [key for key in _snapshots(spark, path) if below is None or key[1] < below]
    return max(found)[1] if found else None


def _claim(spark: SparkSession, path: str, version: int, fence: int, writer: str | None) -> None:
    """Make a version this writer's own, or refuse: to one whose fence is not the greatest any more, and to the second of two with the same fence."""
    claims = f"{path}/fence={fence}/_claims"
    fs, folder = _file_system(spark, claims)
    fs.mkdirs(folder)
    _unfenced(spark, path, fence)
    name = writer or run_name()
    _, file = _file_system(spark, f"{claims}/{version}")
    try:
        stream = fs.create(file, False)  # of several, one succeeds
    except Exception as error:
        if not fs.exists(file):
            raise
        if read_text(spark, f"{claims}/{version}") != name:
            raise SourceFenced(f"{ops.SOURCE_FENCED}: version {version} belongs to another writer") from error
        return
    stream.write(name.encode())
    stream.close()


def _unfenced(spark: SparkSession, path: str, fence: int) -> None:
    """Refuse where a writer with a greater fence has begun to write."""
    if any(int(name.split("=", 1)[1]) > fence for name in _listed(spark, path) if name.startswith("fence=")):
        raise SourceFenced(ops.SOURCE_FENCED)


def write_snapshot(table: DataFrame, path: str, version: int, fence: int | None = None, writer: str | None = None) -> None:
    """Write one version; it counts only once its files are all in place.

    With a ``fence``, the version is claimed first: a writer that another one with a greater fence has replaced gets
    ``SOURCE_FENCED`` rather than replacing anything, as does the second of two writers at one version. ``writer`` names who may write a version again after a crash.
    """
    if fence is None:
        table.write.mode("overwrite").parquet(f"{path}/version={version}")
        return
    _claim(table.sparkSession, path, version, fence, writer)
    table.write.mode("overwrite").parquet(f"{path}/fence={fence}/version={version}")
    _unfenced(table.sparkSession, path, fence)


def read_snapshot(spark: SparkSession, path: str, below: int | None = None, fence: int | None = None) -> DataFrame | None:
    """The newest finished snapshot; ``below`` and ``fence`` leave out this version and all that come after it."""
    found = _snapshots(spark, path)
    keys = _before(found, below, fence if fence is not None else max([key[0] for key in found], default=NO_FENCE))
    return spark.read.parquet(found[max(keys)]) if keys else None


def drop_old_versions(spark: SparkSession, path: str, older_than_seconds: float, now: float | None = None) -> int:
    """Remove the snapshots finished so long ago that no reader can be at them, but never the newest; returns how many went."""
    found = _snapshots(spark, path)
    limit = ((time.time() if now is None else now) - older_than_seconds) * 1000
    gone = 0
    for key in sorted(found)[:-1]:
        fs, folder = _file_system(spark, found[key])
        if fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")).getModificationTime() < limit:
            fs.delete(folder, True)
            gone += 1
    return gone


def write_registry(registry: DataFrame, path: str, version: int, fence: int | None = None, writer: str | None = None) -> None:
    """The registry after one transition, all or nothing."""
    write_snapshot(registry, path, version, fence, writer)


def write_status(status: DataFrame, path: str, version: int, fence: int | None = None, writer: str | None = None) -> None:
    """Merge new status rows over the previous snapshot and write the next one."""
    write_snapshot(status_merge(status, read_snapshot(status.sparkSession, path, version, fence)), path, version, fence, writer)


# Held records: a log of what waits, and which of it has been released.

_HELD_LOG = "log"
_RELEASED = "_released"


def held_connectors(spark: SparkSession, path: str, below: int | None = None) -> dict[str, list[str]]:
    """Folders of the log with records that still wait, by the connector's folder; optionally only those of batches before one."""
    released: dict[str, int] = {}
    for number in _numbered(spark, f"{path}/{_RELEASED}"):
        if below is None or number < below:
            released |= dict.fromkeys(json.loads(read_text(spark, f"{path}/{_RELEASED}/{number}")), number)
    found = {}
    for connector in _listed(spark, f"{path}/{_HELD_LOG}"):
        if connector.startswith("connector="):
            batches = [name for name in _listed(spark, f"{path}/{_HELD_LOG}/{connector}") if name.startswith("batch_id=") and released.get(connector, -1) < int(name.split("=", 1)[1]) and (below is None or int(name.split("=", 1)[1]) < below)]
            if batches:
                found[connector] = [f"{connector}/{name}" for name in batches]
    return found


def read_held(spark: SparkSession, path: str, schema, below: int | None = None) -> DataFrame:
    """Records that wait, in the order of nothing; ``schema``: of the feed."""
    places = [place for batches in held_connectors(spark, path, below).values() for place in batches]
    log = f"{path}/{_HELD_LOG}"
    return spark.read.schema(schema).parquet(*[f"{log}/{place}" for place in places]) if places else spark.createDataFrame([], schema)


def connector_folder(connector: str | None) -> str:
    return _partition("connector", connector)


def hold(records: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch's records of held connectors, with their ``connector``, to the log; nothing that waits is written again."""
    rows = records.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("connector", "batch_id").parquet(f"{path}/{_HELD_LOG}")


def release(spark: SparkSession, path: str, batch_id: int, connectors: Iterable[str]) -> None:
    """Mark what waits of these connectors (by folder) as delivered by a batch."""
    fs, file = _file_system(spark, f"{path}/{_RELEASED}/{batch_id}")
    stream = fs.create(file, True)
    stream.write(json.dumps(sorted(connectors)).encode())
    stream.close()


def drop_released(spark: SparkSession, path: str, below: int) -> None:
    """Remove records that batches before this one have delivered: those batches will not run again."""
    for number in _numbered(spark, f"{path}/{_RELEASED}"):
        if number >= below:
            continue
        for connector in json.loads(read_text(spark, f"{path}/{_RELEASED}/{number}")):
            for name in _listed(spark, f"{path}/{_HELD_LOG}/{connector}"):
                if name.startswith("batch_id=") and int(name.split("=", 1)[1]) <= number:
                    fs, folder = _file_system(spark, f"{path}/{_HELD_LOG}/{connector}/{name}")
                    fs.delete(folder, True)
        fs, file = _file_system(spark, f"{path}/{_RELEASED}/{number}")
        fs.delete(file, False)


#: Below the history folder and hidden from readers: rewritten partitions until they are in place.
_STAGING = "_rewrites"


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(folder)) if fs.exists(folder) else []


def _place() -> Column:
    """Partition a row lies in, as the last four folders of its file's path, escaped as Spark writes them."""
    return F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"((?:[^/]+/){4})[^/]+$", 1)


def _put_in_place(spark: SparkSession, path: str, run: str) -> None:
    """Replace each partition a finished pass rewrote by its survivors. Begun again after a crash, it does the rest."""
    staged = f"{path}/{_STAGING}/{run}"
    for row in spark.read.parquet(f"{staged}/moves").collect():
        fs, target = _file_system(spark, f"{path}/{row['place']}")
        _, fresh = _file_system(spark, f"{staged}/survivors/{row['place']}")
        if row["survives"] and not fs.exists(fresh):
            continue  # moved before the crash
        fs.delete(target, True)
        stream = target.getParent()
        if not row["survives"]:
            if fs.exists(stream) and not fs.listStatus(stream):
                fs.delete(stream, False)
            continue
        fs.mkdirs(stream)
        if not fs.rename(fresh, target):
            raise RuntimeError(f"could not put {row['place']} in place")


def finish_rewrites(spark: SparkSession, path: str) -> None:
    """Complete a pass that was stopped while its partitions were put in place; forget one that had not got so far."""
    for run in _listed(spark, f"{path}/{_STAGING}"):
        if path_exists(spark, f"{path}/{_STAGING}/{run}/moves/_SUCCESS"):
            _put_in_place(spark, path, run)
        fs, folder = _file_system(spark, f"{path}/{_STAGING}/{run}")
        fs.delete(folder, True)


def _ready(spark: SparkSession, staged: str, places) -> None:
    """Mark a pass as written aside in full, with what is to become of each place."""
    moves = [(name, path_exists(spark, f"{staged}/survivors/{name}")) for name in sorted(places)]
    spark.createDataFrame(moves, "place string, survives boolean").coalesce(1).write.parquet(f"{staged}/moves")


def _allowed(spark: SparkSession, path: str, before_write: Callable[[], None] | None) -> None:
    """Ask once more before anything changes; a refusal takes back what was written aside."""
    if before_write is None:
        return
    try:
        before_write()
    except Exception:
        fs, folder = _file_system(spark, f"{path}/{_STAGING}")
        fs.delete(folder, True)
        raise


def stage_retention(spark: SparkSession, path: str, tenant: str | None, cutoff, limit: int) -> int:
    """Write what one retention pass leaves of the partitions it touches, beside them; nothing is removed yet.

    The folders touched are at most ``limit`` for each tenant; only these are read again, and only their names come to the driver.
    """
    staged = f"{path}/{_STAGING}/{run_name()}"
    dated = read_history(spark, path).filter(F.col("occurred_month") <= F.to_date(F.lit(cutoff)))
    doomed = ops.retention_prune(dated.select("event_id", "tenant_id", "occurred_at", _place().alias("place")), tenant, cutoff, limit)
    doomed.select("event_id", "place").write.parquet(f"{staged}/doomed")
    doomed = spark.read.schema("event_id string, place string").parquet(f"{staged}/doomed")
    touched = {row["place"].rstrip("/"): row["n"] for row in doomed.groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not touched:
        return 0
    rows = spark.read.schema(HISTORY_SCHEMA).option("basePath", path).parquet(*[f"{path}/{name}" for name in touched])
    rows.withColumn("place", _place()).join(doomed, ["event_id", "place"], "left_anti").drop("place").sortWithinPartitions(*_PARTITIONS, "occurred_at", "event_id").write.options(**_DENSE).partitionBy(*_PARTITIONS).parquet(f"{staged}/survivors")
    _ready(spark, staged, touched)
    return sum(touched.values())


def retention_prune_write(spark: SparkSession, path: str, tenant: str | None, cutoff, limit: int, before_write: Callable[[], None] | None = None) -> int:
    """Remove one retention pass from storage, of one tenant or of each (None); returns how many rows went.

    Survivors are written aside in full before a partition is touched, and a pass stopped at any point is finished or
    forgotten by the next one, so no row is lost. One pass at a time; ``before_write`` (a fence check) may still stop it.
    """
    finish_rewrites(spark, path)
    if not path_exists(spark, path):
        return 0
    removed = stage_retention(spark, path, tenant, cutoff, limit)
    _allowed(spark, path, before_write)
    finish_rewrites(spark, path)
    return removed


#: Compacted folders that a month may have side by side before they are brought together too.
COMPACTED_PARTS = 4


def _months_before(spark: SparkSession, path: str, before) -> list[str]:
    """Folders tenant/month of months that begin before the month of a date; found by their names."""
    limit = f"occurred_month={before:%Y-%m}-01"
    tenants = [name for name in _listed(spark, path) if name.startswith("tenant_id=")]
    return [f"{tenant}/{month}" for tenant in tenants for month in _listed(spark, f"{path}/{tenant}") if month.startswith("occurred_month=") and month < limit]


#: Bytes of files that compaction brings together before it puts them in place and goes on.
COMPACTED_BYTES = 2 << 30


def _by_size(spark: SparkSession, path: str, found: dict[str, list[str]]) -> list[list[str]]:
    """Months with their folders, dealt in order to groups of about so many bytes."""
    groups: list[list[str]] = []
    size = 0
    for month, places in found.items():
        if not groups or size >= COMPACTED_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(month)
        for place in places:
            fs, folder = _file_system(spark, f"{path}/{place}")
            size += fs.getContentSummary(folder).getLength()
    return groups


def compact_history(spark: SparkSession, path: str, before, before_write: Callable[[], None] | None = None) -> int:
    """Bring the batches of each tenant's closed months (those before a date) together; returns how many partitions went.

    Rows stay as they are, and a stream's batch that runs again finds its events there. What is to do is read from the names of
    folders: months already brought together are not opened, and late events become a part beside the compacted ones, until there are
    ``COMPACTED_PARTS`` of these. Bloom filters let a lookup of one event pass over files. Crash-safe like retention; one rewriting pass at a time.
    Months go into place group by group, so beside the history lie the rewritten rows of one group only.
    """
    finish_rewrites(spark, path)
    if not path_exists(spark, path):
        return 0
    found: dict[str, list[str]] = {}
    numbers = [-1]
    done = f"stream_id={COMPACTED}"
    for month in _months_before(spark, path, before):
        loose = [f"{month}/{stream}/{batch}" for stream in _listed(spark, f"{path}/{month}") if stream.startswith("stream_id=") and stream != done for batch in _listed(spark, f"{path}/{month}/{stream}")]
        parts = [name for name in _listed(spark, f"{path}/{month}/{done}") if name.startswith("batch_id=")]
        numbers += [int(name.split("=", 1)[1]) for name in parts]
        if loose:
            found[month] = loose + ([f"{month}/{done}/{name}" for name in parts] if len(parts) >= COMPACTED_PARTS else [])
    number = max(numbers) + 1
    keys = ["tenant_id", "occurred_month"]
    for months in _by_size(spark, path, found):
        old = [place for month in months for place in found[month]]
        staged = f"{path}/{_STAGING}/{run_name()}"
        with _setting(spark, *_CLEANING):
            (
                read_places(spark, path, old).withColumn("stream_id", F.lit(COMPACTED)).withColumn("batch_id", F.lit(number).cast("bigint")).hint("rebalance", *keys)
                .sortWithinPartitions(*keys, "occurred_at", "event_id").write.options(**_DENSE).option("parquet.bloom.filter.enabled#event_id", "true")
                .option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy(*_PARTITIONS).parquet(f"{staged}/survivors"))
        _ready(spark, staged, {*old, *[f"{month}/{done}/batch_id={number}" for month in months]})
        _allowed(spark, path, before_write)
        finish_rewrites(spark, path)
    return sum(map(len, found.values()))
