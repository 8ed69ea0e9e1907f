"""History rows: de-duplicate, search, page, compare fields, prune, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtrail.functions import jsonvalue, lsn, names
from rowtrail.functions.sizing import bounded_broadcast

SUMMARY_COLUMNS = [
    "event_id", "schema_name", "table_name", "operation", "occurred_at", "captured_at", "record_key",
    "changed_properties", "commit_lsn", "change_lsn", "event_serial_no",
]
TENANT_MISMATCH = "MESSAGE_TENANT_MISMATCH"
SOURCE_FENCED = "SOURCE_FENCED"
MAX_PAGE_SIZE = 1000
# Columns a caller may sort a page by.
SORTABLE = {"occurred_at", "captured_at", "schema_name", "table_name", "operation", "event_serial_no"}


#: What decides which of an event's copies is the first.
COPY_ORDER = ["captured_at", "commit_lsn", "change_lsn", "event_serial_no"]


def first_copies(events: DataFrame) -> DataFrame:
    """One row per event, the first captured.

    Spark prunes ``row_number() = 1`` on the map side, so a group of copies shuffles at most one row per task.
    """
    order = Window.partitionBy("event_id").orderBy(*COPY_ORDER)
    return events.withColumn("_copy", F.row_number().over(order)).filter(F.col("_copy") == 1).drop("_copy")


def dedupe_events(batch: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """New events only: the first copy in the batch, unless the history already holds the event."""
    fresh = first_copies(batch)
    return fresh if history is None else fresh.join(history.select("event_id"), "event_id", "left_anti").select(*batch.columns)


#: Sources whose ranges of positions are told apart in one filter; of more, one range over all is used.
MAX_SPANS = 200


def position_spans(batch: DataFrame) -> list[dict]:
    """Least and greatest commit text and the months of each source of a batch: (tenant_id, source_id, low, high, months).

    One entry a source comes to the driver, with the months its rows lie in.
    """
    rows = batch.filter(F.col("commit_lsn").isNotNull()).groupBy("tenant_id", "source_id").agg(
        F.min("commit_lsn").alias("low"), F.max("commit_lsn").alias("high"), F.collect_set(F.trunc("occurred_at", "month")).alias("months"))
    return [row.asDict() for row in rows.collect()]


def in_spans(spans: list[dict]) -> Column:
    """Whether a row lies in its source's range. Copies of an event share its source and commit text, so history outside cannot hold one."""
    if not spans:
        return F.lit(False)
    if len(spans) > MAX_SPANS:
        return F.col("commit_lsn").between(min(s["low"] for s in spans), max(s["high"] for s in spans))
    found = None
    for s in spans:
        part = F.col("source_id").eqNullSafe(s["source_id"]) if s["source_id"] is None else F.col("source_id") == s["source_id"]
        part = part & F.col("commit_lsn").between(s["low"], s["high"])
        found = part if found is None else found | part
    return found


def tenant_guard(events: DataFrame, tenant: str, source: str) -> DataFrame:
    """Add ``error_code`` where an event belongs to another tenant or source."""
    own = F.coalesce((F.col("tenant_id") == tenant) & (F.col("source_id") == source), F.lit(False))
    return events.withColumn("error_code", F.when(~own, TENANT_MISMATCH))


def fence_guard(batch: DataFrame, activation: DataFrame) -> DataFrame:
    """Add ``error_code`` where a row's ``fence`` is not its source's current one (or the source has none)."""
    current = activation.select("source_id", F.col("fence").alias("_fence"))
    return (
        batch.join(bounded_broadcast(current), "source_id", "left")
        .withColumn("error_code", F.when(~F.coalesce(F.col("fence") == F.col("_fence"), F.lit(False)), SOURCE_FENCED))
        .drop("_fence")
    )


def history_search(history: DataFrame, tenant: str, tables: str | None = None, operation: str | None = None,
                   occurred_from=None, occurred_to=None, record_key: str | None = None) -> DataFrame:
    """Filtered history of one tenant; ``tables`` joins qualified names by ``||``, times are inclusive."""
    found = history.filter(F.col("tenant_id") == tenant)
    if tables:
        pairs = [name.split(".", 1) for name in tables.split("||")]
        wanted = [(F.col("schema_name") == schema) & (F.col("table_name") == table) for schema, table in pairs]
        condition = wanted[0]
        for other in wanted[1:]:
            condition = condition | other
        found = found.filter(condition)
    if operation:
        found = found.filter(F.col("operation") == operation)
    # A stored history is partitioned by month, so the bounds also skip whole folders.
    monthly = "occurred_month" in history.columns
    if occurred_from is not None:
        found = found.filter(F.col("occurred_at") >= F.lit(occurred_from))
        if monthly:
            found = found.filter(F.col("occurred_month") >= F.trunc(F.lit(occurred_from), "month"))
    if occurred_to is not None:
        found = found.filter(F.col("occurred_at") <= F.lit(occurred_to))
        if monthly:
            found = found.filter(F.col("occurred_month") <= F.trunc(F.lit(occurred_to), "month"))
    if record_key:
        found = found.filter(F.contains(F.col("record_key"), F.lit(record_key)))
    return found


def page_size(size: int) -> int:
    """A page's size, refused beyond the bound that keeps one page small."""
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"a page has 1 to {MAX_PAGE_SIZE} rows, not {size}")
    return size


def history_page(found: DataFrame, page: int = 0, size: int = 20, sort: str = "occurred_at", descending: bool = True, after: tuple | None = None) -> DataFrame:
    """One zero-based page of summaries with ``total_elements``; ties go by event id, newest page first.

    ``after`` is the sort value and event id of the row to continue behind: a filter, where a late ``page`` has to pass over all before it.
    """
    if sort not in SORTABLE:
        raise ValueError(f"cannot sort by {sort!r}")
    page_size(size)
    order = [F.col(sort).desc(), F.col("event_id").desc()] if descending else [F.col(sort).asc(), F.col("event_id").asc()]
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = found
    if after is not None:
        value, event_id = F.lit(after[0]), F.lit(after[1])
        behind = (F.col(sort) < value) | ((F.col(sort) == value) & (F.col("event_id") < event_id)) if descending else (
            (F.col(sort) > value) | ((F.col(sort) == value) & (F.col("event_id") > event_id)))
        rows = found.filter(behind)
    return rows.select(*SUMMARY_COLUMNS).orderBy(*order).offset(page * size).limit(size).withColumn("total_elements", total)


def event_summary(history: DataFrame, tenant: str) -> DataFrame:
    return history.filter(F.col("tenant_id") == tenant).select(*SUMMARY_COLUMNS)


def event_detail(history: DataFrame, tenant: str, event_id: str | None = None) -> DataFrame:
    """Summary with both images; an unknown id, or one of another tenant, gives no row."""
    found = history.filter(F.col("tenant_id") == tenant)
    if event_id is not None:
        found = found.filter(F.col("event_id") == event_id)
    return found.select(*SUMMARY_COLUMNS, "before_json", "after_json")


def image_path_filter(history: DataFrame, path: str, value: str, images: DataFrame | None = None) -> DataFrame:
    """Events whose before or after image holds ``value`` at a JSON path.

    With ``images`` (the same images as VARIANT, see ``storage.append_images``) only the path's own column is read to find the events that may match, and the
    text of those alone is looked at. A value that is an object or array itself is compared as text.
    """
    exact = (F.get_json_object("before_json", path) == value) | (F.get_json_object("after_json", path) == value)
    if images is None or value[:1] in ("{", "["):
        return history.filter(exact)

    def may_hold(image: str) -> Column:
        # VARIANT writes a number in its shortest form, so numbers are compared as such too.
        number = F.lit(value).try_cast("double")
        return (F.try_variant_get(image, path, "string") == value) | F.coalesce(F.try_variant_get(image, path, "double") == number, F.lit(False))

    found = images.filter(may_hold("before_image") | may_hold("after_image")).select("tenant_id", "event_id")
    return history.join(found, ["tenant_id", "event_id"], "left_semi").select(*history.columns).filter(exact)


def field_changes(history: DataFrame, changed_only: bool = False, name_like: str | None = None) -> DataFrame:
    """One row per event and field: kind and JSON text of its value before and after."""
    def typed(side: str) -> Column:
        read = jsonvalue.parse(F.col(side))
        return F.when(jsonvalue.needs_marks(jsonvalue.kind(read)), jsonvalue.marked_fields(F.col(side))).otherwise(jsonvalue.by_number_kind(jsonvalue.object_at(read, "$")))

    fields = history.select("event_id", typed("before_json").alias("_b"), typed("after_json").alias("_a"))
    rows = fields.select("event_id", "_b", "_a", F.explode(F.array_union(jsonvalue.names(F.col("_b")), jsonvalue.names(F.col("_a")))).alias("field"))
    if name_like:
        rows = rows.filter(F.contains(F.lower("field"), F.lower(F.lit(name_like))))
    read = rows.select(
        "event_id", "field",
        jsonvalue.unmarked(F.to_json(F.try_element_at("_b", F.col("field")))).alias("before_value"),
        jsonvalue.unmarked(F.to_json(F.try_element_at("_a", F.col("field")))).alias("after_value"))
    result = read.select(
        "event_id", "field", jsonvalue.value_kind(F.col("before_value")).alias("before_kind"), "before_value",
        jsonvalue.value_kind(F.col("after_value")).alias("after_kind"), "after_value",
        (~F.col("before_value").eqNullSafe(F.col("after_value"))).alias("changed"))
    return result.filter("changed") if changed_only else result


def event_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("schema_name", "table_name", "operation").agg(F.count(F.lit(1)).alias("event_count"))


def filter_values(history: DataFrame, tenant: str, query: str = "", page: int = 0, size: int = 30) -> DataFrame:
    """One page of distinct qualified table names holding a text, with ``has_next``."""
    names_found = (
        history.filter(F.col("tenant_id") == tenant).select("schema_name", "table_name").distinct()
        .select(names.qualified(F.col("schema_name"), F.col("table_name")).alias("item"))
        .filter(F.contains(F.lower("item"), F.lower(F.lit(query)))))
    seen = names_found.orderBy("item").offset(page * size).limit(size + 1)
    rank = F.row_number().over(Window.orderBy("item"))  # at most size + 1 rows reach this window
    return (
        seen.withColumn("_rank", rank)
        .withColumn("has_next", F.max("_rank").over(Window.partitionBy(F.lit(1))) > size)
        .filter(F.col("_rank") <= size).select("item", "has_next"))


def last_event(history: DataFrame) -> DataFrame:
    """Latest event per source in position order."""
    place = lsn.position(F.col("commit_lsn"), F.col("change_lsn"), F.col("event_serial_no"))
    return (
        history.groupBy("tenant_id", "source_id")
        .agg(F.max(F.struct(place.alias("place"), "event_id", "occurred_at", "commit_lsn")).alias("last"))
        .select("tenant_id", "source_id", "last.event_id", "last.occurred_at", "last.commit_lsn"))


def acceptance_check(history: DataFrame, expected: DataFrame) -> DataFrame:
    """Per table and operation: rows, distinct ids, the expected number, and whether all three agree.

    Copies of an event share its group, so counting ids per table counts each event once.
    """
    keys = ["schema_name", "table_name", "operation"]
    per_id = history.groupBy(*keys, "event_id").agg(F.count(F.lit(1)).alias("copies"))
    actual = per_id.groupBy(*keys).agg(F.sum("copies").alias("row_count"), F.count(F.lit(1)).alias("distinct_ids"))
    return expected.join(actual, keys, "full_outer").select(
        *keys, F.coalesce("row_count", F.lit(0)).alias("row_count"), F.coalesce("distinct_ids", F.lit(0)).alias("distinct_ids"),
        F.coalesce("expected_count", F.lit(0)).cast("bigint").alias("expected_count"),
    ).withColumn("passed", (F.col("row_count") == F.col("expected_count")) & (F.col("distinct_ids") == F.col("row_count")))


def retention_prune(history: DataFrame, tenant: str | None, cutoff, limit: int) -> DataFrame:
    """The rows one retention pass removes: a tenant's oldest before the cutoff, at most ``limit``; without a tenant, of each.

    Ranks up to the limit are pruned on the map side, so a hot tenant sends at most ``limit`` rows per task.
    """
    old = history.filter(F.col("occurred_at") < F.lit(cutoff))
    if tenant is not None:
        return old.filter(F.col("tenant_id") == tenant).orderBy("occurred_at", "event_id").limit(limit)
    order = Window.partitionBy("tenant_id").orderBy("occurred_at", "event_id")
    return old.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= limit).drop("_rank")


def position_order(feed: DataFrame, commit: str = "commit_lsn", change: str = "change_lsn", serial: str = "event_serial_no") -> DataFrame:
    """Rows in log order (a range-partitioned sort, not one task)."""
    place = lsn.position(F.col(commit), F.col(change), F.col(serial))
    return feed.orderBy(place)


def replay_from(feed: DataFrame, commit: str, change: str, serial: int) -> DataFrame:
    """Rows strictly after a full position; a row whose own position can't be read stays, with ``error_code``."""
    place = lsn.position(F.col("commit_lsn"), F.col("change_lsn"), F.col("event_serial_no"))
    start = lsn.position(F.lit(lsn.checked(commit)), F.lit(change if change == lsn.NO_CHANGE_POSITION else lsn.checked(change)), F.lit(serial))
    broken = place["commit"].isNull() | place["change"].isNull() | place["serial"].isNull()
    return lsn.with_position_code(feed.filter(broken | (place > start)), broken)


