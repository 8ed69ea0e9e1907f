"""Change feeds derived from the given tables, so that their size grows with those tables.

The recipes are described in FIXTURES.md. Nothing is sampled and no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtrail.functions import lsn, names
from rowtrail.operators.settings import SOURCE_SCHEMA
from rowtrail.session import configure

# The one source the row feeds belong to.
TENANT = "T1"
SOURCE = "shop"
DATABASE = "shop"
SCHEMA = "dbo"
INCARNATION = "01b67815-3af8-491a-b3bb-ed64ea4b67f8"
CONNECTOR = f"{names.CONNECTOR_PREFIX}-{TENANT}-{SOURCE}"
ORDERS = "dbo.orders"
EVENTS = "dbo.events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one with fewer splits than cores is spread over them, a large one is read as it lies."""
    read = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return read.repartition(cores) if read.rdd.getNumPartitions() < cores else read


def shop_source(spark: SparkSession, boundaries: dict[str, str] | None = None, incarnation: str = INCARNATION) -> DataFrame:
    row = (TENANT, SOURCE, "shop.example", 1433, DATABASE, [ORDERS, EVENTS], incarnation, boundaries)
    return configure(spark).createDataFrame([row], SOURCE_SCHEMA)


def _utc(column: str) -> Column:
    """The zone-less Parquet timestamps are UTC."""
    return F.col(column).cast("timestamp")


def _envelope(op: Column, before: Column, after: Column, table_name: str, commit: Column, change: Column,
              serial: Column, millis: Column) -> Column:
    """Envelope text around image texts that are JSON already."""
    source = F.to_json(F.struct(
        F.lit(DATABASE).alias("db"), F.lit(SCHEMA).alias("schema"), F.lit(table_name).alias("table"),
        commit.alias("commit_lsn"), change.alias("change_lsn"),
        serial.cast("bigint").alias("event_serial_no"), millis.alias("ts_ms")))
    null = F.lit("null")
    return F.concat(F.lit('{"op":"'), op, F.lit('","before":'), F.coalesce(before, null), F.lit(',"after":'),
                    F.coalesce(after, null), F.lit(',"source":'), source, F.lit("}"))


def _order_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order and step (1 insert, 2 update, 3 delete) with both row images."""
    orders = table(spark, sf_dir, "orders")

    def image(status: Column) -> Column:
        return F.to_json(F.struct(
            F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderpriority"), status.alias("o_orderstatus"),
            F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice")))

    def entry(step: int, op: str) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(op).alias("op"), F.lit(ORDERS).alias("name"))

    steps = F.array_compact(F.array(
        entry(1, "c"),
        F.when(F.col("o_orderstatus") != "O", entry(2, "u")),
        F.when(F.col("o_orderkey") % 10 == 0, entry(3, "d"))))
    opened, real = image(F.lit("O")), image(F.col("o_orderstatus"))
    block = F.col("o_orderkey") % 65536
    vlf = F.lit(39) + F.floor(F.col("o_orderkey") / 65536)
    step = F.col("step")
    return orders.select("*", F.inline(steps)).select(
        "o_orderkey", "step", "op", "name",
        F.when(step == 2, opened).when(step == 3, real).alias("before"),
        F.when(step == 1, opened).when(step == 2, real).alias("after"),
        lsn.make_lsn(vlf, block, step * 3).alias("commit_lsn"),
        lsn.make_lsn(vlf, block, step * 3 - 1).alias("change_lsn"),
        F.when(step == 2, 2).otherwise(1).cast("bigint").alias("serial"),
        (F.unix_millis(_utc("o_orderdate")) + step * 1000).alias("ts_ms"),
    )


def orders_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every order inserted, most updated once, a tenth deleted."""
    s = _order_steps(spark, sf_dir)
    return s.select(
        F.to_json(F.struct("o_orderkey")).alias("key"),
        _envelope(F.col("op"), F.col("before"), F.col("after"), "orders", F.col("commit_lsn"), F.col("change_lsn"),
                  F.col("serial"), F.col("ts_ms")).alias("value"),
        F.concat_ws(".", F.lit(CONNECTOR), F.lit(DATABASE), F.col("name")).alias("destination"),
        F.timestamp_millis(F.col("ts_ms") + 5000).alias("captured_at"),
    )


def previous_in_chain(rows: DataFrame, key: str, order: list[str], span: Column, carried: str) -> DataFrame:
    """Add ``previous``: the value of ``carried`` on the key's preceding row, null on its first.

    A hot key is split by ``span`` (a coarse, order-preserving part of the order). Within a span the
    neighbour is a lag; a span's first row takes the last row of the key's preceding span, found
    among one summary row per key and span.
    """
    split = rows.withColumn("_span", span)
    inner = Window.partitionBy(key, "_span").orderBy(*order)
    linked = split.select("*", F.lag(carried).over(inner).alias("_near"), F.row_number().over(inner).alias("_nth"))
    ends = split.groupBy(key, "_span").agg(F.max(F.struct(*order, F.col(carried).alias("_carried"))).alias("_end"))
    before = ends.select(key, "_span", F.lag("_end._carried").over(Window.partitionBy(key).orderBy("_span")).alias("_far"))
    return (
        linked.join(before, [key, "_span"], "left")
        .withColumn("previous", F.when(F.col("_nth") == 1, F.col("_far")).otherwise(F.col("_near")))
        .drop("_span", "_near", "_far", "_nth")
    )


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events chained per user, each with its own and the preceding image."""
    e = table(spark, sf_dir, "events").select("event_id", _utc("ts").alias("ts"), "user_id", "event_type", "value")
    eid = F.col("event_id")
    flag = F.when(eid % 4 == 1, ',"flag":null').when(eid % 4 == 2, ',"flag":false').when(eid % 4 == 3, ',"flag":0').otherwise("")
    note = F.when(eid % 3 == 0, "null").when(eid % 3 == 1, '""').otherwise('"12"')
    score = F.when(eid % 2 == 0, "12").otherwise('"12"')
    image = F.concat(
        F.lit('{"event_type":'), F.to_json(F.col("event_type").cast("variant")),
        F.lit(',"value":"'), F.col("value").cast("decimal(18,2)").cast("string"), F.lit('"'),
        flag, F.lit(',"note":'), note, F.lit(',"score":'), score, F.lit("}"))
    imaged = e.withColumn("image", image)
    return previous_in_chain(imaged, "user_id", ["ts", "event_id"], F.to_date("ts"), "image")


def events_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """each user's events as successive states of one record, with values that trap loose typing."""
    return _events_feed(_event_rows(spark, sf_dir)).drop("event_id")


def _events_feed(rows: DataFrame) -> DataFrame:
    op = F.when(F.col("previous").isNull(), "c").when(F.col("event_type") == "error", "d").otherwise("u")
    millis = F.unix_millis("ts")
    return rows.withColumn("op", op).select(
        "event_id",
        F.concat(F.lit('{"user_id":'), F.col("user_id").cast("string"), F.lit(',"bucket":'),
                 (F.col("user_id") % 10).cast("string"), F.lit("}")).alias("key"),
        _envelope(F.col("op"), F.col("previous"), F.when(F.col("op") != "d", F.col("image")), "events",
                  lsn.make_lsn(F.lit(64), F.col("event_id"), F.lit(3)), lsn.make_lsn(F.lit(64), F.col("event_id"), F.lit(2)),
                  F.when(F.col("op") == "u", 2).otherwise(1), millis).alias("value"),
        F.when(F.col("event_id").isNotNull(), f"{CONNECTOR}.{DATABASE}.{EVENTS}").alias("destination"),
        F.timestamp_millis(millis + 5000).alias("captured_at"),
    )


# Rule 14 of the damage list needs an activation position; only the damaged rows lie at or before it.
DAMAGE_BOUNDARY = "00000020:00000000:0000"


def damaged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 where row ``event_id % 50 = r`` breaks validation rule r (1 to 15); the rest stays good."""
    feed = _events_feed(_event_rows(spark, sf_dir))
    rule = F.col("event_id") % 50
    key, value = F.col("key"), F.col("value")

    def swap(pattern: str, replacement: str) -> Column:
        return F.regexp_replace(value, pattern, replacement)

    heartbeat_table = swap('"table":"events"', f'"table":"{names.HEARTBEAT_TABLE.split(".")[1]}"')
    damaged_value = (
        F.when(rule == 1, None)
        .when(rule == 2, F.concat(F.lit("not json "), value))
        .when(rule == 4, swap('"op":"[cud]"', '"op":5'))
        .when(rule == 5, swap('"op":"[cud]"', '"op":"r"'))
        .when(rule == 6, swap('"schema":"dbo"', '"schema":""'))
        .when(rule == 7, swap('"db":"shop"', '"db":"elsewhere"'))
        .when(rule == 10, swap('"commit_lsn":"[^"]*"', '"commit_lsn":null'))
        .when(rule == 11, swap('"change_lsn":"[^"]*"', '"change_lsn":"40:1:2"'))
        .when(rule == 12, swap('"ts_ms":([0-9]+)', '"ts_ms":"$1"'))
        .when(rule == 13, heartbeat_table)
        .when(rule == 14, swap('"commit_lsn":"00000040', '"commit_lsn":"00000010'))
        .when(rule == 15, swap('"after":\\{[^}]*\\}', '"after":"gone"'))
        .otherwise(value))
    damaged_value = F.when(rule == 15, F.regexp_replace(damaged_value, '"before":\\{[^}]*\\}', '"before":[]')).otherwise(damaged_value)
    damaged_key = (
        F.when(rule == 8, F.lit('{"user_id":'))
        .when(rule == 9, F.lit("{}"))
        .when(rule == 13, F.lit('{"singleton_id":2}'))
        .otherwise(key))
    destination = F.when(rule == 3, f"{names.CONNECTOR_HEARTBEAT}{CONNECTOR}").otherwise(F.col("destination"))
    return feed.select(damaged_key.alias("key"), damaged_value.alias("value"), destination.alias("destination"),
                       "captured_at", "event_id")


def damaged_source(spark: SparkSession) -> DataFrame:
    return shop_source(spark, {EVENTS: DAMAGE_BOUNDARY})


def replayed_changes(spark: SparkSession, sf_dir: str, replayed: bool | None = None) -> DataFrame:
    """F1, with a fifth of the orders delivered again an hour later; or only the first delivery, or only the second."""
    feed = orders_changes(spark, sf_dir)
    if replayed is False:
        return feed
    # A record's deliveries are laid out beside it, so the feed is derived once.
    fifth = F.get_json_object("key", "$.o_orderkey").cast("bigint") % 5 == 0
    times = F.array_compact(F.array(F.when(F.lit(replayed is None), F.col("captured_at")), F.when(fifth, F.col("captured_at") + F.expr("interval 1 hour"))))
    return feed.select(*[F.explode(times).alias(c) if c == "captured_at" else F.col(c) for c in feed.columns])


def heartbeat_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the reader's own heartbeat row, updated after every hundredth event."""
    e = table(spark, sf_dir, "events").filter(F.col("event_id") % 100 == 0)
    tick = F.floor(F.col("event_id") / 100)
    millis = F.unix_millis(_utc("ts"))
    heartbeat = names.HEARTBEAT_TABLE
    return e.select(
        F.lit('{"singleton_id":1}').alias("key"),
        _envelope(F.lit("u"),
                  F.to_json(F.struct((tick - 1).alias("tick_sequence"))), F.to_json(F.struct(tick.alias("tick_sequence"))),
                  heartbeat.split(".")[1],
                  lsn.make_lsn(F.lit(64), F.col("event_id"), F.lit(6)), lsn.make_lsn(F.lit(64), F.col("event_id"), F.lit(5)),
                  F.lit(2), millis).alias("value"),
        F.when(F.col("event_id").isNotNull(), f"{CONNECTOR}.{DATABASE}.{heartbeat}").alias("destination"),
        F.timestamp_millis(millis + 5000).alias("captured_at"),
    )


def orders_change_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as raw change-table rows; an update is the pair 3 (before) and 4 (after)."""
    s = _order_steps(spark, sf_dir)
    rows = F.when(F.col("op") == "c", F.array(F.struct(F.lit(2).alias("operation"), F.col("after").alias("image")))).when(
        F.col("op") == "d", F.array(F.struct(F.lit(1).alias("operation"), F.col("before").alias("image")))).otherwise(
        F.array(F.struct(F.lit(3).alias("operation"), F.col("before").alias("image")),
                F.struct(F.lit(4).alias("operation"), F.col("after").alias("image"))))
    exploded = s.select("*", F.explode(rows).alias("r"))
    image = F.from_json("r.image", "o_custkey bigint, o_orderkey bigint, o_orderpriority string, o_orderstatus string, o_totalprice string")
    return exploded.select(
        lsn.lsn_bytes(F.col("commit_lsn")).alias("start_lsn"), lsn.lsn_bytes(F.col("change_lsn")).alias("seqval"),
        F.col("r.operation").alias("operation"), F.col("ts_ms"), image.alias("i"),
    ).select("start_lsn", "seqval", "operation", "ts_ms", "i.o_custkey", "i.o_orderkey", "i.o_orderpriority", "i.o_orderstatus",
             F.col("i.o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
