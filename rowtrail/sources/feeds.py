"""Change feeds as batch and stream inputs, and raw change tables turned into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.functions import lsn

FEED_SCHEMA = "key string, value string, destination string, captured_at timestamp"
# Bounds of one micro-batch.
DEFAULT_TRIGGER = "1 second"
DEFAULT_BATCH_BYTES = 64 * 1024 * 1024


def read_change_feed(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = FEED_SCHEMA) -> DataFrame:
    """Change records at rest (``parquet`` or ``json`` lines)."""
    return spark.read.schema(schema).format(fmt).load(path)


def stream_change_feed(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = FEED_SCHEMA,
                       max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Change records as they arrive; bounds limit one micro-batch by files or by bytes (not both)."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("bound a batch by files or by bytes, not both")
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def kafka_change_feed(spark: SparkSession, servers: str, topics: str, max_offsets: int | None = None, streaming: bool = True) -> DataFrame:
    """The same records from Kafka topics; the topic is the destination. Starts at the latest offsets, so no backfill."""
    reader = (spark.readStream if streaming else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("subscribePattern", topics)
    if streaming:
        reader = reader.option("startingOffsets", "latest").option("failOnDataLoss", "true")
        if max_offsets is not None:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.col("topic").alias("destination"), F.col("timestamp").alias("captured_at"))


def normalize_values(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Decimals become their exact text and binaries base64, so that no row image loses a digit or a byte."""
    chosen = set(rows.columns if columns is None else columns)

    def plain(name: str, data_type: str) -> Column:
        if name in chosen and data_type.startswith("decimal"):
            return F.col(name).cast("string").alias(name)
        if name in chosen and data_type == "binary":
            return F.base64(name).alias(name)
        return F.col(name)

    return rows.select(*[plain(name, data_type) for name, data_type in rows.dtypes])


def change_table_to_envelope(rows: DataFrame, key_columns: list[str], database: str, schema: str, table: str,
                             destination: str, meta: tuple[str, ...] = ("start_lsn", "seqval", "operation", "ts_ms")) -> DataFrame:
    """Raw change-table rows as change records.

    Rows hold ``start_lsn``, ``seqval``, ``operation`` (1 delete, 2 insert, 3 and 4 before and after of one
    update) and ``ts_ms``; the other columns are the source row. The two halves of an update meet in one
    aggregation, and its record counts as the second serial; a delete and an insert of one position and key stay two records.
    """
    commit, change, kind, millis = meta
    data = [c for c in rows.columns if c not in meta]
    ready = normalize_values(rows, data)
    image = F.to_json(F.struct(*[F.col(c) for c in sorted(data)]), {"ignoreNullFields": "false"})
    keyed = ready.select(
        commit, change, kind, millis, F.to_json(F.struct(*[F.col(c) for c in key_columns])).alias("key"), image.alias("image"),
        F.least(F.col(kind), F.lit(3)).alias("_change_kind"))
    merged = keyed.groupBy(commit, change, "key", "_change_kind").agg(
        F.max(F.when(F.col(kind).isin(1, 3), F.col("image"))).alias("before"),
        F.max(F.when(F.col(kind).isin(2, 4), F.col("image"))).alias("after"),
        F.max(kind).alias("kind"), F.max(millis).alias("millis"))
    op = F.when(F.col("kind") == 1, "d").when(F.col("kind") == 2, "c").otherwise("u")
    source = F.to_json(F.struct(
        F.lit(database).alias("db"), F.lit(schema).alias("schema"), F.lit(table).alias("table"),
        lsn.lsn_text(F.col(commit)).alias("commit_lsn"), lsn.lsn_text(F.col(change)).alias("change_lsn"),
        F.when(F.col("kind") > 2, 2).otherwise(1).alias("event_serial_no"), F.col("millis").alias("ts_ms")))
    null = F.lit("null")
    value = F.concat(F.lit('{"op":"'), op, F.lit('","before":'), F.coalesce("before", null), F.lit(',"after":'),
                     F.coalesce("after", null), F.lit(',"source":'), source, F.lit("}"))
    return merged.select("key", value.alias("value"), F.lit(destination).alias("destination"))


def start_at_activation(changes: DataFrame, activation_lsn: str) -> DataFrame:
    """Only rows strictly after the activation position: no snapshot and no backfill.

    Takes any frame with ``commit_lsn``; snapshot records themselves fail validation (operation ``r``). A row whose
    position can't be read stays, with ``error_code``.
    """
    place = lsn.lsn_bytes(F.col("commit_lsn"))
    return lsn.with_position_code(changes.filter(place.isNull() | (place > lsn.lsn_bytes(F.lit(lsn.checked(activation_lsn))))), place.isNull())
