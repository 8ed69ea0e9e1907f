"""Source settings: one row per source with its allowlist of captured tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtrail.functions import identity, names

# Defaults and bounds of a source's settings.
DEFAULT_PORT = 1433
MINIMUM_RETENTION_MINUTES = 20160
DEFAULT_BATCH = 128
DEFAULT_QUEUE = 1024
MAXIMUM_QUEUE = 8192

SOURCE_SCHEMA = (
    "tenant_id string, source_id string, host string, port int, database string, tables array<string>, "
    "incarnation string, boundaries map<string,string>"
)


def prepare_sources(sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE, connector_prefix: str = names.CONNECTOR_PREFIX) -> DataFrame:
    """Add what routing needs: connector name, heartbeat table and the captured-table list."""
    prepared = sources
    if "boundaries" not in sources.columns:
        prepared = prepared.withColumn("boundaries", F.lit(None).cast("map<string,string>"))
    if "connector" not in sources.columns:
        prepared = prepared.withColumn("connector", names.connector_name(F.col("tenant_id"), F.col("source_id"), connector_prefix))
    return prepared.withColumn("heartbeat_table", F.lit(heartbeat_table)).withColumn(
        "captured", F.array_union("tables", F.array(F.lit(heartbeat_table)))
    )


def captured_tables(sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """One row per captured table of each source: the allowlist and the heartbeat table, once each."""
    listed = sources.select("tenant_id", "source_id", F.array_union("tables", F.array(F.lit(heartbeat_table))).alias("captured"))
    return listed.select("tenant_id", "source_id", F.explode("captured").alias("table_name"))


def configuration_hash(sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Identity of each source's effective settings."""
    return sources.withColumn(
        "configuration_hash",
        identity.configuration_hash(
            F.col("tenant_id"), F.col("source_id"), F.col("host"), F.col("port"), F.col("database"),
            F.array_union("tables", F.array(F.lit(heartbeat_table))),
        ),
    )


def include_tables(feed: DataFrame, sources: DataFrame, heartbeat_table: str = names.HEARTBEAT_TABLE) -> DataFrame:
    """Keep the rows of captured tables; ``feed`` carries ``database``, ``schema_name`` and ``table_name``."""
    allowed = prepare_sources(sources, heartbeat_table).select(
        F.col("database"), F.explode("captured").alias("qualified_name")
    ).distinct()
    return (
        feed.withColumn("qualified_name", names.qualified(F.col("schema_name"), F.col("table_name")))
        .join(allowed, ["database", "qualified_name"], "left_semi")
        .drop("qualified_name")
    )


def validate_sources(sources: DataFrame, service_marker: str = names.SERVICE_MARKER) -> DataFrame:
    """Every broken rule of every source as ``(tenant_id, source_id, violation)``.

    Zero or null numbers take their defaults first, as an unset setting does. Uniqueness is counted
    per tenant and per physical database (ignoring case).
    """
    port = F.when(F.coalesce("port", F.lit(0)) == 0, DEFAULT_PORT).otherwise(F.col("port"))
    retention = F.when(F.coalesce("retention_minutes", F.lit(0)) == 0, MINIMUM_RETENTION_MINUTES).otherwise(F.col("retention_minutes"))
    queue = F.when(F.coalesce("max_queue", F.lit(0)) == 0, DEFAULT_QUEUE).otherwise(F.col("max_queue"))
    batch = F.when(F.coalesce("max_batch", F.lit(0)) == 0, DEFAULT_BATCH).otherwise(F.col("max_batch"))
    tables = F.coalesce("tables", F.array().cast("array<string>"))

    def broken(condition, code):
        return F.when(F.coalesce(condition, F.lit(True)), code)

    own = sources.withColumn(
        "violation",
        F.explode(F.array_compact(F.array(
            broken(~F.col("tenant_id").rlike(names.ID_PATTERN) | ~F.col("source_id").rlike(names.ID_PATTERN), "INVALID_IDENTIFIER"),
            broken(~F.col("host").rlike(names.HOST_PATTERN) | ~F.col("database").rlike(names.DATABASE_IDENTIFIER), "INVALID_ADDRESS"),
            broken(~port.between(1, 65535), "INVALID_PORT"),
            broken(F.size(tables) == 0, "ALLOWLIST_REQUIRED"),
            broken(F.exists(tables, lambda t: ~t.rlike(names.QUALIFIED_IDENTIFIER) | names.service_owned(t, service_marker)), "INVALID_TABLE"),
            broken(retention < MINIMUM_RETENTION_MINUTES, "RETENTION_TOO_SHORT"),
            broken((batch < 1) | (queue <= batch) | (queue > MAXIMUM_QUEUE), "INVALID_BATCH_BOUNDS"),
        ))),
    ).select("tenant_id", "source_id", "violation")

    located = sources.withColumn(
        "location", F.lower(F.concat(F.col("host"), F.lit(":"), port.cast("string"), F.lit("/"), F.col("database"))))
    return own.unionByName(_repeated(located, "tenant_id", "DUPLICATE_TENANT")).unionByName(
        _repeated(located, "location", "DUPLICATE_DATABASE"))


def _repeated(sources: DataFrame, column: str, code: str) -> DataFrame:
    repeated = sources.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(column)
    return sources.join(repeated, column, "left_semi").select("tenant_id", "source_id", F.lit(code).alias("violation"))


def expanded_tables(current: DataFrame, requested: DataFrame) -> DataFrame:
    """Current and requested tables of each source, each once."""
    columns = ["tenant_id", "source_id", "table_name"]
    return current.select(*columns).union(requested.select(*columns)).distinct()


def request_set_match(requested: DataFrame, ready: DataFrame) -> DataFrame:
    """Per source: the requested set must still be ready in full."""
    keys = ["tenant_id", "source_id"]
    lost = requested.select(*keys, "table_name").exceptAll(ready.select(*keys, "table_name").distinct())
    counts = lost.groupBy(*keys).agg(F.count(F.lit(1)).alias("lost_tables"))
    return (
        requested.groupBy(*keys).agg(F.count(F.lit(1)).alias("requested_tables"))
        .join(counts, keys, "left")
        .select(*keys, "requested_tables", F.coalesce("lost_tables", F.lit(0)).cast("bigint").alias("lost_tables"),
                F.when(F.col("lost_tables") > 0, "ONBOARDING_REQUEST_CHANGED").alias("error_code"))
    )
