"""A fleet of sources and tables derived from supplier and region (F7): one source per supplier, one table per region.

Each attribute is one SQL expression over ``s`` (supplier key) and ``h`` (5 s + region key), the same
text on both sides of a comparison; ``MS`` and ``LSN`` stand for the two functions that differ by name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.functions import lsn, names
from rowtrail.operators import registry as registry_ops
from rowtrail.plans.feeds import table

# The two clocks of the fleet.
BASE_SECONDS = 1704067200
NOW_SECONDS = 1717200000
NOW = dt.datetime.fromtimestamp(NOW_SECONDS, dt.timezone.utc)
NOW_SQL = "TIMESTAMP '2024-06-01 00:00:00'"
TENANT, SOURCE = "'T' || s", "'S' || s"
SAVED = "LSN(39, 16, 3)"

REGISTRY = {
    "tenant_id": TENANT, "source_id": SOURCE, "schema_name": "'dbo'", "table_name": "name",
    "sql_cdc_enabled": "h % 7 <> 0", "capture_fingerprint": "'fp-' || h", "desired_enabled": "h % 4 <> 0", "active": "h % 3 <> 0",
    "state": "CASE WHEN h % 10 = 0 THEN 'BLOCKED' WHEN h % 10 = 1 THEN 'MISSING' WHEN h % 10 = 5 THEN 'STOPPING' WHEN h % 3 <> 0 AND h % 2 = 0 THEN 'ACTIVE' "
             "WHEN h % 3 <> 0 THEN 'ONBOARDING' WHEN h % 4 <> 0 THEN 'PENDING' ELSE 'DISCOVERED' END",
    "diagnostic": "CASE WHEN h % 10 = 0 THEN 'CAPTURE_HISTORY_GAP' WHEN h % 10 = 1 THEN 'SOURCE_TABLE_NOT_CDC_ENABLED' WHEN h % 13 <> 0 THEN 'AWAITING_CAPTURE_PROGRESS' END",
    "observed_at": f"MS(CAST(1000 AS BIGINT) * ({NOW_SECONDS} - h % 300))",
    "requested_at": f"CASE WHEN h % 5 <> 0 THEN MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h * 7 % 1000)) END",
    "enabled_at": f"CASE WHEN h % 3 = 1 THEN MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h % 50)) END",
    "requested_by": "CASE WHEN h % 5 <> 0 THEN 'op' || (h % 3) END",
    "activation_lsn": "CASE WHEN h % 5 <> 1 THEN LSN(39, h % 32, 3) END",
    "schema_state": "CASE h % 6 WHEN 0 THEN 'REFRESH_FAILED' WHEN 1 THEN 'CURRENT' WHEN 2 THEN 'REFRESH_FAILED' END",
    "schema_detail": "CASE WHEN h % 6 = 0 THEN 'earlier' END",
    "capture_instances": "'dbo_' || name",
    "refresh_requested_at": f"CASE WHEN h % 6 = 1 THEN MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h % 100)) END",
    "refresh_requested_by": "CASE WHEN h % 6 = 1 THEN 'op1' END",
    "refresh_started_at": f"CASE WHEN h % 4 = 1 THEN MS(CAST(1000 AS BIGINT) * ({NOW_SECONDS} - h % 240)) END",
    "refresh_detail": "CASE WHEN h % 4 = 1 THEN 'earlier' END",
    "refreshed_at": f"CASE WHEN h % 17 = 0 THEN MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + 7)) END",
    "refresh_error": "CASE WHEN h % 9 = 4 THEN 'CAPTURE_REFRESH_SQLCODE_1' END",
    "suspended_at": f"CASE WHEN h % 6 = 0 THEN MS(CAST(1000 AS BIGINT) * ({BASE_SECONDS} + h * 13 % 1000)) END",
    "suspension_reason": "CASE WHEN h % 18 = 0 THEN 'DISABLED_BY_ADMIN' WHEN h % 6 = 0 THEN 'CAPTURE_HISTORY_GAP' END",
    "suspended_lsn": "CASE WHEN h % 6 = 0 THEN LSN(39, 1, 1) END",
    "version": "CAST(h % 5 AS BIGINT)",
}
OBSERVATION = {
    "tenant_id": TENANT, "source_id": SOURCE, "schema_name": "'dbo'", "table_name": "name", "fingerprint": "'ob-' || h", "eligible": "h % 11 <> 0",
    "diagnostic": "CASE WHEN h % 22 = 0 THEN 'CAPTURED_PRIMARY_KEY_REQUIRED' WHEN h % 11 = 0 THEN 'CDC_CAPTURE_INITIALIZING' END",
    "first_minimum": "LSN(39, h % 32, 1)", "second_minimum": "CASE WHEN h % 8 = 0 THEN LSN(39, h % 32 + 8, 1) END",
    "instances": "CASE WHEN h % 8 = 0 THEN 'dbo_' || name || ',dbo_' || name || '_2' ELSE 'dbo_' || name END",
}
POSITION = {"tenant_id": TENANT, "source_id": SOURCE, "saved_commit": f"CASE WHEN s % 9 <> 0 THEN {SAVED} END"}
ADDRESS = {"tenant_id": TENANT, "source_id": SOURCE, "host": "'h' || s || '.example'", "port": "1433", "database": "'db' || s", "incarnation": "'inc-' || s"}
# The stored hash is the true one except where it says so; %TRUE% stands for it.
ACTIVATION = {
    "tenant_id": TENANT, "source_id": SOURCE, "incarnation": "'inc-' || s", "configuration_hash": "CASE WHEN s % 6 = 1 THEN 'stale' ELSE true_hash END",
    "created_at": f"MS(CAST(1000 AS BIGINT) * ({NOW_SECONDS} - s % 240))", "fence": "CAST(s % 4 + 1 AS BIGINT)", "table_registry_initialized": "s % 5 <> 0",
}


def spark_text(text: str) -> str:
    return text.replace("MS(", "timestamp_millis(").replace("LSN(", "format_string('%08x:%08x:%04x', ")


def duck_text(text: str) -> str:
    return text.replace("MS(", "epoch_ms(").replace("LSN(", "printf('%08x:%08x:%04x', ")


def duck_columns(columns: dict[str, str]) -> str:
    return duck_text(", ".join(f"{text} AS {name}" for name, text in columns.items()))


def spark_columns(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    return frame.select(*[F.expr(spark_text(text)).alias(name) for name, text in columns.items()])


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s, h, name`` per source and table. The regions are one short list, so pairing is an explode and no join."""
    named = F.struct(F.col("r_regionkey").alias("k"), F.replace("r_name", F.lit(" "), F.lit("_")).alias("name"))
    regions = table(spark, sf_dir, "region").agg(F.collect_list(named)).scalar()
    return source_keys(spark, sf_dir).withColumn("regions", regions).select("s", F.inline("regions")).select("s", (F.col("s") * 5 + F.col("k")).alias("h"), "name")


def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("s"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark_columns(keys(spark, sf_dir), REGISTRY)
    return registry_ops.table_ids(rows).select(*registry_ops.REGISTRY_COLUMNS)


def observed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six in seven registered tables are found, and every third source has a table of its own besides."""
    new = source_keys(spark, sf_dir).filter("s % 3 = 0").selectExpr("s", "s * 5 + 7 AS h", "'NEW_TABLE' AS name")
    return keys(spark, sf_dir).filter("h % 7 <> 0").unionByName(new)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark_columns(observed_keys(spark, sf_dir), OBSERVATION)
    minimums = F.array_compact(F.array(lsn.lsn_bytes(F.col("first_minimum")), lsn.lsn_bytes(F.col("second_minimum"))))
    return rows.withColumn("minimums", minimums)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_columns(source_keys(spark, sf_dir), POSITION)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source with its five tables (the list is bounded by the regions)."""
    named = keys(spark, sf_dir).groupBy("s").agg(F.sort_array(F.collect_list(F.concat(F.lit("dbo."), F.col("name")))).alias("tables"))
    return named.select(*[F.expr(text).alias(name) for name, text in ADDRESS.items()], "tables")


def activation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven in eight sources are activated; some with settings that have changed since."""
    from rowtrail.operators import settings
    hashed = settings.configuration_hash(sources(spark, sf_dir)).select(F.substring("source_id", 2, 20).cast("bigint").alias("s"), F.col("configuration_hash").alias("true_hash"))
    return spark_columns(hashed.filter("s % 8 <> 0"), ACTIVATION)


def hash_sql(condition: str = "TRUE", rows: str = "reg") -> str:
    """Configuration hash per source over the listed tables of a registry that meet a condition."""
    return f"""
      SELECT s, sha256('T' || s || chr(10) || 'S' || s || chr(10) || 'h' || s || '.example:1433' || chr(10) || 'db' || s || chr(10) || string_agg(t, ',' ORDER BY t)) AS h256
      FROM (SELECT s, 'dbo.' || table_name AS t FROM {rows} WHERE {condition}
            UNION SELECT DISTINCT s, '{names.HEARTBEAT_TABLE}' FROM {rows} WHERE {condition}) GROUP BY s"""


_TABLE_ID = "sha256(tenant_id || chr(10) || source_id || chr(10) || schema_name || chr(10) || table_name) AS table_id"
CTES = {
    "src": "SELECT CAST(s_suppkey AS BIGINT) AS s FROM supplier",
    "keys": "SELECT CAST(s_suppkey AS BIGINT) AS s, CAST(s_suppkey AS BIGINT) * 5 + r_regionkey AS h, replace(r_name, ' ', '_') AS name FROM supplier, region",
    "reg": f"SELECT *, {_TABLE_ID} FROM (SELECT s, h, {duck_columns(REGISTRY)} FROM keys)",
    "obs": f"SELECT *, {_TABLE_ID} FROM (SELECT s, h, {duck_columns(OBSERVATION)} FROM (SELECT * FROM keys WHERE h % 7 <> 0 UNION ALL SELECT s, s * 5 + 7, 'NEW_TABLE' FROM src WHERE s % 3 = 0))",
    "pos": f"SELECT s, {duck_columns(POSITION)} FROM src",
    "hashes": hash_sql(),
    "act": f"SELECT s, {duck_columns(ACTIVATION)} FROM (SELECT s, h256 AS true_hash FROM hashes WHERE s % 8 <> 0)",
}
_NEEDS = {"src": [], "keys": [], "reg": ["keys"], "obs": ["src", "keys"], "pos": ["src"], "hashes": ["keys", "reg"], "act": ["keys", "reg", "hashes"]}


def sql(body: str, *wanted: str) -> str:
    """Reference SQL with the fleet tables it names."""
    needed = {w for name in wanted for w in [name, *_NEEDS[name]]}
    chosen = [f"{name} AS ({text})" for name, text in CTES.items() if name in needed]
    return f"WITH {', '.join(chosen)} {body}"


REG_LIST = ", ".join(registry_ops.REGISTRY_COLUMNS)


def replaced(values: dict[str, str], condition: str, rows: str = "reg") -> str:
    """SELECT of registry columns with some replaced, and the version raised, where a condition holds."""
    values = dict(values, version="version + 1")
    columns = [f"CASE WHEN {condition} THEN {values[c]} ELSE r.{c} END AS {c}" if c in values else f"r.{c}" for c in registry_ops.REGISTRY_COLUMNS]
    return f"SELECT {', '.join(columns)} FROM {rows} r"
