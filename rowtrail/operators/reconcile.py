"""Source changes against history: every retained change must have exactly one history row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtrail.functions import lsn
from rowtrail.operators.history import in_spans

_COORDINATES = ["tenant_id", "source_id", "schema_name", "table_name", "commit_bytes", "change_bytes", "operation"]


def changes_to_reconcile(change_rows: DataFrame, tenant: str, source: str, schema: str, table: str) -> DataFrame:
    """Coordinates of raw change-table rows; the before half of an update (3) is not a change of its own."""
    kind = F.col("operation")
    return change_rows.filter(kind.isin(1, 2, 4)).select(
        F.lit(tenant).alias("tenant_id"), F.lit(source).alias("source_id"), F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"),
        F.col("start_lsn").alias("commit_bytes"), F.col("seqval").alias("change_bytes"),
        F.when(kind == 1, "DELETE").when(kind == 2, "INSERT").otherwise("UPDATE").alias("operation"))


def _spans(changes: DataFrame) -> list[dict]:
    """Range of stored position texts of each source's changes: (tenant_id, source_id, low, high); one entry a source comes to the driver.

    Texts may be in capitals or not. Capitals sort before small letters and after digits, so every text of a position within the range lies between
    its least one in capitals and its greatest one in small letters.
    """
    rows = changes.filter(F.length("commit_bytes") == 10).groupBy("tenant_id", "source_id").agg(F.min("commit_bytes").alias("low"), F.max("commit_bytes").alias("high"))
    read = rows.select("tenant_id", "source_id", F.upper(lsn.lsn_text(F.col("low"))).alias("low"), F.lower(lsn.lsn_text(F.col("high"))).alias("high"))
    return [row.asDict() for row in read.collect()]


def reconcile_source(changes: DataFrame, history: DataFrame) -> DataFrame:
    """Each change with ``matches``, its number of history rows.

    Only the history of the changes' tenants in their range of positions is read: partitions are skipped by the one, row groups by the other.
    It is counted per coordinate before the join, so copies of one event cross the shuffle as one row.
    """
    spans = _spans(changes)
    named = F.col("tenant_id").isin(sorted({s["tenant_id"] for s in spans if s["tenant_id"] is not None})) if spans else F.lit(False)
    counted = history.filter(named & in_spans(spans)).select(
        "tenant_id", "source_id", "schema_name", "table_name", lsn.lsn_bytes(F.col("commit_lsn")).alias("commit_bytes"),
        lsn.lsn_bytes(F.col("change_lsn")).alias("change_bytes"), "operation",
    ).groupBy(*_COORDINATES).agg(F.count(F.lit(1)).alias("matches"))
    return changes.join(counted, _COORDINATES, "left").withColumn("matches", F.coalesce("matches", F.lit(0)).cast("bigint"))


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("tenant_id", "source_id", "schema_name", "table_name").agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(F.col("matches") == 0).alias("missing"),
        F.count_if(F.col("matches") > 1).alias("duplicated"))
