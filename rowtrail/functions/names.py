"""Qualified table names and identifier rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier shapes and the names this service keeps for itself.
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*"
QUALIFIED_IDENTIFIER = rf"\A{IDENTIFIER}\.{IDENTIFIER}\z"
DATABASE_IDENTIFIER = rf"\A{IDENTIFIER}\z"
ID_PATTERN = r"\A[A-Za-z0-9_-]{1,64}\z"
HOST_PATTERN = r"\A[A-Za-z0-9.-]+\z"
SERVICE_MARKER = "capture_"
HEARTBEAT_TABLE = "dbo.Capture_Heartbeat"
CONNECTOR_PREFIX = "capture"
CONNECTOR_HEARTBEAT = "__debezium-heartbeat."


def qualified(schema: Column, table: Column) -> Column:
    return F.concat(schema, F.lit("."), table)


def split_qualified(name: Column) -> Column:
    """Schema and table of a qualified name; only the first dot separates."""
    parts = F.split(name, r"\.", 2)
    return F.struct(parts[0].alias("schema_name"), parts[1].alias("table_name"))


def connector_name(tenant: Column, source: Column, prefix: str = CONNECTOR_PREFIX) -> Column:
    return F.concat_ws("-", F.lit(prefix), tenant, source)


def service_owned(table: Column, marker: str = SERVICE_MARKER) -> Column:
    return F.contains(F.lower(table), F.lit(marker.lower()))
