"""Deterministic identities: every id is a SHA-256 over fixed text, never over a clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def event_id(tenant: Column, source: Column, incarnation: Column, schema: Column, table: Column,
             commit: Column, change: Column, serial: Column, operation: Column, key: Column) -> Column:
    """Hash of the JSON array of an event's coordinates; replays of an event share it.

    ``key`` is canonical JSON already, so it is spliced in as it stands rather than escaped.
    """
    head = F.to_json(F.array(tenant, source, incarnation, schema, table, commit, change))
    opened = F.substring(head, F.lit(1), F.length(head) - F.lit(1))
    return sha256(F.concat(opened, F.lit(","), serial.cast("string"), F.lit(',"'), operation, F.lit('",'), key, F.lit("]")))


def table_id(tenant: Column, source: Column, schema: Column, table: Column) -> Column:
    return sha256(F.concat_ws("\n", tenant, source, schema, table))


def configuration_hash(tenant: Column, source: Column, host: Column, port: Column, database: Column, tables: Column) -> Column:
    """Hash over a source's address and its sorted distinct captured tables (heartbeat table included)."""
    joined = F.array_join(F.sort_array(F.array_distinct(tables)), ",")
    address = F.concat(host, F.lit(":"), port.cast("string"))
    return sha256(F.concat_ws("\n", tenant, source, address, database, joined))
