"""Register of the queries: a Spark callable and, where SQL can say the same, its reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its result is returned with plain column types."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(function(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain(frame: DataFrame) -> DataFrame:
    """Instants without zone (they are UTC), bytes as hex and nested values as JSON, for comparison elsewhere."""
    def column(name: str, data_type: str):
        if data_type == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if data_type == "binary":
            return F.lower(F.hex(name)).alias(name)
        if data_type.startswith(("array", "map", "struct")):
            return F.to_json(name).alias(name)
        return F.col(name)

    return frame.select(*[column(name, data_type) for name, data_type in frame.dtypes])


def with_ctes(ctes: dict[str, str], wanted: list[str], body: str) -> str:
    """SQL text with the named common table expressions before it, in the order they are defined."""
    chosen = [f"{name} AS ({text})" for name, text in ctes.items() if name in wanted]
    return f"WITH {', '.join(chosen)} {body}"
