"""Source health: warnings by precedence, pipeline status, carry-forward and staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits behind the warnings.
SCAN_STALE_SECONDS = 300
MINIMUM_FREE_BYTES = 2 * 1024 * 1024 * 1024
MINIMUM_FREE_PAGES = 131072
MINIMUM_HEADROOM_SECONDS = 7 * 86400
PROGRESS_STALE_SECONDS = 120
BACKLOG_LIMIT = 100_000
INITIALIZATION_SECONDS = 120
OBSERVATION_STALE_SECONDS = 120
HEALTH_INTERVALS = 3
SQL_STATE_PATTERN = r"\A[A-Za-z0-9]{5}\z"


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def source_warning(metrics: DataFrame) -> DataFrame:
    """The most important warning of each source, null when all is well."""
    warning = (
        F.when(_true(F.col("retention_minutes") < F.col("minimum_minutes")), "CDC_RETENTION_BELOW_14_DAYS")
        .when(~_true(F.col("capture_running")) & ~_true(F.col("job_state_unavailable")), "CDC_CAPTURE_JOB_STOPPED")
        .when(_true(F.col("recent_errors")), "CDC_CAPTURE_ERRORS")
        .when(_true(F.col("scan_age_s") > SCAN_STALE_SECONDS), "CDC_SCAN_STALE")
        .when(_true(F.col("free_bytes") < MINIMUM_FREE_BYTES) | _true(F.col("capped_free_pages") < MINIMUM_FREE_PAGES), "SOURCE_STORAGE_LOW")
        .when(_true(F.col("headroom_s") < MINIMUM_HEADROOM_SECONDS), "CDC_RETENTION_HEADROOM_LOW")
        .when(_true(F.col("job_state_unavailable")), "CDC_JOB_STATE_METRICS_UNAVAILABLE")
        .when(_true(F.col("volume_unavailable")), "PHYSICAL_DISK_METRICS_UNAVAILABLE")
    )
    return metrics.withColumn("warning", warning)


def pipeline_status(runtime: DataFrame) -> DataFrame:
    """State, message and the two partial states of each source.

    A suspension or failed refresh shows only where no warning does; stale progress and then a high
    backlog replace whatever was there.
    """
    warning = F.coalesce(
        F.when(F.col("backlog") > BACKLOG_LIMIT, "BROKER_BACKLOG_HIGH"),
        F.when(F.col("progress_age_s") > PROGRESS_STALE_SECONDS, "CAPTURE_PROGRESS_STALE"),
        F.col("warning"),
        F.when(_true(F.col("unacknowledged_suspension")), "TABLE_CAPTURE_SUSPENDED"),
        F.when(_true(F.col("failed_refresh")), "CAPTURE_SCHEMA_REFRESH_FAILED"))
    failure = F.col("consumer_failure")
    return runtime.withColumn("effective_warning", warning).select(
        "tenant_id", "source_id",
        F.when(failure.isNotNull(), "ERROR").when(F.col("effective_warning").isNotNull(), "DEGRADED").otherwise("RUNNING").alias("state"),
        F.coalesce(F.concat(F.lit("CONSUMER_"), failure), F.col("effective_warning"), F.lit("CAPTURE_AND_CONSUMER_RUNNING")).alias("message"),
        F.when(F.col("effective_warning").isNull(), "RUNNING").otherwise("DEGRADED").alias("capture_state"),
        F.when(failure.isNull(), "RUNNING").otherwise("ERROR").alias("consumer_state"))


def status_merge(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """New status rows over the previous ones: an event time never goes back, a missing reading keeps the last.

    Sources that report nothing this time keep their previous row.
    """
    if old is None:
        return new
    carried = ["last_commit_lsn", "retention_minutes", "retention_headroom_seconds"]
    joined = new.alias("n").join(old.alias("o"), "source_id", "full_outer")
    reported = F.col("n.updated_at").isNotNull()

    def value(column: str) -> Column:
        if column == "source_id":
            return F.col("source_id")
        if column == "last_event_at":
            return F.greatest(F.col("n.last_event_at"), F.col("o.last_event_at")).alias(column)
        if column in carried:
            return F.coalesce(F.col(f"n.{column}"), F.col(f"o.{column}")).alias(column)
        return F.when(reported, F.col(f"n.{column}")).otherwise(F.col(f"o.{column}")).alias(column)

    return joined.select(*[value(c) for c in new.columns])


def _age_seconds(column: str, now) -> Column:
    return F.timestamp_diff("SECOND", F.col(column), F.lit(now))


def stale_status(status: DataFrame, now, limit_seconds: int, column: str = "updated_at") -> DataFrame:
    return status.withColumn("stale", _age_seconds(column, now) > limit_seconds)


def fleet_health(status: DataFrame, now, monitor_interval_seconds: int) -> DataFrame:
    """UP only with at least one source and every one running and fresher than three monitor intervals."""
    limit = F.lit(now) - F.make_dt_interval(secs=F.lit(HEALTH_INTERVALS * monitor_interval_seconds))
    healthy = _true((F.col("state") == "RUNNING") & (F.col("updated_at") > limit))
    return status.agg(
        F.count(F.lit(1)).alias("source_count"),
        F.count_if(healthy).alias("healthy_count"),
    ).withColumn("health", F.when((F.col("source_count") > 0) & (F.col("source_count") == F.col("healthy_count")), "UP").otherwise("DOWN"))


def safe_diagnostic(causes: Column, shown: int | None = None) -> Column:
    """Fixed code of a failure's chain of causes, outermost first; messages never enter it. All causes, or the first ``shown``.

    Each cause holds ``class_name``, ``known_code`` (the service's own failures), ``sql_state`` and ``sql_code``.
    """
    def described(cause: Column) -> Column:
        state = F.when(_true(cause["sql_state"].rlike(SQL_STATE_PATTERN)), F.concat(F.lit("_SQLSTATE_"), cause["sql_state"])).otherwise("")
        sql = F.when(cause["sql_code"].isNotNull(), F.concat(state, F.lit("_SQLCODE_"), cause["sql_code"].cast("string"))).otherwise("")
        return F.concat(F.lit("_"), cause["class_name"], sql)

    chain = F.array_join(F.transform(causes if shown is None else F.slice(causes, 1, shown), described), "")
    return F.coalesce(F.try_element_at(causes, F.lit(1))["known_code"], F.concat(F.lit("DEPENDENCY_FAILURE"), chain))


def initialization_window(activation: DataFrame, codes: DataFrame, now) -> DataFrame:
    """State per source whose position has a code: a first activation may lack its position for two minutes."""
    tolerated = (
        F.col("first_activation") & (_age_seconds("created_at", now) < INITIALIZATION_SECONDS)
        & F.col("error_code").isin("SOURCE_OFFSETS_MISSING_OR_AMBIGUOUS", "SOURCE_INITIALIZATION_INCOMPLETE"))
    return codes.join(activation.select("source_id", "created_at", "first_activation"), "source_id").select(
        "source_id",
        F.when(F.col("error_code").isNull(), "RUNNING").when(tolerated, "STARTING").otherwise("ERROR").alias("state"),
        F.when(F.col("error_code").isNull(), F.lit(None)).when(tolerated, "SOURCE_INITIALIZING").otherwise(F.col("error_code")).alias("message"))


def storage_minimum(files: DataFrame) -> DataFrame:
    """Least free bytes, and least free pages of the size-capped data files, per source."""
    capped = (F.col("file_type") == 0) & (F.col("max_pages") > 0)
    return files.groupBy("tenant_id", "source_id").agg(
        F.min("free_bytes").alias("free_bytes"),
        F.min(F.when(capped, F.col("max_pages") - F.col("used_pages"))).alias("capped_free_pages"))


def latest_scan(sessions: DataFrame) -> DataFrame:
    """Latest scan session per source; session 0 holds totals and does not count."""
    return sessions.filter(F.col("session_id") != 0).groupBy("tenant_id", "source_id").agg(
        F.max(F.struct("session_id", "start_time", "end_time", "error_count")).alias("s")).select("tenant_id", "source_id", "s.*")


def recent_scans(sessions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` sessions with the greatest ids."""
    return sessions.orderBy(F.col("session_id").desc(), F.col("source_id")).limit(n)
