"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


#: Fixed: HotSpot never compiles a longer method; beyond it Spark evaluates a stage by smaller methods, which are compiled.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def configure(spark: SparkSession) -> SparkSession:
    """Set the two SQL settings the operators' results depend on, and one of speed unless the session has its own.

    Times are UTC instants, and a repeated JSON name keeps its last value as JSON readers usually do.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    if spark.conf.get(HUGE_METHOD[0], "65535") == "65535":
        spark.conf.set(*HUGE_METHOD)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it; a private one only where unset."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rowtrail-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def run_name() -> str:
    """A name no other run has."""
    return uuid.uuid4().hex


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path for one run below the shared folder; never reused, so a rerun cannot see old files."""
    return f"{shared_folder(spark)}/{name}-{run_name()}"
