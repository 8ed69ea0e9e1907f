"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.session import run_folder

#: Fixed: what separates words in every contract of this package (space and tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
#: Fixed: the same set as single characters.
SPACES = " \t\n\x0b\x0c\r"

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 256
#: Tables of ids with at most this many rows (tens of MB), counted first, are broadcast; larger ones are joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts can be long: hand few of them at a time to Python, so that a worker's memory stays bounded."""
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def held(frame: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: it is computed once and outlives lost executors.

    Nobody looks for a marker of success there, so the driver writes none.
    """
    spark = frame.sparkSession
    path = run_folder(spark, name)
    frame.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Remove a step that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_or_shuffled(frame: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a table of ids and flags if it is counted to be small; else no hint."""
    return F.broadcast(frame) if frame.limit(max_rows + 1).count() <= max_rows else frame


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def free_name(frame: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet, whatever the case of its letters."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
