"""Incremental form of the transform job: new archives in a folder are validated and appended.

The stream keeps no state. Copies of a key are resolved when the table is read, which gives exactly
the rows of a batch run over the same files, however late a better copy arrives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions import year_month
from ..model import RAW_SCHEMA
from ..operators.cleaning import latest_per_key, parse_times, valid_rows
from ..sources import read_table


def new_archives(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the rows of each archive that appears in the folder."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("header", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def ingest(
    spark: SparkSession, folder: str, target: str, progress_dir: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Append the valid rows of all archives not seen before, by year and month, then stop.

    The progress folder remembers the archives; with it, an interrupted run goes on where it was and
    no row is written twice.
    """
    rows = valid_rows(parse_times(new_archives(spark, folder, files_per_batch))).withColumns(year_month())
    return (
        rows.writeStream.format("parquet")
        .partitionBy("year", "month")
        .option("checkpointLocation", progress_dir)
        .trigger(availableNow=True)
        .start(target)
    )


def daily_view(spark: SparkSession, target: str) -> DataFrame:
    """The clean daily table over everything ingested so far."""
    return latest_per_key(read_table(spark, target))
