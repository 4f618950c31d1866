"""Totals by event time over a stream whose rows are repeated and arrive out of order.

The stream keeps two states, both bounded by the watermark: the ids seen within the delay, by which repeated rows are
dropped, and the open windows. A window is written once, when the watermark has passed its end; it then holds every
row that came no later than the delay. Rows that come later are not counted in any window but counted as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.summary import exact_total
from ..sources import read_table


def in_utc(events: DataFrame) -> DataFrame:
    """The events with a moment as ``ts``; a time without a zone is in UTC, whatever the session's zone."""
    if dict(events.dtypes)["ts"] != "timestamp_ntz":
        return events
    return events.withColumn("ts", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp"))


def window_totals(events: DataFrame, window: str = "1 day") -> DataFrame:
    """(start, event_type, n, total): number and exact total of values, in hundredths, per window and type.

    For streams and tables alike; windows begin at multiples of their length since 1970 in UTC.
    """
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (
        events.withColumn("cents", cents)
        .groupBy(F.window("ts", window).alias("window"), "event_type")
        .agg(F.count("*").alias("n"), (exact_total("cents") / 100).cast("double").alias("total"))
        .select(F.col("window.start").alias("start"), "event_type", "n", "total")
    )


def ingest_windows(
    spark: SparkSession, folder: str, schema: str, target: str, progress_dir: str, delay: str = "2 days", window: str = "1 day"
) -> StreamingQuery:
    """Take in all event files not seen before, append the windows that are closed by them, then stop.

    With the progress folder an interrupted run goes on where it was; no window is written twice. ``late_rows`` of the
    ended query tells how many rows came after the watermark.
    """
    events = in_utc(spark.readStream.schema(schema).parquet(folder))
    once = events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return (
        window_totals(once, window)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", progress_dir)
        .trigger(availableNow=True)
        .start(target)
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that an ended run dropped because they came after the watermark; each is dropped by one operator."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def closed_windows(spark: SparkSession, target: str) -> DataFrame:
    """The windows written so far."""
    return read_table(spark, target)
