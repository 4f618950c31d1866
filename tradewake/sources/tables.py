"""Parquet tables, and date filters that reach their partitions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_by_month(df: DataFrame, path: str, touched_only: bool = False) -> None:
    """Overwrite a table partitioned by year and month.

    ``rebalance`` brings a month's rows together so that it gets few files, while adaptive
    execution still splits a month too big for one task and merges months too small for one.
    Within a file rows are sorted by item, so that a filter on an item skips most row groups.
    With ``touched_only`` a rerun replaces just the months it has rows for.
    """
    scope = "dynamic" if touched_only else "static"
    (
        df.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", "type_id", "region_id", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", scope)
        .partitionBy("year", "month")
        .parquet(path)
    )


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def months_of(df: DataFrame) -> list[tuple[int, int]]:
    """The months with rows; as many as the calendar has, however many rows there are."""
    return sorted((row.year, row.month) for row in df.select("year", "month").distinct().collect())


def in_months(df: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of these months, by a list of literals: on a table by month the others are not listed for reading."""
    index = F.col("year") * 12 + F.col("month")
    return df.filter(F.col("year").isin(sorted({y for y, _ in months})) & index.isin([y * 12 + m for y, m in months]))


def _staged(path: str) -> str:
    return path.rstrip("/") + ".merging"


def finish_merge(spark: SparkSession, path: str) -> bool:
    """Complete a merge that was interrupted after its months were staged; says whether there was one.

    Replacing a month twice by the same rows changes nothing, so this may be repeated as often as needed. What was
    staged in part only is dropped: the table is then as it was before.
    """
    staged = _staged(path)
    complete = _exists(spark, f"{staged}/_SUCCESS")
    if complete:
        write_by_month(spark.read.parquet(staged), path, touched_only=True)
    if _exists(spark, staged):
        _delete(spark, staged)
    return complete


def merge_by_month(
    new: DataFrame, path: str, resolve: Callable[[DataFrame], DataFrame], months: list[tuple[int, int]] | None = None
) -> list[tuple[int, int]]:
    """Add rows to a table by month; returns the months that were rewritten.

    The stored rows of the months that get new ones are united with them and ``resolve`` decides between copies of a key;
    other months are neither read nor written. The united months are staged beside the table first, as a
    table cannot be overwritten while it is read, and so that an interrupted merge can be completed: nothing of a month
    is deleted before all of its rows, old and new, lie in the staged copy. ``new`` has the table's columns, is read
    twice unless ``months`` are given (pass a stored frame), and one merge may run on a table at a time. Without a
    table the rows become one.
    """
    spark = new.sparkSession
    finish_merge(spark, path)
    touched = months_of(new) if months is None else months
    if not touched:
        return []
    united = new
    if _exists(spark, path):
        stored_rows = read_table(spark, path)
        united = in_months(stored_rows, touched).unionByName(new.select(*stored_rows.columns))
    write_by_month(resolve(united), _staged(path))
    finish_merge(spark, path)
    return touched


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the last complete version of a versioned table, if there is one."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return None
    names = [status.getPath().getName() for status in files.listStatus(where)]
    numbers = [int(name.removeprefix("v")) for name in names if name.startswith("v")]
    return max((n for n in numbers if _exists(spark, f"{path.rstrip('/')}/v{n}/_SUCCESS")), default=None)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The last complete version of a table, or None."""
    number = latest_version(spark, path)
    return None if number is None else spark.read.parquet(f"{path.rstrip('/')}/v{number}")


def write_version(df: DataFrame, path: str) -> None:
    """Write a table beside its last version, from which it may have been made, and only then delete that.

    An interrupted write leaves the last version in place.
    """
    spark = df.sparkSession
    before = latest_version(spark, path)
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/v{0 if before is None else before + 1}")
    if before is not None:
        _delete(spark, f"{path.rstrip('/')}/v{before}")


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def between_months(df: DataFrame, first: tuple[int, int] | None = None, last: tuple[int, int] | None = None) -> DataFrame:
    """Rows from one (year, month) to another, both included; ``None`` leaves that end open."""
    index = F.col("year") * 12 + F.col("month")
    if first is not None:
        df = df.filter(index >= first[0] * 12 + first[1])
    if last is not None:
        df = df.filter(index <= last[0] * 12 + last[1])
    return df


def between_dates(df: DataFrame, date_from: str | date | None = None, date_to: str | date | None = None) -> DataFrame:
    """Rows from ``date_from`` to ``date_to``, both included; ``None`` or ``""`` leaves that end open.

    Spark cannot infer year and month from a date, so for tables that carry both the same bound is
    put on them too; on a partitioned table this prunes the months outside the range.
    """
    partitioned = {"year", "month"} <= set(df.columns)

    def month_index(of: str | date) -> int:
        day = of if isinstance(of, date) else date.fromisoformat(of)
        return day.year * 12 + day.month

    row_month: Column = F.col("year") * 12 + F.col("month")
    if date_from:
        df = df.filter(F.col("date") >= F.lit(date_from).cast("date"))
        if partitioned:
            df = df.filter(row_month >= month_index(date_from))
    if date_to:
        df = df.filter(F.col("date") <= F.lit(date_to).cast("date"))
        if partitioned:
            df = df.filter(row_month <= month_index(date_to))
    return df
