"""Daily CSV files, compressed or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..model import RAW_SCHEMA


def read_archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read ``.csv``, ``.csv.gz`` and ``.csv.bz2`` files (paths, folders or globs) in one scan.

    The codec is chosen per file by its suffix, so nothing is unpacked to disk first. Columns are
    matched by position under the fixed schema; a cell that does not parse becomes null and its
    row is kept for the cleaning rules to judge. A gz file is read by one task, which is fine for
    files of one day each; the deduplication that follows spreads the rows by key.
    """
    names = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.csv(names, schema=RAW_SCHEMA, header=True, mode="PERMISSIVE")
