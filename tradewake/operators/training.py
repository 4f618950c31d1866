"""Steps from the feature table to the rows a model is trained on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import present, score
from ..model import KEY, LABEL, REGRESSION_CATEGORIES, SEED, TEST_DAYS
from .ranking import keep_ids
from .summary import exact_total


def with_segments(features: DataFrame, segments: DataFrame) -> DataFrame:
    """Attach each item's segment; rows without label or key, and items without segment, are left out.

    The ids are joined as numbers and become text afterwards, the form in which they are hashed as
    categories. The map has a row per item: Spark broadcasts it when its measured size allows, and
    otherwise shuffles, with adaptive execution splitting the partition of a hot item.
    """
    known = features.filter(present(features, LABEL, *KEY))
    labels = segments.select(
        F.col("type_id").cast("int").alias("type_id"), F.col("segment_id").cast("int").alias("segment_id")
    )
    labels = labels.filter(present(labels, *labels.columns))
    return known.join(labels, "type_id").withColumns(
        {name: F.col(name).cast("string") for name in REGRESSION_CATEGORIES}
    )


def keep_top_items(frame: DataFrame, n: int) -> DataFrame:
    """Rows of the n items with the largest total of yesterday's volume.

    No cut for n <= 0, nor when there is no volume column. The frame is read twice (ranking, then
    rows), so pass one that is cheap to read.
    """
    volume = next((c for c in ("volume_lag_1", "volume") if c in frame.columns), None)
    if n <= 0 or volume is None:
        return frame
    largest = (
        frame.groupBy("type_id")
        .agg(exact_total(volume).alias("total_volume"))
        .orderBy(F.desc("total_volume"), F.col("type_id").cast("int"))
        .limit(n)
    )
    return keep_ids(frame, largest, "type_id", n)


def key_draw(seed: int = SEED, key: tuple[str, ...] = KEY) -> Column:
    """A number in [0, 2**32) that depends on the row's key and the seed only.

    It is taken from the MD5 digest of the key's text, so ids give the same draw as numbers and as
    text, and other engines can compute it too.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(name).cast("string") for name in key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def drawn(fraction: float, seed: int = SEED) -> Column:
    """Whether a row belongs to the sample of this fraction; a fraction outside (0, 1) takes all."""
    return key_draw(seed) < F.lit(int(fraction * 2**32)) if 0 < fraction < 1 else F.lit(True)


def hash_sample(frame: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Each row with probability ``fraction``, decided by a draw from its key.

    Unlike ``sample`` it picks the same rows under any partitioning. A fraction outside (0, 1) means
    no sampling.
    """
    return frame.filter(drawn(fraction, seed)) if 0 < fraction < 1 else frame


def largest_segments(frame: DataFrame, n: int) -> DataFrame:
    """The n segments with the most rows, ties to the smaller id, each with its last date."""
    return (
        frame.groupBy("segment_id")
        .agg(F.count("*").alias("n_rows"), F.max("date").alias("last_date"))
        .orderBy(F.desc("n_rows"), "segment_id")
        .limit(n)
    )


def _part(last_date: Column, test_days: int) -> Column:
    return F.when(F.col("date") >= F.date_sub(last_date, test_days), "test").otherwise("train").alias("part")


def time_split(frame: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """Add ``part``: test from ``test_days`` before the last date on (that day included), else train.

    The last date is a scalar subquery. Both ends count, so 60 days give 61 test dates.
    """
    return frame.select("*", _part(frame.agg(F.max("date")).scalar(), test_days))


def time_split_by_segment(frame: DataFrame, test_days: int = TEST_DAYS) -> DataFrame:
    """As ``time_split``, with each segment's own last date.

    The last dates are aggregated and joined back, as a window over a segment would pull all of its
    rows into one task. How many segments there are is not known here, so the join is left to Spark.
    """
    last_dates = frame.groupBy("segment_id").agg(F.max("date").alias("last_date"))
    return frame.join(last_dates, "segment_id").select(*frame.columns, _part(F.col("last_date"), test_days))


def baseline_metrics(split: DataFrame) -> DataFrame:
    """Errors of the naive forecast per segment and part: the next price will be yesterday's."""
    if "price_lag_1" not in split.columns:
        raise ValueError("the naive forecast needs the column price_lag_1")
    return split.groupBy("segment_id", "part").agg(*score(LABEL, "price_lag_1"))
