"""Features of a time series that use nothing from the day itself or later, and the label.

Lags and frames count *observed rows* of a series, not calendar days. All columns share one window
specification, hence one shuffle and one sort. A series has one row per day (the key of the clean
table), so its length is bounded by the number of days on record, a few thousand rows: the window
partitions stay small however large the table grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import day_number, spread, year_month
from ..model import FEATURE_IDS, FEATURES, LABEL, SERIES

_BASE = ("date", *SERIES, "average")

# Output name -> (source column, rows back): fixed values.
_LAGS = {
    "price_lag_1": ("average", 1),
    "price_lag_3": ("average", 3),
    "price_lag_7": ("average", 7),
    "volume_lag_1": ("volume", 1),
}
# Output name -> (aggregate, source column, length of the frame that ends one row back): fixed values.
_FRAMES = {
    "price_mean_7": (F.avg, "average", 7),
    "price_mean_14": (F.avg, "average", 14),
    "price_std_7": (F.stddev_samp, "average", 7),
    "volume_mean_7": (F.avg, "volume", 7),
    "spread_mean_7": (F.avg, "spread", 7),
}
LONGEST_FRAME = max(length for _, _, length in _FRAMES.values())


def _by_date():
    return Window.partitionBy(*SERIES).orderBy("date")


def lag_columns() -> dict[str, Column]:
    return {name: F.lag(source, back).over(_by_date()) for name, (source, back) in _LAGS.items()}


def rolling_columns() -> dict[str, Column]:
    return {
        name: aggregate(source).over(_by_date().rowsBetween(-length, -1))
        for name, (aggregate, source, length) in _FRAMES.items()
    }


def target_column() -> dict[str, Column]:
    return {LABEL: F.lead("average").over(_by_date())}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def lags(daily: DataFrame) -> DataFrame:
    return daily.select(*_BASE, *_named(lag_columns()))


def rolling(daily: DataFrame) -> DataFrame:
    return daily.withColumn("spread", spread()).select(*_BASE, *_named(rolling_columns()))


def target(daily: DataFrame) -> DataFrame:
    return daily.select(*_BASE, *_named(target_column()))


def features(daily: DataFrame) -> DataFrame:
    """The feature table: rows with a full set of features and a label.

    The lag of seven makes a series start with its eighth row, and the label ends it one row early.
    Frames need not be full, so the 14-row mean of that eighth row covers seven.
    """
    return (
        daily.withColumns({"spread": spread(), "dow": day_number(), **year_month()})
        .withColumns({**lag_columns(), **rolling_columns(), **target_column()})
        .na.drop(subset=[*FEATURES, LABEL])
        .select(*FEATURE_IDS, *FEATURES, LABEL)
    )
