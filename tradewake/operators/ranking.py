"""Rankings, seasonality and trends.

Ties in a ranking go to the smaller id, so the cut is the same on every run. Every ranking is an
aggregate (reduced before its shuffle) followed by a top-k, which keeps k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_name, day_number, ratio, spread, year_month
from ..model import TOP_ITEMS, TREND_ITEMS
from .summary import as_bigint, exact_total, mean_price, mean_spread, price_volume_spread

# A frame of a few short columns with at most this many rows takes some megabytes in memory.
_BROADCAST_ROWS = 50_000


def item_totals(daily: DataFrame) -> DataFrame:
    """Per item everything its rankings need: volume, price, spread and days.

    The rankings take it as ``items`` so that several can share one pass; one that computes it for
    itself reads only the columns it uses.
    """
    return daily.groupBy("type_id").agg(
        exact_total().alias("exact_volume"),
        mean_price(),
        F.stddev_samp("average").alias("std_price"),
        mean_spread(),
        F.countDistinct("date").alias("days_present"),
    )


def _volume_first(by: str, total: str = "exact_volume") -> list[Column]:
    """Largest volume first. The exact total orders items whose volume is beyond a bigint, too."""
    return [F.desc(total), F.col(by)]


def top_items(daily: DataFrame, n: int = TOP_ITEMS, items: DataFrame | None = None) -> DataFrame:
    """The n items with the largest total volume."""
    largest = (item_totals(daily) if items is None else items).orderBy(*_volume_first("type_id")).limit(n)
    return largest.select(
        "type_id", as_bigint(F.col("exact_volume")).alias("total_volume"), "avg_price", "avg_spread", "days_present"
    )


def top_regions(daily: DataFrame, n: int = 20) -> DataFrame:
    """The n regions with the largest total volume."""
    totals = daily.groupBy("region_id").agg(
        exact_total().alias("exact_volume"), F.countDistinct("type_id").alias("n_items")
    )
    largest = totals.orderBy(*_volume_first("region_id")).limit(n)
    return largest.select("region_id", as_bigint(F.col("exact_volume")).alias("total_volume"), "n_items")


def date_totals(daily: DataFrame) -> DataFrame:
    """Per date the sums and counts behind the seasonal means, as many rows as days.

    Year and month are kept where the table has them.
    """
    given = {"year", "month"} <= set(daily.columns)
    values = {"average": F.col("average"), "volume": F.col("volume"), "spread": spread()}
    return daily.groupBy("date", *(["year", "month"] if given else [])).agg(
        exact_total().alias("exact_volume"),
        *(F.sum(value.cast("double")).alias(f"sum_{name}") for name, value in values.items()),
        *(F.count(value).alias(f"n_{name}") for name, value in values.items()),
    )


def _mean(name: str) -> Column:
    """Mean of a measure from the totals per date."""
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def dow_seasonality(daily: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Mean price, volume and spread per day of the week, Sunday first."""
    return (
        (date_totals(daily) if dates is None else dates)
        .groupBy(day_number().alias("dow_num"), day_name().alias("dow"))
        .agg(_mean("average").alias("avg_price"), _mean("volume").alias("avg_volume"), _mean("spread").alias("avg_spread"))
        .orderBy("dow_num")
    )


def monthly_seasonality(daily: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Mean price and spread and total volume per month; year and month are derived if absent."""
    dates = date_totals(daily) if dates is None else dates
    if "month" not in dates.columns:
        dates = dates.withColumns(year_month())
    return (
        dates.groupBy("year", "month")
        .agg(
            _mean("average").alias("avg_price"),
            as_bigint(F.sum("exact_volume")).alias("sum_volume"),
            _mean("spread").alias("avg_spread"),
        )
        .orderBy("year", "month")
    )


def volatility_rank(daily: DataFrame, n: int = 20, items: DataFrame | None = None) -> DataFrame:
    """The n items whose price varies most for its level (standard deviation over mean).

    The ratio is null, and sorts last, where the mean is zero or there is one row only.
    """
    return (
        (item_totals(daily) if items is None else items)
        .withColumn("cov", ratio(F.col("std_price"), F.col("avg_price")))
        .orderBy(F.desc("cov"), "type_id")
        .limit(n)
        .select(
            "type_id",
            F.col("avg_price").alias("mean_price"),
            "std_price",
            as_bigint(F.col("exact_volume")).alias("total_volume"),
            "cov",
        )
    )


def coverage(daily: DataFrame, n: int = 20, items: DataFrame | None = None) -> DataFrame:
    """The n items observed on the fewest days."""
    return (
        (item_totals(daily) if items is None else items)
        .select("type_id", "days_present")
        .orderBy("days_present", "type_id")
        .limit(n)
    )


def bounded(df: DataFrame, rows: int | None) -> DataFrame:
    """Mark a narrow frame for broadcast if its known bound on rows is small enough.

    Otherwise, or without a bound, Spark picks the join strategy from the sizes it measures.
    """
    return F.broadcast(df) if rows is not None and rows <= _BROADCAST_ROWS else df


def keep_ids(df: DataFrame, ids: DataFrame, name: str, at_most: int) -> DataFrame:
    """Rows whose ``name`` is among ``ids``, a frame of at most that many rows: a semi-join."""
    return df.join(bounded(ids.select(name), at_most), name, "left_semi")


def top_item_trends(daily: DataFrame, n: int = TREND_ITEMS, items: DataFrame | None = None) -> DataFrame:
    """Day by day, over all regions: price, volume and spread of the n largest items."""
    largest = (item_totals(daily) if items is None else items).orderBy(*_volume_first("type_id")).limit(n)
    return price_volume_spread(keep_ids(daily, largest, "type_id", n), "date", "type_id").orderBy("type_id", "date")
