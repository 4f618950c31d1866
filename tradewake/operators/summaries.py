"""Summaries per month and item that can be merged over any range of months, without the daily rows.

Counts, totals, minima and maxima add up exactly. Distinct days and regions are kept as HyperLogLog sketches, prices as a
quantile sketch (KLL), both as binary columns of bounded size; merged sketches are as good as one made from all rows. With
the sizes below, a distinct count is within about 2 % (one standard error; exact below a few hundred), and the rank of a
quantile within about 1.3 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spread, year_month
from ..sources.tables import between_months, read_table
from .summary import as_bigint, exact_total

HLL_BITS = 12
KLL_SIZE = 200


def monthly_summaries(daily: DataFrame) -> DataFrame:
    """(year, month, type_id, counts, totals, sketches) from clean daily rows; a month of an item is one row."""
    gap = spread()
    return (
        daily.withColumns(year_month())
        .groupBy("year", "month", "type_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("average").alias("n_prices"),
            F.sum("average").alias("sum_price"),
            F.min("average").alias("min_price"),
            F.max("average").alias("max_price"),
            exact_total().alias("exact_volume"),
            F.count(gap).alias("n_spreads"),
            F.sum(gap).alias("sum_spread"),
            F.hll_sketch_agg("region_id", HLL_BITS).alias("regions"),
            F.hll_sketch_agg(F.unix_date("date"), HLL_BITS).alias("days"),
            F.kll_sketch_agg_double("average", KLL_SIZE).alias("prices"),
        )
    )


def write_summaries(summaries: DataFrame, path: str) -> None:
    """Write the months of these summaries, each as a whole; other months stay."""
    (
        summaries.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", "type_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def read_summaries(
    spark: SparkSession, path: str, first: tuple[int, int] | None = None, last: tuple[int, int] | None = None
) -> DataFrame:
    """The summaries from one (year, month) to another, both included; other months are not listed for reading."""
    return between_months(read_table(spark, path), first, last)


def merged(summaries: DataFrame, *by: str, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """One row for each value of ``by`` (all together without any) over all months given, in the measures of the reports.

    ``n_regions`` and ``days_present`` are estimates, ``price_q<n>`` the price at n per cent of the rows, null without prices.
    """
    united = summaries.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        as_bigint(F.sum("exact_volume")).alias("total_volume"),
        F.try_divide(F.sum("sum_price"), F.sum("n_prices")).alias("avg_price"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.try_divide(F.sum("sum_spread"), F.sum("n_spreads")).alias("avg_spread"),
        F.hll_sketch_estimate(F.hll_union_agg("regions")).alias("n_regions"),
        F.hll_sketch_estimate(F.hll_union_agg("days")).alias("days_present"),
        F.sum("n_prices").alias("n_prices"),
        F.kll_merge_agg_double("prices").alias("prices"),
    )

    def quantile(q: float) -> Column:
        return F.when(F.col("n_prices") > 0, F.kll_sketch_get_quantile_double("prices", F.lit(q)))

    return united.withColumns({f"price_q{round(100 * q)}": quantile(q) for q in quantiles}).drop("prices", "n_prices")
