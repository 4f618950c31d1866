"""Data-quality reports, each a handful of rows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pearson, present, spread

# Report columns: fixed values.
_MEASURES = ("average", "highest", "lowest", "order_count", "volume")
_NULL_CHECKS = {
    "date": "date_nulls", "region_id": "region_nulls", "type_id": "type_nulls",
    "average": "average_nulls", "volume": "volume_nulls",
}
_NEGATIVE_CHECKS = {
    "average": "avg_negative", "highest": "highest_negative",
    "lowest": "lowest_negative", "volume": "volume_negative",
}


def overview(daily: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, date range, and the number of regions, items and days.

    ``approximate`` swaps the exact distinct counts for sketches, where a rough figure will do.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return daily.agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        distinct("region_id").alias("n_regions"),
        distinct("type_id").alias("n_items"),
        distinct("date").alias("n_days"),
    )


def measures(daily: DataFrame) -> DataFrame:
    """Everything the four reports below need, as one row from one pass.

    They take it as ``totals`` to share that pass; one that computes it for itself reads only the
    columns it uses.
    """

    def summary(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("measure"),
            F.count(name).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    names = ("average", "volume", "spread")
    rows = daily.withColumn("spread", spread())
    known = present(rows, *names)
    return rows.agg(
        F.array(*map(summary, _MEASURES)).alias("summaries"),
        *(F.count_if(F.col(c).isNull()).alias(label) for c, label in _NULL_CHECKS.items()),
        *(F.count_if(F.col(c) < 0).alias(label) for c, label in _NEGATIVE_CHECKS.items()),
        F.count_if(F.col("highest") < F.col("lowest")).alias("highest_lt_lowest"),
        *(
            pearson(*(F.when(known, F.col(name)) for name in pair)).alias(f"corr_{'_'.join(pair)}")
            for pair in combinations(names, 2)
        ),
    )


def describe_prices(daily: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of the five measures.

    One aggregate row is turned into one row per measure, keeping numbers as numbers.
    """
    return (measures(daily) if totals is None else totals).select(F.inline("summaries"))


def missing_values(daily: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Number of nulls in the key columns, the price and the volume."""
    return (measures(daily) if totals is None else totals).select(*_NULL_CHECKS.values())


def sanity_checks(daily: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Number of rows that break each validity rule; a null breaks none."""
    return (measures(daily) if totals is None else totals).select(*_NEGATIVE_CHECKS.values(), "highest_lt_lowest")


def correlations(daily: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Pearson correlation of average price, volume and spread, pair by pair, over rows that have all three."""
    pairs = combinations(("average", "volume", "spread"), 2)
    return (measures(daily) if totals is None else totals).select(*(f"corr_{x}_{y}" for x, y in pairs))


def columns_of(daily: DataFrame) -> DataFrame:
    """Name, type and nullability of every column."""
    rows = [(field.name, field.dataType.simpleString(), field.nullable) for field in daily.schema]
    return daily.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean")
