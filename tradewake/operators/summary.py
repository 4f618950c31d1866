"""The daily measures that several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spread


def mean_price() -> Column:
    return F.avg("average").alias("avg_price")


def mean_spread() -> Column:
    return F.avg(spread()).alias("avg_spread")


def exact_total(name: str = "volume") -> Column:
    """Total of a bigint column as a decimal, which can hold it whatever the number of rows."""
    return F.sum(F.col(name).cast("decimal(19,0)"))


def as_bigint(total: Column) -> Column:
    """A total as a bigint; null, rather than an error, beyond its range."""
    return total.try_cast("bigint")


def price_volume_spread(rows: DataFrame, *by: str) -> DataFrame:
    """Mean price, total volume and mean spread per group."""
    return rows.groupBy(*by).agg(mean_price(), as_bigint(exact_total()).alias("sum_volume"), mean_spread())
