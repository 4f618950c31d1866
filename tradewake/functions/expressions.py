"""Scalar and aggregate expressions shared by the operators.

They hold under ANSI mode, Spark's default: where plain arithmetic would stop the job
(division by zero, correlation with a constant) they give null.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import EPSILON


def spread() -> Column:
    """Day's price range."""
    return (F.col("highest") - F.col("lowest")).cast("double")


def relative_spread() -> Column:
    """Range as a share of the average price; the epsilon keeps a free item finite."""
    return F.try_divide(spread(), F.col("average") + F.lit(EPSILON))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def log_size(name: str) -> Column:
    """log(1 + x) of a price or a volume."""
    return F.log1p(F.col(name).cast("double"))


def day_number(name: str = "date") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(name)


def day_name(name: str = "date") -> Column:
    """Sun, Mon, ..."""
    return F.date_format(name, "E")


def year_month(name: str = "date") -> dict[str, Column]:
    return {"year": F.year(name), "month": F.month(name)}


def median(name: str) -> Column:
    """Approximate median: a value that occurs in the data, the lower middle for even counts.

    The partial state is a sketch of bounded size, so a hot group costs no memory.
    """
    return F.percentile_approx(name, 0.5)


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation; null when either side is constant (``corr`` would raise)."""
    return ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def present(df: DataFrame, *names: str) -> Column:
    """All of these columns are known: not null and, for floating numbers, not NaN.

    Written as separate conditions, which Spark can push down to a scan.
    """
    kinds = dict(df.dtypes)
    rules = [F.col(name).isNotNull() for name in names]
    rules += [~F.isnan(name) for name in names if kinds[name] in ("double", "float")]
    return reduce(and_, rules)
