"""Regression error metrics as aggregate expressions.

Being plain aggregates they can be computed together, for several forecasts and any grouping, in
one pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg((label - prediction) ** 2))


def mae(label: Column, prediction: Column) -> Column:
    return F.avg(F.abs(label - prediction))


def r2(label: Column, prediction: Column) -> Column:
    """1 - SSE/SST; null when the label is constant."""
    return 1 - F.try_divide(F.sum((label - prediction) ** 2), F.var_pop(label) * F.count(label))


def usable(label: str, prediction: str) -> Column:
    """Whether a row counts: both numbers are known."""
    y, p = F.col(label), F.col(prediction)
    return y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)


def score(label: str, prediction: str, prefix: str = "") -> list[Column]:
    """The three metrics, named ``<prefix>rmse``, ``<prefix>mae`` and ``<prefix>r2``.

    Only rows that are ``usable`` count.
    """
    y, p = F.col(label), F.col(prediction)
    counts = usable(label, prediction)
    y, p = F.when(counts, y), F.when(counts, p)
    return [metric(y, p).alias(prefix + metric.__name__) for metric in (rmse, mae, r2)]
