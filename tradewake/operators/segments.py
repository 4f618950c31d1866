"""Robust statistics per item, and k-means segments over them."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import log_size, median, relative_spread
from ..model import MIN_ITEM_ROWS, SEED, SEGMENT_INPUTS, SEGMENTS
from ..sources.workspace import stored
from . import kmeans


def type_stats(daily: DataFrame, min_rows: int = MIN_ITEM_ROWS) -> DataFrame:
    """Medians and deviations of log price, log volume and relative spread per item.

    Items with fewer than ``min_rows`` rows are left out. Without highest and lowest the relative
    spread counts as zero.

    The regions are counted apart, from the two id columns: inside the main aggregation an exact
    distinct count would have every median sketched per item *and* region, which takes twice as
    long. Both sides come out of their aggregation partitioned by item, so joining them moves
    nothing. ``daily`` is read twice; pass one that is cheap to read.
    """
    with_spread = {"highest", "lowest"} <= set(daily.columns)
    rows = daily.select(
        "type_id",
        log_size("average").alias("log_price"),
        log_size("volume").alias("log_volume"),
        (relative_spread() if with_spread else F.lit(0.0)).alias("spread_rel"),
    )
    statistics = rows.groupBy("type_id").agg(
        F.count("*").alias("n_rows"),
        median("log_price").alias("log_price_med"),
        F.stddev_samp("log_price").alias("log_price_std"),
        median("log_volume").alias("log_vol_med"),
        F.stddev_samp("log_volume").alias("log_vol_std"),
        median("spread_rel").alias("spread_rel_med"),
    )
    regions = daily.groupBy("type_id").agg(F.countDistinct("region_id").alias("n_regions"))
    return (
        statistics.filter(F.col("n_rows") >= min_rows)
        .join(regions, "type_id")
        # An item with a single row has no deviation.
        .na.fill(0.0, subset=["log_price_std", "log_vol_std"])
        .select("type_id", "n_rows", "n_regions", *(name for name in SEGMENT_INPUTS if name != "n_regions"))
    )


def _standardizer(output: str) -> list:
    """Stages that put the six statistics on a common scale; a constant one becomes zero."""
    return [
        VectorAssembler(inputCols=list(SEGMENT_INPUTS), outputCol="stats_vec"),
        StandardScaler(inputCol="stats_vec", outputCol=output, withMean=True, withStd=True),
    ]


def zscores(stats: DataFrame) -> DataFrame:
    """The standardized statistics as columns ``z_<name>``."""
    stages = Pipeline(stages=_standardizer("z")).fit(stats)
    values = vector_to_array("z")
    return stages.transform(stats).select(
        "type_id", *(values[i].alias(f"z_{name}") for i, name in enumerate(SEGMENT_INPUTS))
    )


class SegmentModel(PipelineModel):
    """A fitted segmentation: adds ``segment_id`` to items with the six statistics. Saved and loaded as a pipeline."""

    def __init__(self, names: list[str], means: list[float], deviations: list[float], centers: list[tuple[float, ...]]):
        values = [kmeans.scaled(*column) for column in zip(names, means, deviations)]
        label = kmeans.nearest(values, centers)
        known = " and ".join(f"`{name}` is not null" for name in names)
        statement = f"select *, case when {known} then {label} end as segment_id from __THIS__"
        super().__init__([SQLTransformer(statement=statement)])
        self.centers = centers


def fit_segments(stats: DataFrame, k: int = SEGMENTS, seed: int = SEED) -> tuple[SegmentModel, DataFrame]:
    """Cluster the items; returns the fitted model and item -> segment with the statistics.

    The statistics are stored first: the fit reads them many times, and the aggregation behind them
    is the heavy part. Every step of the fit is an aggregation over all items whose result does not
    depend on their layout (see ``kmeans``), and segments are numbered by centroid. The same items thus get the
    same segments under any partitioning, and the model gives other items the map's labels. An item that lacks a
    statistic has no segment.
    """
    stats = stored(stats, "type-stats")
    names = list(SEGMENT_INPUTS)
    known = stats.na.drop(subset=names)
    if known.isEmpty():
        raise ValueError("there are no items to segment; type_stats leaves out items with few rows (min_rows)")
    means, deviations = kmeans.standardizer(known, names)
    z = [f"z_{name}" for name in names]
    scores = [F.expr(kmeans.scaled(*column)).alias(z_name) for z_name, *column in zip(z, names, means, deviations)]
    points = stored(known.select("type_id", *scores), "type-points")
    model = SegmentModel(names, means, deviations, kmeans.fit(points, "type_id", z, k, seed))
    return model, model.transform(stats).select("type_id", "segment_id", *SEGMENT_INPUTS, "n_rows")


def centers_of(model: SegmentModel) -> list[tuple[float, ...]]:
    """The centroids on the common scale, in the order of the segments."""
    return model.centers
