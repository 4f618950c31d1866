"""Ridge (or elastic-net) regression per segment."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import FeatureHasher, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions import score, usable
from ..model import LABEL, REGRESSION_CATEGORIES, REGRESSION_NUMERICS, SEED, TEST_DAYS
from ..sources.workspace import stored
from .training import drawn, keep_top_items, time_split_by_segment, with_segments

_NAIVE = "price_lag_1"
TRAINED, TOO_FEW, NOT_AMONG_LARGEST = "trained", "too few rows", "outside the largest n"


@dataclass(frozen=True)
class RidgeSettings:
    """What to fit and on which rows. Every cut is off unless it is set.

    ``top_n_items`` keeps the rows of the items with the largest volume, ``sample_fraction`` thins the
    train rows (never the test rows), ``top_n_segments`` fits only the segments with the most rows, and
    segments with fewer rows than the two floors are not fitted.
    """

    numerics: tuple[str, ...] = REGRESSION_NUMERICS
    categories: tuple[str, ...] = REGRESSION_CATEGORIES
    top_n_items: int = 0
    sample_fraction: float = 1.0
    seed: int = SEED
    top_n_segments: int | None = None
    test_days: int = TEST_DAYS
    min_rows_train: int = 2
    min_rows_test: int = 0
    hash_slots: int = 2**15
    reg_param: float = 0.1
    elastic_net: float = 0.0
    max_iter: int = 50
    tolerance: float = 1e-6
    with_current_price: bool = False  # also use today's price, which the default leaves out
    parallel_fits: int = 5  # segments fitted at the same time


VECTOR = "features_raw"


def vectorizer(settings: RidgeSettings) -> list[Transformer]:
    """Numbers and hashed categories in one sparse vector; nothing here is fitted."""
    numerics = [*settings.numerics, *(["average"] if settings.with_current_price else [])]
    stages: list[Transformer] = [VectorAssembler(inputCols=numerics, outputCol="numeric_vec", handleInvalid="keep")]
    inputs = ["numeric_vec"]
    if settings.categories:
        hasher = FeatureHasher(inputCols=list(settings.categories), outputCol="cat_vec", numFeatures=settings.hash_slots)
        stages.append(hasher)
        inputs.append("cat_vec")
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=VECTOR, handleInvalid="keep")]


def _estimators(settings: RidgeSettings) -> list[Estimator]:
    """Scaling by deviation only, as centering would make the hashed part dense, and the regression."""
    return [
        StandardScaler(inputCol=VECTOR, outputCol="features", withMean=False, withStd=True),
        LinearRegression(
            labelCol=LABEL,
            solver="l-bfgs",
            regParam=settings.reg_param,
            elasticNetParam=settings.elastic_net,
            maxIter=settings.max_iter,
            tol=settings.tolerance,
        ),
    ]


def training_frame(features: DataFrame, segments: DataFrame, settings: RidgeSettings) -> DataFrame:
    """Segmented rows, split by time, as vectors; train rows are sampled if the settings say so.

    The feature table is read once, or twice if items are cut, and only its needed columns; every later
    step starts from what was stored then. The result is stored partitioned by segment: a segment's fit
    reads its own rows only, and its passes start from finished vectors on shared storage. The names of
    the vector's slots, one per hash slot, are dropped; they would otherwise travel with every task of
    every iteration.
    """
    joined = keep_top_items(with_segments(features, segments), settings.top_n_items)
    needed = dict.fromkeys((
        "segment_id", "date", "region_id", "type_id", LABEL, _NAIVE, *settings.numerics, *settings.categories,
        *(["average"] if settings.with_current_price else []),
    ))
    split = time_split_by_segment(stored(joined.select(*needed), "segmented-rows"), settings.test_days)
    kept = split.filter((F.col("part") == "test") | drawn(settings.sample_fraction, settings.seed))
    vectors = PipelineModel(vectorizer(settings)).transform(kept).withMetadata(VECTOR, {})
    return stored(
        vectors.select("segment_id", "part", LABEL, _NAIVE, VECTOR), "training-rows", partition_by="segment_id"
    )


def _statuses(sizes: list[Row], settings: RidgeSettings) -> dict[int, str]:
    """What happens to each segment, from its numbers of train and test rows."""
    by_size = sorted(sizes, key=lambda row: (-row.train - row.test, row.segment_id))
    outside = by_size[settings.top_n_segments :] if settings.top_n_segments is not None else []
    found = {}
    for row in sizes:
        enough = row.train >= settings.min_rows_train and row.test >= settings.min_rows_test
        found[row.segment_id] = NOT_AMONG_LARGEST if row in outside else TRAINED if enough else TOO_FEW
    return found


def fit_by_segment(
    frame: DataFrame, settings: RidgeSettings = RidgeSettings(), model_dir: str | None = None
) -> tuple[dict[int, PipelineModel], DataFrame]:
    """Fit one model per segment of a training frame; returns the models and their error table.

    Each fit is a distributed MLlib job, and several run at once so that a small segment does not leave
    the cluster idle. A model takes rows of the feature table joined with the segment map. The table has a
    row for every segment and part, fitted or not: its status, the number of rows with a naive forecast and
    that forecast's errors, the number of rows with a prediction and the model's errors, from a
    single aggregation over all segments. With ``model_dir`` the models are saved there, one folder per segment.
    """
    spark = frame.sparkSession
    sizes = frame.groupBy("segment_id").agg(
        F.count_if(F.col("part") == "train").alias("train"), F.count_if(F.col("part") == "test").alias("test")
    )
    statuses = _statuses(sizes.collect(), settings)  # a row per segment
    chosen = sorted(segment for segment, status in statuses.items() if status == TRAINED)
    estimators = Pipeline(stages=_estimators(settings))

    def of(segment: int) -> DataFrame:
        return frame.filter(F.col("segment_id") == segment)

    def fit(segment: int) -> tuple[PipelineModel, DataFrame]:
        fitted = estimators.fit(of(segment).filter(F.col("part") == "train"))
        model = PipelineModel([*vectorizer(settings), *fitted.stages])
        if model_dir is not None:
            model.write().overwrite().save(f"{model_dir.rstrip('/')}/segment_id={segment}")
        return model, fitted.transform(of(segment))

    fits: list[tuple[PipelineModel, DataFrame]] = []
    if chosen:
        with ThreadPool(min(settings.parallel_fits, len(chosen))) as pool:
            fits = pool.map(inheritable_thread_target(spark)(fit), chosen)
    unfitted = frame.filter(~F.col("segment_id").isin(chosen)).withColumn("prediction", F.lit(None).cast("double"))
    columns = ["segment_id", "part", LABEL, _NAIVE, "prediction"]
    predictions = [scored.select(columns) for _, scored in fits] + [unfitted.select(columns)]
    status = spark.createDataFrame(list(statuses.items()), "segment_id int, status string")
    report = (
        reduce(DataFrame.union, predictions)
        .groupBy("segment_id", "part")
        .agg(
            F.count_if(usable(LABEL, _NAIVE)).alias("n_rows"),
            *score(LABEL, _NAIVE, "baseline_"),
            F.count_if(usable(LABEL, "prediction")).alias("n_predicted"),
            *score(LABEL, "prediction", "ridge_"),
        )
        .join(status, "segment_id")
        .orderBy("segment_id", "part")
    )
    return {segment: model for segment, (model, _) in zip(chosen, fits)}, report


def coefficients(model: PipelineModel) -> tuple[list[float], float]:
    """The slopes in the units of the inputs, and the intercept, of a fitted model."""
    scaler, regression = model.stages[-2:]
    deviation = np.asarray(scaler.std.toArray())
    slopes = np.divide(regression.coefficients.toArray(), deviation, out=np.zeros(len(deviation)), where=deviation > 0)
    return slopes.tolist(), float(regression.intercept)


def train_by_segment(
    features: DataFrame,
    segments: DataFrame,
    settings: RidgeSettings = RidgeSettings(),
    model_dir: str | None = None,
) -> tuple[dict[int, PipelineModel], DataFrame]:
    """From the feature table and the segment map to fitted models and their error table."""
    return fit_by_segment(training_frame(features, segments, settings), settings, model_dir)
