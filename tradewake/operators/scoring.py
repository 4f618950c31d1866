"""Predictions of many linear models at once, from a table of their coefficients.

The table has a row for each segment and slot of the vector, and one for the intercept (slot -1); slopes are in the units
of the inputs. Rows are exploded to the slots they fill, joined with the table and summed, so any number of models costs one
pass, and no model is loaded for itself.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import score, usable
from ..model import KEY, LABEL
from ..sources.workspace import stored
from .ranking import bounded

COEFFICIENTS = "segment_id int, slot int, slope double"
INTERCEPT = -1
_VECTOR_FIELDS = "type tinyint, size int, indices array<int>, values array<double>"


def entries_of(vector: Column) -> Column:
    """The filled slots of a vector, given as its stored structure, as an array of (slot, value)."""
    slots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    slots = F.when(F.size(vector["values"]) > 0, slots).otherwise(F.array().cast("array<int>"))
    return F.arrays_zip(slots.alias("slot"), vector["values"].alias("value"))


def saved_coefficients(spark: SparkSession, model_dir: str) -> DataFrame:
    """(segment_id, slot, slope) of all models saved below a folder, by one read of their scalers and one of their fits.

    A slope is the fitted one over the scaler's deviation; slots that were constant in training have none.
    """

    def saved(stage: str, fields: str) -> DataFrame:
        files = spark.read.schema(fields).parquet(f"{model_dir.rstrip('/')}/segment_id=*/stages/*_{stage}_*/data")
        segment = F.regexp_extract(F.col("_metadata.file_path"), "segment_id=(-?[0-9]+)/stages", 1).cast("int")
        return files.select(segment.alias("segment_id"), "*")

    fits = saved("LinearRegression", f"intercept double, coefficients struct<{_VECTOR_FIELDS}>")
    scalers = saved("StandardScaler", f"std struct<{_VECTOR_FIELDS}>")
    slopes = fits.select("segment_id", F.inline(entries_of(F.col("coefficients"))))
    deviations = scalers.select("segment_id", F.inline(entries_of(F.col("std")))).filter("value > 0")
    return (
        slopes.join(deviations.withColumnRenamed("value", "std"), ["segment_id", "slot"])
        .select("segment_id", "slot", (F.col("value") / F.col("std")).alias("slope"))
        .union(fits.select("segment_id", F.lit(INTERCEPT), "intercept"))
    )


def saved_vectorizer(spark: SparkSession, model_dir: str) -> PipelineModel:
    """The stages before the scaler, which all models of a folder share and none of which is fitted."""
    first = saved_coefficients(spark, model_dir).agg(F.min("segment_id")).first()[0]
    if first is None:
        raise ValueError(f"no models in {model_dir}")
    return PipelineModel(PipelineModel.load(f"{model_dir.rstrip('/')}/segment_id={first}").stages[:-2])


def predicted(rows: DataFrame, coefficients: DataFrame, vector: str, at_most: int | None = None) -> DataFrame:
    """The rows, without their vector, with the prediction of their segment's model; null where there is none.

    ``coefficients`` is a stored table; it is broadcast if it is known to have ``at_most`` so many rows, few enough, and
    otherwise joined as Spark sees fit. Rows alike in all columns but the vector must not occur; the key keeps them apart.
    """
    names = [name for name in rows.columns if name != vector]
    slots = F.concat(
        F.array(F.struct(F.lit(INTERCEPT).alias("slot"), F.lit(1.0).alias("value"))), entries_of(F.unwrap_udt(F.col(vector)))
    )
    filled = rows.select(*names, F.inline(slots))
    joined = filled.join(bounded(coefficients, at_most), ["segment_id", "slot"], "left")
    # A slot that no model has seen adds nothing; a row without an intercept has no model.
    part = F.when(F.col("slot") == INTERCEPT, F.col("slope")).otherwise(F.col("value") * F.coalesce("slope", F.lit(0.0)))
    has_model = F.max(F.when(F.col("slot") == INTERCEPT, F.col("slope").isNotNull()))
    return (
        joined.groupBy(*names)
        .agg(F.sum(part).alias("total"), has_model.alias("has_model"))
        .select(*names, F.when(F.col("has_model"), F.col("total")).alias("prediction"))
    )


def score_saved(rows: DataFrame, model_dir: str) -> DataFrame:
    """(segment_id, key, label, prediction) for segmented feature rows, from the models saved below a folder."""
    spark = rows.sparkSession
    coefficients = stored(saved_coefficients(spark, model_dir), "coefficients")
    vectors = saved_vectorizer(spark, model_dir)
    output = vectors.stages[-1].getOutputCol()
    table = vectors.transform(rows).withMetadata(output, {}).select("segment_id", *KEY, LABEL, output)
    return predicted(table, coefficients, output, coefficients.count())


def errors(rows: DataFrame, *by: str) -> DataFrame:
    """Number of rows with a prediction and its errors, per group."""
    return rows.groupBy(*by).agg(F.count_if(usable(LABEL, "prediction")).alias("n_predicted"), *score(LABEL, "prediction"))
