import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tradewake.model import KEY, LABEL
from tradewake.operators import scoring, segments, series, training
from tradewake.operators.joint_ridge import fit_together
from tradewake.operators.regression import VECTOR, RidgeSettings, coefficients, fit_by_segment, train_by_segment, training_frame
from tradewake.sources import stored

SETTINGS = RidgeSettings(hash_slots=64, max_iter=200, tolerance=1e-9)


@pytest.fixture(scope="module")
def table(daily):
    return stored(series.features(daily), "features")


@pytest.fixture(scope="module")
def by_parity(daily):
    items = segments.type_stats(daily, min_rows=1).select("type_id", (F.col("type_id") % 3).alias("segment_id"))
    return stored(items, "segments")


@pytest.fixture(scope="module")
def trained(table, by_parity, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    models, report = train_by_segment(table, by_parity, SETTINGS, folder)
    return models, report.collect(), folder


def test_saved_coefficients_are_those_of_the_models(spark, trained):
    models, _, folder = trained
    found = {(r.segment_id, r.slot): r.slope for r in scoring.saved_coefficients(spark, folder).collect()}
    for segment, model in models.items():
        slopes, intercept = coefficients(model)
        assert found.pop((segment, scoring.INTERCEPT)) == pytest.approx(intercept)
        for slot, slope in enumerate(slopes):
            assert found.pop((segment, slot), 0.0) == pytest.approx(slope, abs=1e-12)
    assert not found


def test_scores_equal_those_of_each_loaded_model(spark, table, by_parity, trained):
    models, _, folder = trained
    rows = stored(training.with_segments(table, by_parity), "segmented")
    found = {tuple(r[c] for c in KEY): r for r in scoring.score_saved(rows, folder).collect()}
    assert len(found) == rows.count()
    for segment in models:
        model = PipelineModel.load(f"{folder}/segment_id={segment}")
        for row in model.transform(rows.filter(F.col("segment_id") == segment)).collect():
            scored = found.pop(tuple(row[c] for c in KEY))
            assert scored.segment_id == segment and scored.prediction == pytest.approx(row.prediction, rel=1e-9)
    assert not found


def test_a_segment_without_a_model_has_no_prediction(table, by_parity, trained):
    _, _, folder = trained
    others = by_parity.withColumn("segment_id", F.when(F.col("segment_id") == 2, 99).otherwise(F.col("segment_id")))
    rows = stored(training.with_segments(table, others), "segmented")
    scores = scoring.score_saved(rows, folder)
    assert {(r.segment_id == 99, r.prediction is None) for r in scores.collect()} == {(True, True), (False, False)}


def test_scoring_loads_no_model_but_one(spark, table, by_parity, trained, monkeypatch):
    _, _, folder = trained
    loads = []
    load = PipelineModel.load
    monkeypatch.setattr(PipelineModel, "load", lambda path: loads.append(path) or load(path))
    scoring.score_saved(stored(training.with_segments(table, by_parity), "segmented"), folder).count()
    assert len(loads) == 1


def test_no_models_is_an_error(spark, table, by_parity, tmp_path):
    with pytest.raises(Exception, match="(?i)path|models"):
        scoring.score_saved(training.with_segments(table, by_parity), str(tmp_path))


def of(df):
    return {(r.segment_id, r.slot): r.slope for r in df.collect()}


def test_all_features_fitted_together_equal_the_separate_fits(table, by_parity):
    """Hashed categories, constant slots and a month that is missing in some segments included."""
    frame = training_frame(table, by_parity, SETTINGS)
    models, _ = fit_by_segment(frame, SETTINGS)
    together = of(fit_together(frame, SETTINGS))
    for segment, model in models.items():
        slopes, intercept = coefficients(model)
        assert together[segment, scoring.INTERCEPT] == pytest.approx(intercept, rel=1e-3, abs=1e-2)
        for slot, slope in enumerate(slopes):
            assert together.get((segment, slot), 0.0) == pytest.approx(slope, rel=1e-3, abs=1e-4)


def test_the_gradient_vanishes(spark, table, by_parity):
    """Optimality by itself: residuals against every standardized slot equal the penalty on its slope."""
    import numpy as np

    frame = training_frame(table, by_parity, SETTINGS)
    slopes = of(fit_together(frame, SETTINGS))
    rows = frame.filter("part = 'train'").collect()
    for segment in {r.segment_id for r in rows}:
        own = [r for r in rows if r.segment_id == segment]
        x = np.array([r[VECTOR].toArray() for r in own])
        y = np.array([r[LABEL] for r in own])
        beta = np.array([slopes.get((segment, i), 0.0) for i in range(x.shape[1])])
        residual = y - x @ beta - slopes[segment, -1]
        deviation, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
        used = deviation > 0
        z = (x[:, used] - x[:, used].mean(axis=0)) / deviation[used]
        gradient = z.T @ residual / len(y) / sy - SETTINGS.reg_param / sy * (beta[used] * deviation[used] / sy)
        assert abs(gradient).max() < 1e-7 and abs(residual.mean()) < 1e-6 * sy


def test_several_rounds_and_few_rows(table, by_parity):
    frame = training_frame(table, by_parity, SETTINGS)
    whole = of(fit_together(frame, SETTINGS))
    parts = of(fit_together(frame, SETTINGS, most_slots=1))
    assert parts.keys() == whole.keys() and all(parts[k] == pytest.approx(whole[k], rel=1e-6, abs=1e-9) for k in whole)
    from dataclasses import replace

    assert of(fit_together(frame, replace(SETTINGS, min_rows_train=10**9))) == {}
    with pytest.raises(ValueError, match="quadratic|squared"):
        fit_together(frame, replace(SETTINGS, elastic_net=0.5))


def test_a_constant_label_has_no_slopes(table, by_parity):
    frame = training_frame(table.withColumn(LABEL, F.lit(7.0)), by_parity, SETTINGS)
    for (_, slot), slope in of(fit_together(frame, SETTINGS)).items():
        assert slope == pytest.approx(7.0 if slot == scoring.INTERCEPT else 0.0, abs=1e-9)


def test_passes_do_not_grow_with_the_segments(spark, table, daily):
    """As many products for one segment as for all items apart."""
    from tradewake.operators import joint_ridge

    counts = []
    for segment in (F.lit(0), F.col("type_id")):
        items = stored(segments.type_stats(daily, min_rows=1).select("type_id", segment.alias("segment_id")), "segments")
        frame = training_frame(table, items, SETTINGS)
        calls = []
        products = joint_ridge._products
        joint_ridge._products = lambda *a: calls.append(1) or products(*a)
        try:
            fit_together(frame, RidgeSettings(hash_slots=64, max_iter=5, tolerance=1e-12))
        finally:
            joint_ridge._products = products
        counts.append(len(calls))
    assert counts == [6, 6]
