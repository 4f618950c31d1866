import hashlib
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tradewake.functions import score
from tradewake.model import LABEL, REGRESSION_NUMERICS
from tradewake.operators import regression, series, training
from tradewake.plans import pipelines
from tradewake.sources import stored, write_table

from .helpers import daily_rows, folder_of_jobs, frame, parts, plan, scans


@pytest.fixture(scope="module")
def table(daily):
    """Feature table."""
    return stored(series.features(daily), "test-features")


@pytest.fixture(scope="module")
def by_parity(spark):
    """Segments 0 and 1 by parity of the item; items above 20 have none."""
    return spark.range(1, 21).select(F.col("id").cast("int").alias("type_id"), (F.col("id") % 2).alias("segment_id"))


@pytest.fixture(scope="module")
def segmented(table, by_parity):
    return stored(training.with_segments(table, by_parity), "test-segmented")


SMALL = regression.RidgeSettings(min_rows_train=100, min_rows_test=10, hash_slots=64)


def test_join_drops_items_without_segment_and_makes_ids_text(table, segmented):
    kinds = dict(segmented.dtypes)
    assert (kinds["type_id"], kinds["region_id"], kinds["segment_id"]) == ("string", "string", "int")
    assert segmented.count() == table.filter("type_id <= 20").count()
    assert segmented.filter(F.col("segment_id") != F.col("type_id").cast("int") % 2).isEmpty()


def test_join_drops_incomplete_rows(spark, table, by_parity):
    holed = table.withColumn(LABEL, F.when(F.col("type_id") > 1, F.col(LABEL)))
    holes = spark.createDataFrame([(1, 0), (2, None), (None, 1), (3, 1)], "type_id int, segment_id int")
    found = training.with_segments(holed, holes)
    assert {r.type_id for r in found.select("type_id").distinct().collect()} == {"3"}


def test_cut_to_top_items(segmented):
    totals = segmented.groupBy("type_id").agg(F.sum("volume_lag_1").alias("v")).collect()
    best = {r.type_id for r in sorted(totals, key=lambda r: (-r.v, int(r.type_id)))[:3]}
    kept = training.keep_top_items(segmented, 3)
    assert {r.type_id for r in kept.select("type_id").distinct().collect()} == best
    assert kept.count() == segmented.filter(F.col("type_id").isin(list(best))).count()
    assert "BroadcastHashJoin" in plan(kept) and "LeftSemi" in plan(kept)


def test_cut_is_off_for_zero_or_without_volume(segmented):
    assert training.keep_top_items(segmented, 0) is segmented
    bare = segmented.drop("volume_lag_1")
    assert training.keep_top_items(bare, 3) is bare
    assert training.keep_top_items(bare.withColumn("volume", F.lit(1)), 3).select("type_id").distinct().count() == 3


def test_sample_is_the_same_in_any_layout(segmented):
    def keys(df):
        return {tuple(r) for r in df.select("date", "region_id", "type_id").collect()}

    first = keys(training.hash_sample(segmented, 0.2))
    assert keys(training.hash_sample(segmented.repartition(5), 0.2)) == first
    assert len(first) / segmented.count() == pytest.approx(0.2, abs=0.03)
    # A larger fraction keeps the smaller sample; another seed draws another.
    assert first < keys(training.hash_sample(segmented, 0.4))
    assert first != keys(training.hash_sample(segmented, 0.2, seed=7))


def test_draw_is_taken_from_the_digest_of_the_key(spark):
    rows = spark.createDataFrame([(date(2025, 1, 1 + i), i, 7 * i) for i in range(20)], "date date, region_id int, type_id int")
    for row in rows.select("*", training.key_draw(9).alias("draw")).collect():
        text = f"9|{row.date.isoformat()}|{row.region_id}|{row.type_id}"
        assert row.draw == int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def test_sample_does_not_depend_on_the_type_of_the_ids(table):
    as_text = table.withColumns({name: F.col(name).cast("string") for name in ("region_id", "type_id")})
    numbers, texts = (
        {tuple(map(str, r)) for r in training.hash_sample(x, 0.5).select("date", "region_id", "type_id").collect()}
        for x in (table, as_text)
    )
    assert numbers == texts and 0 < len(numbers) < table.count()


def test_volumes_beyond_a_bigint_rank_first(spark):
    rows = spark.createDataFrame([(1, 5)] + [(2, 2**62)] * 3 + [(3, 7)], "type_id int, volume_lag_1 bigint")
    assert {r.type_id for r in training.keep_top_items(rows, 1).collect()} == {2}


@pytest.mark.parametrize("fraction", [0.0, 1.0, -1, 2])
def test_sample_is_off_outside_the_open_interval(segmented, fraction):
    assert training.hash_sample(segmented, fraction) is segmented


def test_largest_segments_break_ties_by_id(spark):
    rows = spark.createDataFrame([(s, date(2025, 1, 1)) for s in (4, 4, 2, 2, 9)], "segment_id int, date date")
    assert [tuple(r)[:2] for r in training.largest_segments(rows, 2).collect()] == [(2, 2), (4, 2)]


def test_sixty_days_hold_sixty_one_dates(spark):
    days = spark.sql("select explode(sequence(date'2025-01-01', date'2025-12-31')) as date")
    train, test = parts(training.time_split(days))
    assert test.agg(F.min("date"), F.count("*")).first() == (date(2025, 11, 1), 61)
    assert train.agg(F.max("date"), F.count("*")).first() == (date(2025, 10, 31), 304)


def test_each_segment_splits_at_its_own_end(spark):
    rows = spark.sql(
        "select explode(sequence(date'2025-01-01', date'2025-03-31')) as date, 1 as segment_id union all "
        "select explode(sequence(date'2024-01-01', date'2024-03-31')) as date, 2 as segment_id"
    )
    split = training.time_split_by_segment(rows, 10)
    first_test = split.filter("part = 'test'").groupBy("segment_id").agg(F.min("date").alias("d"))
    assert {r.segment_id: r.d for r in first_test.collect()} == {1: date(2025, 3, 21), 2: date(2024, 3, 21)}
    assert "Window" not in plan(split)


def test_metrics_equal_a_direct_computation(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(5, 2, 50)
    p = y + rng.normal(0, 1, 50)
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    found = rows.agg(*score("y", "p")).first()
    assert found.rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert found.mae == pytest.approx(np.abs(y - p).mean())
    assert found.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_r2_of_a_constant_label_is_null(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert rows.agg(*score("y", "p")).first().r2 is None


def test_baseline_needs_yesterdays_price(segmented):
    split = training.time_split_by_segment(segmented)
    assert training.baseline_metrics(split).count() == 4
    with pytest.raises(ValueError, match="price_lag_1"):
        training.baseline_metrics(split.drop("price_lag_1"))


def ridge_by_hand(x, y, penalty):
    """Minimum of 1/(2n) sum (y/sy - x/sx b)^2 + penalty/(2 sy) |b|^2 with free intercept, in original units."""
    scale, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
    used = scale > 0
    z = (x[:, used] - x[:, used].mean(axis=0)) / scale[used]
    t = (y - y.mean()) / sy
    n = len(y)
    b = np.linalg.solve(z.T @ z / n + penalty / sy * np.eye(z.shape[1]), z.T @ t / n)
    return y.mean() + sy * (z @ b)


def test_fitted_ridge_equals_the_closed_form(spark):
    """Numbers and one-hot categories against a direct solve; with enough slots no two categories collide."""
    rng = np.random.default_rng(3)
    rows = []
    for region in (1, 2):
        for item in (3, 4, 5):
            prices = 50 + 10 * region + item + np.cumsum(rng.normal(0, 1, 80))
            series_ = daily_rows(prices, region=region, item=item, volumes=[int(v) for v in rng.integers(1, 99, 80)])
            rows += [(*r[:4], r[4] + float(rng.exponential()), *r[5:]) for r in series_]
    table = series.features(frame(spark, rows))
    seg = spark.createDataFrame([(i, 0) for i in (3, 4, 5)], "type_id int, segment_id int")
    settings = replace(SMALL, hash_slots=2**15, reg_param=5.0, max_iter=2000, test_days=20)
    models, _ = regression.train_by_segment(table, seg, settings)
    train, _ = parts(training.time_split_by_segment(training.with_segments(table, seg), 20))
    found = models[0].transform(train).select(*REGRESSION_NUMERICS, "region_id", "type_id", LABEL, "prediction").toPandas()
    numbers = found[list(REGRESSION_NUMERICS)].to_numpy(float)
    dummies = np.column_stack(
        [(found[c] == v).to_numpy(float) for c, vs in (("region_id", "12"), ("type_id", "345")) for v in vs]
    )
    wanted = ridge_by_hand(np.hstack([numbers, dummies]), found[LABEL].to_numpy(), 5.0)
    assert found["prediction"].to_numpy() == pytest.approx(wanted, abs=1e-2)


def test_training_report_models_and_reload(spark, table, by_parity, tmp_path):
    models, report = regression.train_by_segment(table, by_parity, SMALL, str(tmp_path))
    rows = {(r.segment_id, r.part): r for r in report.collect()}
    assert set(rows) == {(s, p) for s in (0, 1) for p in ("train", "test")}
    for (segment, part), row in rows.items():
        assert row.n_rows > 0
        if part == "train":
            # The fit includes a constant, so on its own rows it cannot be worse than the mean.
            assert row.ridge_r2 >= -1e-6 and row.ridge_rmse <= row.baseline_rmse
    split = training.time_split_by_segment(training.with_segments(table, by_parity))
    for segment, model in models.items():
        loaded = PipelineModel.load(f"{tmp_path}/segment_id={segment}")
        sample = split.filter((F.col("segment_id") == segment) & (F.col("part") == "test"))
        assert [r.prediction for r in loaded.transform(sample).orderBy("date", "region_id", "type_id").collect()] == [
            r.prediction for r in model.transform(sample).orderBy("date", "region_id", "type_id").collect()
        ]


def test_every_segment_is_reported(table, by_parity):
    models, report = regression.train_by_segment(table, by_parity, replace(SMALL, min_rows_test=10**6))
    rows = report.collect()
    assert models == {} and {(r.segment_id, r.part) for r in rows} == {(s, p) for s in (0, 1) for p in ("train", "test")}
    assert {r.status for r in rows} == {regression.TOO_FEW}
    assert all(r.n_rows > 0 and r.n_predicted == 0 and r.baseline_rmse is not None and r.ridge_rmse is None for r in rows)


def test_only_the_largest_segments_are_trained(table, by_parity):
    frame_ = regression.training_frame(table, by_parity, SMALL)
    assert "PartitionFilters: [isnotnull(segment_id" in plan(frame_.filter("segment_id = 0"))
    models, report = regression.fit_by_segment(frame_, replace(SMALL, top_n_segments=1))
    status = {r.segment_id: r.status for r in report.collect()}
    assert len(models) == 1 and sorted(status.values()) == [regression.NOT_AMONG_LARGEST, regression.TRAINED]
    assert status[next(iter(models))] == regression.TRAINED


def test_defaults_cut_nothing(table, by_parity):
    rows = training.with_segments(table, by_parity).count()
    _, report = regression.train_by_segment(table, by_parity, regression.RidgeSettings(hash_slots=64))
    found = report.collect()
    assert sum(r.n_rows for r in found) == rows and {r.status for r in found} == {regression.TRAINED}


def test_only_train_rows_are_sampled(table, by_parity):
    whole, thin = (
        {r.part: r["count"] for r in regression.training_frame(table, by_parity, s).groupBy("part").count().collect()}
        for s in (SMALL, replace(SMALL, sample_fraction=0.3))
    )
    assert thin["test"] == whole["test"] and thin["train"] < 0.4 * whole["train"]


def test_null_filters_reach_the_scan(spark, table, by_parity):
    pushed = [line for line in plan(training.with_segments(table, by_parity)).split("\n") if "PushedFilters" in line]
    assert any(all(f"IsNotNull({name})" in line for name in ("date", "region_id", "type_id", LABEL)) for line in pushed)


def test_features_are_read_once_or_twice(spark, table, by_parity, tmp_path, monkeypatch):
    write_table(table, str(tmp_path / "features"))
    found = []
    keep = regression.stored
    monkeypatch.setattr(regression, "stored", lambda df, *a, **k: found.append(scans(df, "features")) or keep(df, *a, **k))
    for settings, most in ((SMALL, 1), (replace(SMALL, top_n_items=3), 2)):
        found.clear()
        regression.training_frame(spark.read.parquet(str(tmp_path / "features")), by_parity, settings)
        assert sum(found) == most


def test_training_job_with_elastic_net_and_current_price(spark, table, by_parity, tmp_path):
    write_table(table, str(tmp_path / "features"))
    write_table(by_parity, str(tmp_path / "segments"))
    settings = replace(
        SMALL, elastic_net=0.5, with_current_price=True, top_n_items=4, sample_fraction=0.9, min_rows_test=1
    )
    report = pipelines.train(
        spark, str(tmp_path / "features"), str(tmp_path / "segments"), str(tmp_path / "models"), settings
    )
    assert report.filter("ridge_rmse is null").isEmpty()
    assert any((tmp_path / "models").glob("segment_id=*"))
    assert not folder_of_jobs(spark)
