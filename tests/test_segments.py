import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from tradewake.model import SEGMENT_INPUTS
from tradewake.operators import kmeans, segments
from tradewake.plans import pipelines
from tradewake.sources import read_table, stored, write_table

from .helpers import daily_rows, folder_of_jobs, frame


@pytest.fixture(scope="module")
def stats(daily):
    return segments.type_stats(daily, min_rows=100)


def test_items_need_enough_rows(spark):
    rows = daily_rows([1] * 199, item=1) + daily_rows([1] * 200, item=2)
    assert [r.type_id for r in segments.type_stats(frame(spark, rows)).collect()] == [2]


def test_single_row_has_zero_deviation(spark):
    (row,) = segments.type_stats(frame(spark, daily_rows([3])), min_rows=1).collect()
    assert (row.log_price_std, row.log_vol_std, row.n_rows, row.n_regions) == (0.0, 0.0, 1, 1)
    assert row.log_price_med == pytest.approx(np.log(4))
    assert row.spread_rel_med == pytest.approx(2 / (3 + 1e-6))


def test_without_range_columns_the_spread_is_zero(daily):
    found = segments.type_stats(daily.drop("highest"), min_rows=1)
    assert {r.spread_rel_med for r in found.collect()} == {0.0}


def test_zscores_have_unit_scale_and_zero_for_constants(stats):
    found = segments.zscores(stats).toPandas()
    for name in SEGMENT_INPUTS:
        column = found[f"z_{name}"]
        assert column.mean() == pytest.approx(0, abs=1e-9)
        assert column.std() == pytest.approx(1) or (column == 0).all()
    assert (found["z_n_regions"] == 0).all()


def test_every_item_is_in_the_segment_of_its_nearest_centroid(stats):
    k = 4
    model, labelled = segments.fit_segments(stats, k)
    items = labelled.toPandas().set_index("type_id")
    assert sorted(items.index) == sorted(r.type_id for r in stats.collect())
    assert set(items.segment_id) <= set(range(k))

    scores = segments.zscores(stats).toPandas().set_index("type_id").loc[items.index]
    centers = np.array(segments.centers_of(model))
    distance = ((scores.to_numpy()[:, None, :] - centers[None]) ** 2).sum(axis=2)
    assert (distance.argmin(axis=1) == items.segment_id).all()
    # A fixed point of the iteration: each centroid is the mean of its items.
    for segment, center in enumerate(centers):
        assert scores[items.segment_id == segment].mean().to_numpy() == pytest.approx(center, abs=1e-3)


def test_labels_do_not_depend_on_the_layout(stats):
    def labels(df):
        return {r.type_id: r.segment_id for r in segments.fit_segments(df, 5)[1].collect()}

    first = labels(stats.coalesce(1))
    assert labels(stats.repartition(7)) == first
    assert labels(stats.repartition(60)) == first
    assert labels(stats.orderBy(F.desc("log_price_med"))) == first


def test_well_separated_groups_are_found(spark):
    # Three price and volume levels, each the same for four items.
    rows = []
    for item in range(12):
        level = 10 ** (1 + item % 3)
        rows += daily_rows([level] * 4, item=item, volumes=[level] * 4)
    _, labelled = segments.fit_segments(segments.type_stats(frame(spark, rows), min_rows=1), 3)
    found = {r.type_id: r.segment_id for r in labelled.collect()}
    assert found == {item: item % 3 for item in range(12)}


def test_model_gives_the_labels_of_the_map(stats, tmp_path):
    model, labelled = segments.fit_segments(stats, 4)
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(stats)
    assert {r.type_id: r.segment_id for r in again.collect()} == {r.type_id: r.segment_id for r in labelled.collect()}


def test_no_step_gathers_the_items(spark, stats, monkeypatch):
    """Only aggregates and drawn candidates come to the driver, and no step asks for one partition."""
    rows = []
    collect = DataFrame.collect

    def counted(df):
        found = collect(df)
        rows.append(len(found))
        return found

    many = spark.range(3000).select(
        F.col("id").alias("type_id"), F.lit(1).alias("n_rows"),
        *((F.pmod(F.xxhash64("id", F.lit(name)), F.lit(1000)) / 100.0).alias(name) for name in SEGMENT_INPUTS),
    )
    monkeypatch.setattr(DataFrame, "collect", counted)
    labelled = segments.fit_segments(many, 5)[1]
    assert max(rows) < 5 * 2 * 5 * 3 and labelled.filter("segment_id is null").isEmpty()


def test_cost_is_near_that_of_another_implementation(spark):
    """Six overlapping groups; the best of several fits by MLlib is the measure."""
    draw = np.random.default_rng(1)
    centers = draw.normal(0, 4, (6, 2))
    points = np.concatenate([c + draw.normal(0, 1, (200, 2)) for c in centers])
    df = stored(spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, x double, y double"), "points")
    found = kmeans.fit(df, "id", ["x", "y"], 6, seed=42)
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df).coalesce(1)
    best = min(KMeans(k=6, seed=s).fit(vectors).summary.trainingCost for s in range(3))
    assert len(found) == 6 and kmeans.total_cost(df, ["x", "y"], found) < 1.1 * best


def test_fewer_points_than_clusters(spark):
    df = stored(spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 5.0)], "id int, x double"), "points")
    assert kmeans.fit(df, "id", ["x"], 8, seed=1) == [(0.0,), (5.0,)]


def test_an_item_without_a_statistic_has_no_segment(stats):
    incomplete = stats.withColumn("log_vol_std", F.when(F.col("type_id") % 5 != 0, F.col("log_vol_std")))
    found = segments.fit_segments(incomplete, 3)[1].collect()
    assert all((r.segment_id is None) == (r.type_id % 5 == 0) for r in found) and len(found) == stats.count()


def test_no_items_is_a_clear_error(stats):
    with pytest.raises(ValueError, match="no items"):
        segments.fit_segments(stats.filter("false"))


def test_segment_job(spark, daily, tmp_path):
    source, target = str(tmp_path / "daily"), str(tmp_path / "segments")
    write_table(daily, source)
    pipelines.segment(spark, source, target, k=3)
    table = read_table(spark, target)
    assert table.columns == ["type_id", "segment_id", *SEGMENT_INPUTS, "n_rows"]
    assert table.count() == segments.type_stats(daily).count()
    assert not folder_of_jobs(spark)
