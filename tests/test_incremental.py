import random

import pytest
from pyspark.sql import functions as F

from tradewake.operators import incremental, series
from tradewake.plans import pipelines
from tradewake.sources import read_table, read_version, stored, tables, write_version

from .helpers import DAILY, daily_rows, day, folder_of_jobs, frame, plan


def rows(df):
    return sorted(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def history():
    """Series that pause, begin late, end early, or are short."""
    draw = random.Random(6)
    found = []
    for item, (first, last) in {1: (0, 90), 2: (0, 40), 3: (35, 90), 4: (0, 3), 5: (62, 70), 6: (80, 90)}.items():
        days = [d for d in range(first, last) if draw.random() < 0.8]
        found += daily_rows([draw.uniform(1, 9) for _ in days], item=item, days=days)
    return found


@pytest.mark.parametrize("borders", [[30, 31, 59], [1, 2, 3, 4, 50], [45], []])
def test_loads_of_any_size_give_the_table_of_one_build(spark, borders):
    whole = frame(spark, history())
    state, parts = None, []
    for start, stop in zip([0, *borders], [*borders, 1000]):
        new = whole.filter(F.col("date").between(day(start), day(stop - 1)))
        complete, after = incremental.extended(state, new)
        parts += rows(complete)
        state = stored(after, "state")
        assert max((r["count"] for r in state.groupBy("region_id", "type_id").count().collect()), default=0) <= incremental.STATE_ROWS
    assert sorted(parts) == rows(series.features(whole)) and parts


def test_only_the_state_and_the_new_rows_are_read(spark, tmp_path):
    frame(spark, history()).write.parquet(str(tmp_path / "state"))
    frame(spark, daily_rows([1.0], days=[200])).write.parquet(str(tmp_path / "new"))
    complete, _ = incremental.extended(spark.read.parquet(str(tmp_path / "state")), spark.read.parquet(str(tmp_path / "new")))
    text = plan(complete)
    assert text.count("Location:") == 2 and text.count("Exchange hashpartitioning(region_id") == 1


def test_the_job_merges_features_month_by_month(spark, tmp_path):
    whole = frame(spark, history())
    target, state = str(tmp_path / "features"), str(tmp_path / "state")
    months = [
        pipelines.extend_features(spark, whole.filter(F.col("date").between(day(a), day(b - 1))), target, state)
        for a, b in ((0, 31), (31, 59), (59, 90))
    ]
    # The last row of January gets its label in February.
    assert months == [[(2025, 1)], [(2025, 1), (2025, 2)], [(2025, 2), (2025, 3)]]
    names = series.features(whole).columns
    assert rows(read_table(spark, target).select(*names)) == rows(series.features(whole))
    assert not folder_of_jobs(spark)
    with pytest.raises(ValueError, match="after the last day"):
        pipelines.extend_features(spark, frame(spark, daily_rows([1.0], days=[20])), target, state)
    assert pipelines.extend_features(spark, frame(spark, []), target, state) == []


def test_a_run_that_failed_before_its_state_changed_can_be_repeated(spark, tmp_path, monkeypatch):
    whole = frame(spark, history())
    target, state = str(tmp_path / "features"), str(tmp_path / "state")
    first, second = whole.filter(F.col("date") < day(40)), whole.filter(F.col("date") >= day(40))
    pipelines.extend_features(spark, first, target, state)

    def broken(df, path):
        raise OSError

    with monkeypatch.context() as patch:
        patch.setattr(pipelines, "write_version", broken)
        with pytest.raises(OSError):
            pipelines.extend_features(spark, second, target, state)
    pipelines.extend_features(spark, second, target, state)
    names = series.features(whole).columns
    assert rows(read_table(spark, target).select(*names)) == rows(series.features(whole))


def test_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_version(spark, path) is None
    for n in range(3):
        before = read_version(spark, path)
        write_version(spark.range(n + 1) if before is None else before.union(spark.range(1)), path)
        assert read_version(spark, path).count() == n + 1
    (tmp_path / "table" / "v7").mkdir()  # begun, not finished
    assert tables.latest_version(spark, path) == 2
