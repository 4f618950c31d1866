import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewake.model import FEATURE_IDS, FEATURES, LABEL
from tradewake.operators import series
from tradewake.plans import pipelines
from tradewake.sources import read_table, write_by_month

from .helpers import daily_rows, day, frame, plan


def by_day(df):
    return [r.asDict() for r in df.orderBy("date").collect()]


def expected_rows(prices, volumes, days):
    """The feature rows of one series, computed directly."""
    out = []
    for i in range(7, len(prices) - 1):
        week, fortnight = prices[i - 7:i], prices[max(0, i - 14):i]
        out.append({
            "date": day(days[i]), "average": prices[i],
            "price_lag_1": prices[i - 1], "price_lag_3": prices[i - 3], "price_lag_7": prices[i - 7],
            "price_mean_7": statistics.fmean(week), "price_mean_14": statistics.fmean(fortnight),
            "price_std_7": statistics.stdev(week), "volume_lag_1": volumes[i - 1],
            "volume_mean_7": statistics.fmean(volumes[i - 7:i]), "spread": 2.0, "spread_mean_7": 2.0,
            "target_next_price": prices[i + 1],
        })
    return out


@pytest.mark.parametrize("length, rows", [(0, 0), (1, 0), (8, 0), (9, 1), (16, 8)])
def test_a_series_loses_seven_rows_and_the_last(spark, length, rows):
    assert series.features(frame(spark, daily_rows(range(length)))).count() == rows


def test_lags_count_rows_not_days(spark):
    found = by_day(series.lags(frame(spark, daily_rows([1, 2, 3, 4], days=[0, 10, 11, 40]))))
    assert [r["price_lag_1"] for r in found] == [None, 1, 2, 3]
    assert [r["price_lag_3"] for r in found] == [None, None, None, 1]
    assert [r["volume_lag_1"] for r in found] == [None, 10, 20, 30]


def test_frames_leave_out_the_current_row_and_need_not_be_full(spark):
    found = by_day(series.rolling(frame(spark, daily_rows([1, 2, 6]))))
    assert [r["price_mean_7"] for r in found] == [None, 1, 1.5]
    assert [r["price_std_7"] for r in found] == [None, None, pytest.approx(0.5 ** 0.5)]
    assert [r["spread_mean_7"] for r in found] == [None, 2, 2]


def test_target_is_the_next_observed_row(spark):
    found = by_day(series.target(frame(spark, daily_rows([1, 2, 3], days=[0, 5, 6]))))
    assert [r[LABEL] for r in found] == [2, 3, None]


def test_series_do_not_mix(spark):
    rows = daily_rows([1, 2], region=1) + daily_rows([10, 20], region=2) + daily_rows([100, 200], item=2)
    found = series.lags(frame(spark, rows)).filter("price_lag_1 is not null")
    assert sorted(r.price_lag_1 for r in found.collect()) == [1, 10, 100]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(1, 10**6), st.integers(0, 10**6), st.integers(1, 9)), min_size=9, max_size=40)
)
def test_features_equal_a_direct_computation(spark, cells):
    prices, volumes = [c[0] / 100 for c in cells], [c[1] for c in cells]
    days = [sum(c[2] for c in cells[:i]) for i in range(len(cells))]
    found = by_day(series.features(frame(spark, daily_rows(prices, days=days, volumes=volumes)).repartition(3)))
    wanted = expected_rows(prices, volumes, days)
    assert len(found) == len(wanted)
    for have, want in zip(found, wanted):
        for name, value in want.items():
            assert have[name] == (pytest.approx(value, abs=1e-6) if isinstance(value, float) else value), name


def test_features_do_not_see_the_future(spark):
    prices = [float(i * i % 17) for i in range(30)]
    changed = prices[:20] + [p + 1000 for p in prices[20:]]
    names = [c for c in FEATURES]
    before, after = (
        series.features(frame(spark, daily_rows(p))).filter(F.col("date") <= day(19)).select("date", *names)
        for p in (prices, changed)
    )
    assert by_day(before) == by_day(after)


def test_nan_price_takes_its_rows_out(spark):
    prices = [1.0] * 20
    prices[18] = float("nan")
    found = by_day(series.features(frame(spark, daily_rows(prices))))
    # Row 17 has it as its label and row 18 in its range; row 19 is the last.
    assert [r["date"] for r in found] == [day(i) for i in range(7, 17)]


def test_columns_and_one_shuffle(daily):
    table = series.features(daily)
    assert table.columns == [*FEATURE_IDS, *FEATURES, LABEL]
    assert plan(table).count("Exchange") == 1


def test_feature_job(spark, tmp_path):
    source, target = str(tmp_path / "daily"), str(tmp_path / "features")
    rows = frame(spark, daily_rows(range(1, 61)))
    write_by_month(rows.select("*", F.year("date").alias("year"), F.month("date").alias("month")), source)
    pipelines.build_features(spark, source, target)
    table = read_table(spark, target)
    assert set(table.columns) == {*FEATURE_IDS, *FEATURES, LABEL}
    assert table.count() == 60 - 8
