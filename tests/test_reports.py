from datetime import date

import pytest
from pyspark.sql import functions as F

from tradewake.functions import median
from tradewake.operators import profiling, ranking
from tradewake.operators.slicing import series_slice
from tradewake.plans import pipelines
from tradewake.sources import between_dates, read_table, write_by_month, write_table

from .helpers import DAILY, daily_rows, day, frame, plan, scans


def test_overview_of_nothing(spark):
    (row,) = profiling.overview(frame(spark, [])).collect()
    assert (row.n_rows, row.min_date, row.n_items) == (0, None, 0)


def test_approximate_overview_is_close(daily):
    exact, rough = profiling.overview(daily).first(), profiling.overview(daily, approximate=True).first()
    assert exact.n_rows == rough.n_rows
    assert rough.n_days == pytest.approx(exact.n_days, rel=0.15)


def test_counts_of_nothing_are_zero(spark):
    empty = frame(spark, [])
    assert set(profiling.missing_values(empty).first()) == {0}
    assert set(profiling.sanity_checks(empty).first()) == {0}


def test_null_breaks_no_sanity_rule(spark):
    rows = [(day(0), 1, 1, None, None, 3.0, 1, None), (day(1), 1, 1, -1.0, 1.0, 2.0, 1, -5)]
    found = profiling.sanity_checks(frame(spark, rows)).first().asDict()
    assert found == {
        "avg_negative": 1, "highest_negative": 0, "lowest_negative": 0, "volume_negative": 1, "highest_lt_lowest": 1,
    }
    assert profiling.missing_values(frame(spark, rows)).first().asDict() == {
        "date_nulls": 0, "region_nulls": 0, "type_nulls": 0, "average_nulls": 1, "volume_nulls": 1,
    }


def test_describe_single_row_has_no_deviation(spark):
    rows = {r.measure: r for r in profiling.describe_prices(frame(spark, daily_rows([5]))).collect()}
    assert list(rows) == ["average", "highest", "lowest", "order_count", "volume"]
    assert rows["average"].stddev is None and rows["highest"].mean == 6.0


def test_correlation_with_a_constant_is_null(spark):
    found = profiling.correlations(frame(spark, daily_rows([1, 2, 3, 5]))).first()
    assert found.corr_average_volume == pytest.approx(0.98270762982399)
    assert found.corr_average_spread is None and found.corr_volume_spread is None


def test_ties_in_a_ranking_go_to_the_smaller_id(spark):
    rows = [r for item in (9, 3, 7, 5) for r in daily_rows([1, 2], item=item, volumes=[5, 5])]
    assert [r.type_id for r in ranking.top_items(frame(spark, rows), 2).collect()] == [3, 5]
    assert [r.type_id for r in ranking.coverage(frame(spark, rows), 3).collect()] == [3, 5, 7]


def test_volatility_without_mean_or_deviation_sorts_last(spark):
    rows = daily_rows([0, 0], item=1) + daily_rows([4], item=2) + daily_rows([1, 3], item=3)
    found = ranking.volatility_rank(frame(spark, rows)).collect()
    assert [r.type_id for r in found] == [3, 1, 2]
    assert found[1].cov is None and found[2].cov is None


def test_volume_beyond_bigint_is_null_and_ranks_first(spark):
    huge = 2**62
    rows = daily_rows([1, 1, 1], item=1, region=1, volumes=[huge] * 3)
    rows += daily_rows([1, 2, 3], item=2, region=2, volumes=[5, 5, 5])
    daily = frame(spark, rows)
    assert [(r.type_id, r.total_volume) for r in ranking.top_items(daily).collect()] == [(1, None), (2, 15)]
    assert [(r.region_id, r.total_volume) for r in ranking.top_regions(daily).collect()] == [(1, None), (2, 15)]
    assert {r.type_id for r in ranking.top_item_trends(daily, 1).collect()} == {1}
    assert {r.sum_volume for r in ranking.monthly_seasonality(daily).collect()} == {None}


def test_monthly_uses_or_derives_the_month(spark, daily):
    given = daily.select("*", F.lit(1).alias("year"), F.lit(2).alias("month"))
    assert [(r.year, r.month) for r in ranking.monthly_seasonality(given).collect()] == [(1, 2)]
    derived = ranking.monthly_seasonality(daily)
    assert derived.count() == daily.select(F.trunc("date", "month")).distinct().count()


def test_weekdays_are_numbered_from_sunday(spark):
    rows = daily_rows(range(1, 8))  # 2025-01-01 is a Wednesday
    found = [(r.dow_num, r.dow) for r in ranking.dow_seasonality(frame(spark, rows)).collect()]
    assert found == list(enumerate(["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"], 1))


def test_trends_read_the_ranking_by_semi_join(daily):
    trends = ranking.top_item_trends(daily, 2)
    assert "LeftSemi" in plan(trends)
    assert [r.type_id for r in trends.select("type_id").distinct().orderBy("type_id").collect()] == sorted(
        r.type_id for r in ranking.top_items(daily, 2).collect()
    )


def test_top_k_keeps_k_rows_per_task(daily):
    assert "TakeOrderedAndProject" in plan(ranking.top_items(daily))


@pytest.mark.parametrize("n, expected", [(1, 1), (2, 1), (3, 2), (4, 2), (10, 5)])
def test_median_is_the_lower_middle_value(spark, n, expected):
    assert spark.range(1, n + 1).agg(median("id")).first()[0] == expected


def test_slice_bounds_are_inclusive_and_optional(spark):
    rows = frame(spark, daily_rows(range(10)) + daily_rows(range(10), region=2) + daily_rows(range(10), item=2))

    def days(**bounds):
        return [r.date for r in series_slice(rows, 1, [1], **bounds).collect()]

    assert days() == [day(i) for i in range(10)]
    assert days(date_from="2025-01-03", date_to="2025-01-05") == [day(2), day(3), day(4)]
    assert days(date_from=date(2025, 1, 9)) == [day(8), day(9)]
    assert days(date_to="2025-01-01") == [day(0)]
    assert {r.region_id for r in series_slice(rows, 1, [1, 2]).collect()} == {1, 2}


def test_slice_without_rows_is_empty_with_its_schema(spark):
    nothing = series_slice(frame(spark, daily_rows([1])), 99, [1])
    assert nothing.columns == ["date", "region_id", "avg_price", "sum_volume", "avg_spread"]
    assert nothing.isEmpty()


def test_date_range_prunes_months(spark, tmp_path):
    rows = frame(spark, daily_rows(range(1, 121)))
    path = str(tmp_path / "months")
    write_by_month(rows.select("*", F.year("date").alias("year"), F.month("date").alias("month")), path)
    ranged = between_dates(read_table(spark, path), "2025-02-10", "2025-03-05")
    text = ranged._jdf.queryExecution().executedPlan().toString()
    pruning = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year" in pruning and "month" in pruning
    assert "GreaterThanOrEqual(date" in text and "LessThanOrEqual(date" in text
    assert {f.split("/")[-2] for f in ranged.inputFiles()} >= {"month=2", "month=3"}
    assert ranged.count() == 24


def test_scans_read_needed_columns_only(spark, daily):
    text = plan(ranking.coverage(daily))
    assert "ReadSchema: struct<date:date,type_id:int>" in text


def test_all_reports_run(daily, capsys):
    reports = pipelines.analyze(daily)
    assert len(reports) == 13
    pipelines.show_reports({name: reports[name] for name in ("schema", "overview", "coverage")}, 8)
    printed = capsys.readouterr().out
    assert "n_regions" in printed and "order_count" in printed and "only showing top 8 rows" in printed


def test_reports_share_passes_and_equal_the_single_ones(spark, daily, tmp_path, monkeypatch):
    write_table(daily, str(tmp_path / "daily"))
    source = spark.read.parquet(str(tmp_path / "daily"))
    seen = []
    keep = pipelines.stored
    monkeypatch.setattr(pipelines, "stored", lambda df, *a: seen.append(scans(df, "daily")) or keep(df, *a))
    reports = pipelines.analyze(source)
    assert sum(seen) + sum(scans(report, str(tmp_path)) for report in reports.values()) <= 7
    for name, report in reports.items():
        if name != "schema":
            single = getattr(profiling if hasattr(profiling, name) else ranking, name)(source)
            assert report.columns == single.columns
            for a, b in zip(report.collect(), single.collect(), strict=True):
                assert all(x == pytest.approx(y, rel=1e-9) if isinstance(x, float) else x == y for x, y in zip(a, b))


def test_empty_text_is_an_open_end(daily):
    assert between_dates(daily, "", "").count() == daily.count()


def test_declared_schema_of_helpers_matches_the_view(daily):
    assert [name for name, _ in daily.dtypes] == [part.split()[0] for part in DAILY.split(", ")]
