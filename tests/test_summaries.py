import pytest
from pyspark.sql import functions as F

from tradewake.functions import year_month
from tradewake.operators import summaries

from .helpers import daily_rows, frame, plan, scans


@pytest.fixture(scope="module")
def path(spark, daily, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("summaries") / "table")
    summaries.write_summaries(summaries.monthly_summaries(daily), folder)
    return folder


def test_merged_months_equal_one_summary_of_all_rows(spark, daily, path):
    found = {r.type_id: r for r in summaries.merged(summaries.read_summaries(spark, path), "type_id").collect()}
    exact = daily.groupBy("type_id").agg(
        F.count("*").alias("n"), F.sum("volume").alias("volume"), F.avg("average").alias("price"),
        F.countDistinct("date").alias("days"), F.countDistinct("region_id").alias("regions"),
        F.sort_array(F.collect_list("average")).alias("prices"),
    ).collect()
    assert len(found) == len(exact)
    for row in exact:
        merged = found[row.type_id]
        assert (merged.n_rows, merged.total_volume, merged.n_regions) == (row.n, row.volume, row.regions)
        assert merged.avg_price == pytest.approx(row.price)
        # The bounds stated for the sketches: three standard errors, and the rank of the median.
        assert abs(merged.days_present - row.days) <= 0.06 * row.days
        rank = sum(p <= merged.price_q50 for p in row.prices) / row.n
        assert abs(rank - 0.5) <= 0.03 + 1 / row.n


def test_a_range_reads_its_months_of_the_summaries_only(spark, daily, path):
    months = summaries.read_summaries(spark, path, (1997, 1), (1997, 3))
    (row,) = summaries.merged(months).collect()
    wanted = daily.withColumns(year_month()).filter("year = 1997 and month <= 3")
    assert (row.n_rows, row.total_volume) == tuple(wanted.agg(F.count("*"), F.sum("volume")).first())
    assert scans(summaries.merged(months, "type_id"), path) == 1
    assert months.select("year", "month").distinct().count() == 3
    assert "year" in plan(months).split("PartitionFilters: [")[1].split("]")[0]


def test_a_month_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "table")
    summaries.write_summaries(summaries.monthly_summaries(frame(spark, daily_rows([1, 2], days=[0, 40]))), path)
    summaries.write_summaries(summaries.monthly_summaries(frame(spark, daily_rows([5, 6, 7], days=[40, 41, 42]))), path)
    (row,) = summaries.merged(summaries.read_summaries(spark, path), "type_id", quantiles=(0.0, 1.0)).collect()
    assert (row.n_rows, row.price_q0, row.price_q100, row.days_present) == (4, 1.0, 7.0, 4)


def test_nothing_and_missing_prices(spark):
    assert summaries.merged(summaries.monthly_summaries(frame(spark, [])), "type_id").isEmpty()
    rows = [(*r[:3], None, *r[4:]) for r in daily_rows([1, 2])]
    (row,) = summaries.merged(summaries.monthly_summaries(frame(spark, rows)), "type_id").collect()
    assert (row.n_rows, row.avg_price, row.price_q50) == (2, None, None)
