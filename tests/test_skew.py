"""A third of all rows on one key: results stay whole and the hot partition is split."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tradewake.model import table
from tradewake.operators import ranking, series, training
from tradewake.plans import catalog
from tradewake.sources import read_table, stored, write_by_month

from .compare import TABLES, differences
from .helpers import plan


@contextmanager
def settings(spark, **values):
    """Session settings for the duration of a test."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# No broadcast, and thresholds at which the small test data counts as large.
AT_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "64KB",
    "spark.sql.files.openCostInBytes": "1KB",
}


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    """The given tables, with every third order line moved to one part and one supplier."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        rows = table(spark, sf_dir, name)
        if name == "lineitem":
            hot = F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0
            rows = rows.withColumns(
                {k: F.when(hot, 1).otherwise(F.col(k)).cast("bigint") for k in ("l_partkey", "l_suppkey")}
            ).repartition(16)
        rows.write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def skewed_sql(skewed_dir):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{skewed_dir}/{name}.parquet/*.parquet')")
    return connection


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.mark.parametrize("name", ["top_items", "features", "clean_market", "type_stats", "top_segments"])
def test_queries_are_whole_on_skewed_tables(spark, skewed_dir, skewed_sql, name):
    with settings(spark, **AT_SCALE):
        found = catalog.queries()[name](spark, skewed_dir)
        assert differences(found, skewed_sql, catalog.oracle_sql()[name]) == []


def test_hot_part_is_split_in_the_view(spark, skewed_dir):
    with settings(spark, **AT_SCALE):
        report = ranking.top_items(catalog.market(spark, skewed_dir))
        assert "SortMergeJoin(skew=true)" in final_plan(report)


def test_hot_item_is_split_in_the_segment_join(spark, daily):
    # One item takes every other row.
    table_ = series.features(daily).withColumn("type_id", F.when(F.col("region_id") > 1, 1).otherwise(F.col("type_id")))
    rows = stored(table_.repartition(16), "test-hot-item")
    by_id = stored(spark.range(1, 26).select(F.col("id").cast("int").alias("type_id"), (F.col("id") % 4).alias("segment_id")), "test-map")
    with settings(spark, **AT_SCALE):
        joined = training.with_segments(rows, by_id)
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
        assert joined.count() == rows.count()
        top = training.largest_segments(training.keep_top_items(joined, 3), 2)
        assert sum(r.n_rows for r in top.collect()) <= rows.count()


def test_hot_month_is_written_as_several_files(spark, daily, tmp_path):
    hot = daily.select("*", F.lit(2025).alias("year"), F.when(F.col("type_id") < 20, 1).otherwise(F.col("type_id") % 12 + 1).alias("month"))
    hot = stored(hot.repartition(16), "test-hot-month")  # many tasks, as a large table would have
    with settings(spark, **AT_SCALE):
        write_by_month(hot, str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "year=2025" / "month=1").glob("*.parquet"))) > 1
    assert read_table(spark, str(tmp_path / "t")).count() == daily.count()


def test_few_small_months_make_few_files(spark, daily, tmp_path):
    rows = stored(daily.select("*", F.year("date").alias("year"), F.month("date").alias("month")).repartition(16), "test-months")
    write_by_month(rows, str(tmp_path / "t"))
    months = rows.select("year", "month").distinct().count()
    assert len(list((tmp_path / "t").glob("year=*/month=*/*.parquet"))) == months


def test_copies_of_one_key_are_reduced_per_task(spark, skewed_dir):
    from tradewake.operators.cleaning import latest_per_key, parse_times
    from tradewake.model import raw_market

    rows = parse_times(raw_market(spark, skewed_dir)).withColumns(
        {"date": F.to_date(F.lit("2025-01-01")), "region_id": F.lit(1), "type_id": F.lit(1)}
    )
    (kept,) = latest_per_key(rows).collect()
    best = rows.orderBy(*(F.desc_nulls_last(c) for c in (
        "http_last_modified", "average", "highest", "lowest", "order_count", "volume"))).first()
    assert kept.asDict() == best.asDict()
