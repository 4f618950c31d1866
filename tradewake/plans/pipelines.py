"""Whole jobs, from path to path.

    transform(spark, "raw/*.csv.gz", "daily")
    extend(spark, "later/*.csv.gz", "daily")
    analyze(read_table(spark, "daily"))
    build_features(spark, "daily", "features")
    segment(spark, "daily", "segments")
    train(spark, "features", "segments", "models")
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import KEY, SEED, SEGMENTS, TOP_ITEMS, TREND_ITEMS
from ..operators import profiling, ranking
from ..operators.cleaning import clean_judged, clean_market, judged, latest_per_key, rule_counts
from ..operators.incremental import STATE_COLUMNS, extended, late_rows
from ..operators.regression import RidgeSettings, train_by_segment
from ..operators.segments import fit_segments, type_stats
from ..operators.series import features
from ..sources import (
    job_folder,
    merge_by_month,
    read_archives,
    read_table,
    read_version,
    stored,
    write_by_month,
    write_table,
    write_version,
)


def transform(
    spark: SparkSession, source: str | Sequence[str], target: str, touched_only: bool = False, keep_nan: bool = False
) -> None:
    """Raw archives to the clean daily table, partitioned by month.

    The table is replaced by the archives' rows; with ``touched_only`` just the months they have rows for, each as a
    whole. To add archives to what is stored, use ``extend``.
    """
    write_by_month(clean_market(read_archives(spark, source), keep_nan=keep_nan), target, touched_only)


def extend(
    spark: SparkSession, source: str | Sequence[str], target: str, keep_nan: bool = False
) -> list[tuple[int, int]]:
    """Merge more archives into the clean daily table; returns the months that were rewritten.

    Gives the table that one ``transform`` of all archives would give, in whatever order they come: of the copies of a
    key the same one is kept, be it stored or new. Only months with new rows are read and written.
    """
    with job_folder(spark):
        new = stored(clean_market(read_archives(spark, source), keep_nan=keep_nan), "new-rows")
        return merge_by_month(new, target, latest_per_key)


def transform_with_quarantine(
    spark: SparkSession, source: str | Sequence[str], target: str, quarantine: str, keep_nan: bool = False
) -> dict[str, int]:
    """``transform`` that also keeps the rejected rows, each with the rules it breaks; returns the counts per rule.

    The archives are read once: parsed rows are staged, accepted and rejected ones apart, and counted in that same pass.
    """
    with job_folder(spark):
        raw = read_archives(spark, source)
        counts = Observation("cleaning")
        rows = judged(raw, keep_nan).observe(counts, *rule_counts(raw, keep_nan))
        staged = stored(rows.withColumn("accepted", F.size("broken") == 0), "judged", partition_by="accepted")
        write_by_month(clean_judged(staged.filter("accepted").drop("accepted")), target)
        write_table(staged.filter("not accepted").drop("accepted"), quarantine)
        return counts.get


def analyze(daily: DataFrame, top_n_items: int = TOP_ITEMS, trend_items: int = TREND_ITEMS) -> dict[str, DataFrame]:
    """Every report on a daily table, by name, and its schema.

    Reports that aggregate alike share a pass: the measures of the whole table, the totals per item
    and the totals per date are computed here, once each, and stored; the others run when they are used.
    """
    totals = stored(profiling.measures(daily), "measures")
    items = stored(ranking.item_totals(daily), "item-totals")
    dates = stored(ranking.date_totals(daily), "date-totals")
    return {
        "schema": profiling.columns_of(daily),
        "overview": profiling.overview(daily),
        "describe_prices": profiling.describe_prices(daily, totals),
        "missing_values": profiling.missing_values(daily, totals),
        "sanity_checks": profiling.sanity_checks(daily, totals),
        "top_items": ranking.top_items(daily, top_n_items, items),
        "top_regions": ranking.top_regions(daily),
        "dow_seasonality": ranking.dow_seasonality(daily, dates),
        "monthly_seasonality": ranking.monthly_seasonality(daily, dates),
        "volatility_rank": ranking.volatility_rank(daily, items=items),
        "correlations": profiling.correlations(daily, totals),
        "top_item_trends": ranking.top_item_trends(daily, trend_items, items),
        "coverage": ranking.coverage(daily, items=items),
    }


def show_reports(reports: dict[str, DataFrame], rows: int = 50) -> None:
    """Print the first rows of each report; where there are more, ``show`` says so."""
    for name, report in reports.items():
        print(f"\n{name}")
        report.show(rows, truncate=False)


def extend_features(spark: SparkSession, new: DataFrame, target: str, state_path: str) -> list[tuple[int, int]]:
    """Add the features that the clean rows of new days complete; returns the months that were rewritten.

    Reads the new rows and the state, not the daily table. New rows must come after the stored ones of their series. A
    run that was interrupted can be repeated: rows that are already there are written again, and the state changes last.
    """
    with job_folder(spark):
        new = stored(new.select(*STATE_COLUMNS), "new-days")
        state = read_version(spark, state_path)
        if state is not None and not (late := late_rows(state, new)).isEmpty():
            raise ValueError(f"{late.count()} rows are not after the last day of their series; rebuild the features")
        complete, after = extended(state, new)
        months = merge_by_month(
            stored(complete, "new-features"), target, lambda rows: rows.dropDuplicates(list(KEY))
        )
        write_version(after, state_path)
        return months


def build_features(spark: SparkSession, source: str, target: str) -> None:
    """Daily table to feature table, partitioned by month."""
    write_by_month(features(read_table(spark, source)), target)


def segment(spark: SparkSession, source: str, target: str, k: int = SEGMENTS, seed: int = SEED) -> None:
    """Daily table to segment map."""
    with job_folder(spark):
        _, segments = fit_segments(type_stats(read_table(spark, source)), k, seed)
        write_table(segments, target)


def train(
    spark: SparkSession,
    feature_path: str,
    segment_path: str,
    model_dir: str | None = None,
    settings: RidgeSettings = RidgeSettings(),
) -> DataFrame:
    """Feature table and segment map to a saved model per segment; returns the error table."""
    with job_folder(spark):
        _, report = train_by_segment(
            read_table(spark, feature_path), read_table(spark, segment_path), settings, model_dir
        )
        # A row per segment and part; kept by the caller after the rows behind it are deleted.
        return spark.createDataFrame(report.collect(), report.schema)
