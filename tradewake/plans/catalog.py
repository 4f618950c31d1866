"""The registered queries: each a Spark plan over the given tables and, where SQL can say it, the
equivalent statement.

For comparison between engines, results are rounded to six decimals and dates are written out as
ISO text, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import year_month
from ..model import LABEL, REGRESSION_CATEGORIES, REGRESSION_NUMERICS, SEGMENTS, market, raw_market, table
from ..operators import cleaning, incremental, profiling, ranking, scoring, segments, series, summaries, training
from ..operators.joint_ridge import fit_together
from ..operators.regression import RidgeSettings, coefficients, fit_by_segment, train_by_segment, training_frame, vectorizer
from ..operators.scoring import INTERCEPT
from ..operators.slicing import series_slice
from ..sources import merge_by_month, read_archives, read_table, scratch_path, stored, write_by_month, write_table
from ..streaming.windows import closed_windows, ingest_windows, late_rows
from . import pipelines

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


# ---------------------------------------------------------------- inputs shared by the queries

# The part of the table a slice looks at, and the number of items a cut keeps.
_SLICE = {"type_id": 12, "region_ids": [1, 2, 3], "date_from": "1996-03-15", "date_to": "1999-10-20"}
_TOP = 10
_FRACTION = 0.2
# Fits that a closed form can check: few numbers, a strong penalty, iterated to the end.
_PENALTY = 1000.0
_CLOSED = RidgeSettings(
    numerics=("price_lag_1",), categories=(), reg_param=_PENALTY, tolerance=1e-12, max_iter=1000
)
_CLOSED_TWO = replace(_CLOSED, numerics=("price_lag_1", "volume_lag_1"))


def comparable(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Doubles rounded, dates as text."""
    show = {"double": lambda c: F.round(c, decimals), "date": lambda c: c.cast("string")}
    return df.select(*(show.get(kind, lambda c: c)(F.col(name)).alias(name) for name, kind in df.dtypes))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view as a stored table, for queries that read it more than once."""
    return stored(market(spark, sf_dir), "daily")


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(series.features(market(spark, sf_dir)), "features")


def _features_and_map(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Features, and a segment map that SQL can reproduce: items with enough rows, by id modulo 8."""
    daily = _daily(spark, sf_dir)
    by_id = segments.type_stats(daily).select("type_id", (F.col("type_id") % 8).alias("segment_id"))
    return series.features(daily), stored(by_id, "segments")


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(training.with_segments(*_features_and_map(spark, sf_dir)), "segmented")


# ---------------------------------------------------------------- SQL building blocks

_LINES = """
lines as (
  select l_orderkey, l_extendedprice, l_quantity, l_shipdate, n_regionkey as region_id,
         cast(replace(p_brand, 'Brand#', '') as int) as type_id
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
       join nation on s_nationkey = n_nationkey)"""
_MARKET = _LINES + """,
market as (
  select cast(l_shipdate as date) as date, region_id, type_id,
         avg(l_extendedprice) as average, max(l_extendedprice) as highest, min(l_extendedprice) as lowest,
         cast(count(distinct l_orderkey) as int) as order_count, cast(sum(l_quantity) as bigint) as volume
  from lines group by 1, 2, 3)"""
_RAW = _LINES + """,
raw as (
  select case when l_orderkey % 97 = 0 then null when l_orderkey % 89 = 0 then -l_extendedprice
              else l_extendedprice end as average,
         cast(try_strptime(case when l_orderkey % 103 = 0 then strftime(l_shipdate, '%Y-13-01')
                                else strftime(l_shipdate, '%Y-%m-%d') end, '%Y-%m-%d') as date) as date,
         case when l_orderkey % 83 = 0 then l_extendedprice - 1 else l_extendedprice + 1 end as highest,
         l_extendedprice as lowest, 1 as order_count,
         case when l_orderkey % 79 = 0 then -1 else cast(l_quantity as bigint) end as volume,
         case when l_orderkey % 73 = 0 then null
              else cast(epoch(cast(l_shipdate as timestamp)) as bigint) + l_orderkey % 86400 end as modified_epoch,
         region_id, case when l_orderkey % 101 = 0 then null else type_id end as type_id
  from lines),
valid as (
  select * from raw
  where date is not null and region_id is not null and type_id is not null
    and average >= 0 and highest >= 0 and lowest >= 0 and volume >= 0 and highest >= lowest)"""
_NEWEST = """row_number() over (partition by date, region_id, type_id order by modified_epoch desc nulls last,
    average desc nulls last, highest desc nulls last, lowest desc nulls last, order_count desc nulls last,
    volume desc nulls last) = 1"""
_WINDOWED = _MARKET + """,
windowed as (
  select date, cast(year(date) as int) as year, cast(month(date) as int) as month, region_id, type_id, average,
         lag(average, 1) over s as price_lag_1, lag(average, 3) over s as price_lag_3,
         lag(average, 7) over s as price_lag_7, avg(average) over s7 as price_mean_7,
         avg(average) over s14 as price_mean_14, stddev_samp(average) over s7 as price_std_7,
         lag(volume, 1) over s as volume_lag_1, avg(volume) over s7 as volume_mean_7,
         highest - lowest as spread, avg(highest - lowest) over s7 as spread_mean_7,
         cast(dayofweek(date) + 1 as int) as dow, lead(average, 1) over s as target_next_price
  from market
  window s as (partition by region_id, type_id order by date),
         s7 as (partition by region_id, type_id order by date rows between 7 preceding and 1 preceding),
         s14 as (partition by region_id, type_id order by date rows between 14 preceding and 1 preceding))"""
_FEATURES = _WINDOWED + """,
features as (
  select * from windowed where price_lag_7 is not null and price_std_7 is not null and target_next_price is not null)"""
_LOGS = """,
logs as (
  select type_id, region_id, ln(1 + average) as log_price, ln(1 + volume) as log_volume,
         {spread} as spread_rel from market),
stats as (
  select type_id, count(*) as n_rows, count(distinct region_id) as n_regions,
         quantile_disc(log_price, 0.5) as log_price_med, coalesce(stddev_samp(log_price), 0) as log_price_std,
         quantile_disc(log_volume, 0.5) as log_vol_med, coalesce(stddev_samp(log_volume), 0) as log_vol_std,
         quantile_disc(spread_rel, 0.5) as spread_rel_med
  from logs group by type_id having count(*) >= 200)"""
_STATS = _LOGS.format(spread="(highest - lowest) / (average + 1e-6)")
_SEGMENTED = _FEATURES + _STATS + """,
segmented as (
  select f.*, cast(f.type_id % 8 as int) as segment_id from features f join stats using (type_id))"""

_STATS_COLUMNS = """type_id, n_rows, n_regions, round(log_price_med, 6) as log_price_med,
  round(log_price_std, 6) as log_price_std, round(log_vol_med, 6) as log_vol_med,
  round(log_vol_std, 6) as log_vol_std, round(spread_rel_med, 6) as spread_rel_med"""
_DATE = "cast(date as varchar) as date"
_MARKET_COLUMNS = f"""{_DATE}, region_id, type_id, round(average, 6) as average, round(highest, 6) as highest,
  round(lowest, 6) as lowest, order_count, volume"""
_YEAR_MONTH = "cast(year(date) as int) as year, cast(month(date) as int) as month"
_SUMMARY = """round(avg(average), 6) as avg_price, cast(sum(volume) as bigint) as sum_volume,
  round(avg(highest - lowest), 6) as avg_spread"""
_ERRORS = """round(sqrt(avg(({y} - {p}) ** 2)), 6) as {prefix}rmse, round(avg(abs({y} - {p})), 6) as {prefix}mae,
  round(1 - sum(({y} - {p}) ** 2) / (var_pop({y}) * count({y})), 6) as {prefix}r2"""


def _with(blocks: str, select: str) -> str:
    return f"with {blocks.strip()}\n{select.strip()}"


def _describe_sql(name: str) -> str:
    return f"""select '{name}' as measure, count({name}) as n, round(avg({name}), 6) as mean,
  round(stddev_samp({name}), 6) as stddev, round(cast(min({name}) as double), 6) as min,
  round(cast(max({name}) as double), 6) as max from market"""


def _zscore_sql(name: str) -> str:
    return (
        f"round(case when stddev_samp({name}) over () = 0 then 0 "
        f"else ({name} - avg({name}) over ()) / stddev_samp({name}) over () end, 6) as z_{name}"
    )


# ---------------------------------------------------------------- queries

_ENTRIES: dict[str, Entry] = {}


def _register(sql: str | None = None):
    """Add the function under its own name; its result is made comparable."""

    def add(query: Query) -> Query:
        _ENTRIES[query.__name__] = Entry(lambda spark, sf_dir: comparable(query(spark, sf_dir)), sql)
        return query

    return add


# Sources and sinks

@_register(_with(_MARKET, f"select {_MARKET_COLUMNS}, cast(epoch(cast(date as timestamp)) as bigint) as modified_epoch from market"))
def scan_csv_gz(spark, sf_dir):
    """Daily rows written as gzip and bzip2 CSV (by odd and even year), read back in one scan."""
    daily = _daily(spark, sf_dir)
    files = daily.select(
        "average", "date", "highest", "lowest", "order_count", "volume",
        F.concat(F.col("date").cast("string"), F.lit("T00:00:00Z")).alias("http_last_modified"),
        "region_id", "type_id",
    )
    folders = []
    for codec, remainder in (("gzip", 0), ("bzip2", 1)):
        folders.append(scratch_path(spark, f"csv-{codec}"))
        files.filter(F.year("date") % 2 == remainder).write.csv(folders[-1], header=True, compression=codec)
    parsed = cleaning.parse_times(read_archives(spark, folders))
    return parsed.select(*daily.columns, F.unix_timestamp("http_last_modified").alias("modified_epoch"))


@_register(_with(_MARKET, f"select {_MARKET_COLUMNS}, {_YEAR_MONTH} from market"))
def parquet_roundtrip(spark, sf_dir):
    """Daily rows written by year and month and read back."""
    path = scratch_path(spark, "by-month")
    write_by_month(market(spark, sf_dir).withColumns(year_month()), path)
    return read_table(spark, path)


# Cleaning

_CLEAN_SQL = _with(_RAW, f"""select {_DATE}, region_id, type_id, round(average, 6) as average,
  round(highest, 6) as highest, round(lowest, 6) as lowest, order_count, volume, modified_epoch, {_YEAR_MONTH}
from valid qualify {_NEWEST}""")


@_register(_CLEAN_SQL)
def clean_market(spark, sf_dir):
    clean = cleaning.clean_market(raw_market(spark, sf_dir))
    return clean.withColumn("modified_epoch", F.unix_timestamp("http_last_modified")).drop("http_last_modified")


@_register(_CLEAN_SQL)
def merge_months(spark, sf_dir):
    """The clean table loaded in two parts that share months, days and keys; the second is merged into the first."""
    path = scratch_path(spark, "merged")
    raw = raw_market(spark, sf_dir)
    first = F.crc32(F.col("lowest").cast("string").cast("binary")) % 2 == 0
    for part in (raw.filter(first), raw.filter(~first)):
        merge_by_month(stored(cleaning.clean_market(part), "part"), path, cleaning.latest_per_key)
    merged = read_table(spark, path)
    return merged.withColumn("modified_epoch", F.unix_timestamp("http_last_modified")).drop("http_last_modified")


@_register(_with(_RAW, f"select distinct {_DATE}, region_id, type_id from valid"))
def dedup_keys(spark, sf_dir):
    return cleaning.distinct_keys(cleaning.valid_rows(cleaning.parse_times(raw_market(spark, sf_dir))))


@_register(_with(_RAW, f"""select {_DATE}, region_id, type_id, round(average, 6) as average,
  round(highest, 6) as highest, round(lowest, 6) as lowest, order_count, volume, modified_epoch
from raw where date is not null and region_id is not null and type_id is not null qualify {_NEWEST}"""))
def dedup_latest(spark, sf_dir):
    """Without the value rules, so the newest copy counts even if its price is missing."""
    latest = cleaning.latest_per_key(cleaning.known_keys(cleaning.parse_times(raw_market(spark, sf_dir))))
    return latest.withColumn("modified_epoch", F.unix_timestamp("http_last_modified")).drop("http_last_modified")


_RULES_SQL = {
    **{f"{c} missing": f"{c} is null" for c in ("date", "region_id", "type_id", "average", "highest", "lowest", "volume")},
    **{f"{c} negative": f"{c} < 0" for c in ("average", "highest", "lowest", "volume")},
    **{f"{c} not a number": f"isnan({c})" for c in ("average", "highest", "lowest")},
    "highest below lowest": "highest < lowest",
}


@_register(_with(_RAW, "\nunion all\n".join(
    f"select '{name}' as rule, count(*) filter ({broken}) as n_counted, count(*) filter ({broken}) as n_quarantined from raw"
    for name, broken in _RULES_SQL.items()
)))
def rejected_rows(spark, sf_dir):
    """Rows that break each rule, as counted while they were written and as kept in the quarantine table."""
    raw = raw_market(spark, sf_dir)
    counts = Observation("cleaning")
    rows = cleaning.judged(raw).observe(counts, *cleaning.rule_counts(raw))
    staged = stored(rows.withColumn("accepted", F.size("broken") == 0), "judged", partition_by="accepted")
    kept = staged.filter("not accepted").select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))
    counted = [(name, counts.get[name]) for name in cleaning.rules(cleaning.parse_times(raw))]  # a row per rule
    table = spark.createDataFrame(counted, "rule string, n_counted long")
    return table.join(kept, "rule", "left").select("rule", "n_counted", F.coalesce("n", F.lit(0)).cast("long").alias("n_quarantined"))


# Reports

@_register(_with(_MARKET, """select count(*) as n_rows, cast(min(date) as varchar) as min_date,
  cast(max(date) as varchar) as max_date, count(distinct region_id) as n_regions,
  count(distinct type_id) as n_items, count(distinct date) as n_days from market"""))
def overview(spark, sf_dir):
    return profiling.overview(market(spark, sf_dir))


@_register(_with(_MARKET, "\nunion all\n".join(
    map(_describe_sql, ("average", "highest", "lowest", "order_count", "volume"))
)))
def describe_prices(spark, sf_dir):
    return profiling.describe_prices(market(spark, sf_dir))


@_register(_with(_RAW, """select count(*) filter (date is null) as date_nulls,
  count(*) filter (region_id is null) as region_nulls, count(*) filter (type_id is null) as type_nulls,
  count(*) filter (average is null) as average_nulls, count(*) filter (volume is null) as volume_nulls from raw"""))
def missing_values(spark, sf_dir):
    return profiling.missing_values(cleaning.parse_times(raw_market(spark, sf_dir)))


@_register(_with(_RAW, """select count(*) filter (average < 0) as avg_negative,
  count(*) filter (highest < 0) as highest_negative, count(*) filter (lowest < 0) as lowest_negative,
  count(*) filter (volume < 0) as volume_negative, count(*) filter (highest < lowest) as highest_lt_lowest from raw"""))
def sanity_checks(spark, sf_dir):
    return profiling.sanity_checks(raw_market(spark, sf_dir))


@_register(_with(_MARKET, """select type_id, cast(sum(volume) as bigint) as total_volume,
  round(avg(average), 6) as avg_price, round(avg(highest - lowest), 6) as avg_spread,
  count(distinct date) as days_present
from market group by type_id order by total_volume desc, type_id limit 20"""))
def top_items(spark, sf_dir):
    return ranking.top_items(market(spark, sf_dir))


@_register(_with(_MARKET, """select region_id, cast(sum(volume) as bigint) as total_volume,
  count(distinct type_id) as n_items
from market group by region_id order by total_volume desc, region_id limit 20"""))
def top_regions(spark, sf_dir):
    return ranking.top_regions(market(spark, sf_dir))


@_register(_with(_MARKET, """select cast(dayofweek(date) + 1 as int) as dow_num, strftime(date, '%a') as dow,
  round(avg(average), 6) as avg_price, round(avg(volume), 6) as avg_volume,
  round(avg(highest - lowest), 6) as avg_spread
from market group by 1, 2 order by 1"""))
def dow_seasonality(spark, sf_dir):
    return ranking.dow_seasonality(market(spark, sf_dir))


@_register(_with(_MARKET, f"select {_YEAR_MONTH}, {_SUMMARY} from market group by 1, 2 order by 1, 2"))
def monthly_seasonality(spark, sf_dir):
    return ranking.monthly_seasonality(market(spark, sf_dir))


@_register(_with(_MARKET, """select type_id, round(avg(average), 6) as mean_price,
  round(stddev_samp(average), 6) as std_price, cast(sum(volume) as bigint) as total_volume,
  round(stddev_samp(average) / nullif(avg(average), 0), 6) as cov
from market group by type_id order by stddev_samp(average) / nullif(avg(average), 0) desc nulls last, type_id limit 20"""))
def volatility_rank(spark, sf_dir):
    return ranking.volatility_rank(market(spark, sf_dir))


@_register(_with(_MARKET, """select round(corr(average, volume), 6) as corr_average_volume,
  round(corr(average, highest - lowest), 6) as corr_average_spread,
  round(corr(volume, highest - lowest), 6) as corr_volume_spread from market"""))
def correlations(spark, sf_dir):
    return profiling.correlations(market(spark, sf_dir))


@_register(_with(_MARKET, f"""select {_DATE}, type_id, {_SUMMARY} from market
where type_id in (select type_id from market group by type_id order by sum(volume) desc, type_id limit 5)
group by 1, 2"""))
def top_item_trends(spark, sf_dir):
    return ranking.top_item_trends(_daily(spark, sf_dir))


@_register(_with(_MARKET, """select type_id, count(distinct date) as days_present
from market group by type_id order by days_present, type_id limit 20"""))
def coverage(spark, sf_dir):
    return ranking.coverage(market(spark, sf_dir))


_SLICE_SQL = _with(_MARKET, f"""select {_DATE}, region_id, {_SUMMARY} from market
where type_id = {_SLICE["type_id"]} and region_id in ({", ".join(map(str, _SLICE["region_ids"]))})
  and date between date '{_SLICE["date_from"]}' and date '{_SLICE["date_to"]}'
group by 1, 2""")


@_register(_SLICE_SQL)
def series_slice_of_view(spark, sf_dir):
    return series_slice(market(spark, sf_dir), **_SLICE)


@_register(_SLICE_SQL)
def series_slice_of_months(spark, sf_dir):
    """The same from a table partitioned by month, of which only the months in range are read."""
    path = scratch_path(spark, "by-month")
    write_by_month(market(spark, sf_dir).withColumns(year_month()), path)
    return series_slice(read_table(spark, path), **_SLICE)


_MONTHS = ((1996, 3), (1999, 10))


@_register(_with(_MARKET, """select type_id, count(*) as n_rows, cast(sum(volume) as bigint) as total_volume,
  round(avg(average), 6) as avg_price, round(min(average), 6) as min_price, round(max(average), 6) as max_price,
  round(avg(highest - lowest), 6) as avg_spread, count(distinct region_id) as n_regions
from market where date between date '1996-03-01' and date '1999-10-31' group by type_id"""))
def item_summaries_of_months(spark, sf_dir):
    """Items over a range of months from stored monthly summaries, written in two loads; so few regions are counted exactly."""
    path = scratch_path(spark, "summaries")
    monthly = stored(summaries.monthly_summaries(market(spark, sf_dir)), "monthly")
    for load in (F.col("month") <= 7, F.col("month") > 7):
        summaries.write_summaries(monthly.filter(load), path)
    return summaries.merged(summaries.read_summaries(spark, path, *_MONTHS), "type_id").drop("days_present", "price_q50")


# All reports of the analysis in one table: report -> its key columns.
_REPORT_KEYS = {
    "overview": (), "describe_prices": ("measure",), "missing_values": (), "sanity_checks": (), "top_items": ("type_id",),
    "top_regions": ("region_id",), "dow_seasonality": ("dow_num", "dow"), "monthly_seasonality": ("year", "month"),
    "volatility_rank": ("type_id",), "correlations": (), "top_item_trends": ("date", "type_id"), "coverage": ("type_id",),
}
_REPORT_MEASURES = {
    "overview": "n_rows min_date max_date n_regions n_items n_days", "describe_prices": "n mean stddev min max",
    "missing_values": "date_nulls region_nulls type_nulls average_nulls volume_nulls",
    "sanity_checks": "avg_negative highest_negative lowest_negative volume_negative highest_lt_lowest",
    "top_items": "total_volume avg_price avg_spread days_present", "top_regions": "total_volume n_items",
    "dow_seasonality": "avg_price avg_volume avg_spread", "monthly_seasonality": "avg_price sum_volume avg_spread",
    "volatility_rank": "mean_price std_price total_volume cov",
    "correlations": "corr_average_volume corr_average_spread corr_volume_spread",
    "top_item_trends": "avg_price sum_volume avg_spread", "coverage": "days_present",
}


def _report_sql(name: str) -> str:
    """The SQL of a report, over the market view, as (report, key, measure, value)."""
    of_report = _ENTRIES[name].sql.replace(_RAW.strip(), _MARKET.strip()).replace("from raw", "from market")
    keys = ", ".join(_REPORT_KEYS[name])
    measures = _REPORT_MEASURES[name].split()
    value = lambda m: f"date_diff('day', date '1970-01-01', {m}::date)" if m.endswith("_date") else m
    return f"""select '{name}' as report, concat_ws('|', ''{', ' + keys if keys else ''}) as key,
  unnest([{', '.join(f"'{m}'" for m in measures)}]) as measure,
  unnest([{', '.join(f"{value(m)}::double" for m in measures)}]) as value from ({of_report})"""


_SCHEMA_SQL = "\nunion all\n".join(
    f"select 'schema' as report, '|{name}' as key, '{kind}' as measure, 1::double as value"
    for name, kind in {"date": "date", "region_id": "int", "type_id": "int", "average": "double", "highest": "double",
                       "lowest": "double", "order_count": "int", "volume": "bigint"}.items()
)


@_register("\nunion all\n".join([*map(_report_sql, _REPORT_KEYS), _SCHEMA_SQL]))
def analysis(spark, sf_dir):
    """Every report of the analysis job and the schema, as one table with a row for each figure."""
    reports = pipelines.analyze(_daily(spark, sf_dir))
    schema = reports.pop("schema").select(
        F.lit("schema").alias("report"), F.concat(F.lit("|"), "name").alias("key"), F.col("type").alias("measure"),
        F.col("nullable").cast("double").alias("value"),
    )

    def figures(name: str, report: DataFrame) -> DataFrame:
        kinds = dict(report.dtypes)
        keys = [F.col(key).cast("string") for key in _REPORT_KEYS[name]]
        number = lambda c: F.unix_date(c) if kinds[c] == "date" else F.col(c)
        cells = [
            F.struct(F.lit(c).alias("measure"), number(c).cast("double").alias("value"))
            for c in report.columns if c not in _REPORT_KEYS[name]
        ]
        return report.select(F.lit(name).alias("report"), F.concat_ws("|", F.lit(""), *keys).alias("key"), F.inline(F.array(*cells)))

    return reduce(DataFrame.union, [figures(name, report) for name, report in reports.items()], schema)


# Series

_BASE_SQL = f"select {_DATE}, region_id, type_id, round(average, 6) as average"


@_register(_with(_WINDOWED, f"""{_BASE_SQL}, round(price_lag_1, 6) as price_lag_1,
  round(price_lag_3, 6) as price_lag_3, round(price_lag_7, 6) as price_lag_7, volume_lag_1 from windowed"""))
def lags(spark, sf_dir):
    return series.lags(market(spark, sf_dir))


@_register(_with(_WINDOWED, f"""{_BASE_SQL}, round(price_mean_7, 6) as price_mean_7,
  round(price_mean_14, 6) as price_mean_14, round(price_std_7, 6) as price_std_7,
  round(volume_mean_7, 6) as volume_mean_7, round(spread_mean_7, 6) as spread_mean_7 from windowed"""))
def rolling(spark, sf_dir):
    return series.rolling(market(spark, sf_dir))


@_register(_with(_WINDOWED, f"{_BASE_SQL}, round(target_next_price, 6) as target_next_price from windowed"))
def target(spark, sf_dir):
    return series.target(market(spark, sf_dir))


_FEATURES_SQL = _with(_FEATURES, f"""select {_DATE}, year, month, region_id, type_id, round(average, 6) as average,
  round(price_lag_1, 6) as price_lag_1, round(price_lag_3, 6) as price_lag_3, round(price_lag_7, 6) as price_lag_7,
  round(price_mean_7, 6) as price_mean_7, round(price_mean_14, 6) as price_mean_14,
  round(price_std_7, 6) as price_std_7, volume_lag_1, round(volume_mean_7, 6) as volume_mean_7,
  round(spread, 6) as spread, round(spread_mean_7, 6) as spread_mean_7, dow,
  round(target_next_price, 6) as target_next_price from features""")


@_register(_FEATURES_SQL)
def features(spark, sf_dir):
    return series.features(market(spark, sf_dir))


@_register(_FEATURES_SQL)
def features_by_loads(spark, sf_dir):
    """The same in four loads of days, each from its own rows and the state that the one before it left."""
    daily = _daily(spark, sf_dir)
    state, parts = None, []
    borders = [None, *map(F.lit, ("1996-03-01", "1998-07-15", "1998-07-16")), None]
    for start, stop in zip(borders, borders[1:]):
        rows = daily if start is None else daily.filter(F.col("date") >= start.cast("date"))
        rows = rows if stop is None else rows.filter(F.col("date") < stop.cast("date"))
        complete, after = incremental.extended(state, rows)
        parts.append(stored(complete, "new-features"))
        state = stored(after, "feature-state")
    return reduce(DataFrame.union, parts)


# Segments

@_register(_with(_MARKET + _STATS, f"select {_STATS_COLUMNS} from stats"))
def type_stats(spark, sf_dir):
    return segments.type_stats(_daily(spark, sf_dir))


@_register(_with(_MARKET + _LOGS.format(spread="cast(0 as double)"), f"select {_STATS_COLUMNS} from stats"))
def type_stats_nospread(spark, sf_dir):
    """From a table without highest and lowest."""
    return segments.type_stats(_daily(spark, sf_dir).drop("highest", "lowest"))


@_register(_with(_MARKET + _STATS, f"select type_id, {', '.join(map(_zscore_sql, segments.SEGMENT_INPUTS))} from stats"))
def zscore_stats(spark, sf_dir):
    return segments.zscores(stored(segments.type_stats(_daily(spark, sf_dir)), "type-stats"))


@_register()
def kmeans_segments(spark, sf_dir):
    _, labelled = segments.fit_segments(segments.type_stats(_daily(spark, sf_dir)))
    return labelled


@_register(_with(_MARKET + _STATS, """select count(*) as n_items, count(*) as n_assigned, count(*) as n_labels_within_k,
  cast(0 as bigint) as n_elsewhere_nearer, cast(0 as bigint) as n_unlike_model from stats"""))
def kmeans_invariants(spark, sf_dir):
    """What any correct segmentation has: every item assigned, to its nearest centroid, as its model says."""
    stats = stored(segments.type_stats(_daily(spark, sf_dir)), "type-stats")
    model, labelled = segments.fit_segments(stats)
    scores = segments.zscores(stats)
    values = [F.col(f"z_{name}") for name in segments.SEGMENT_INPUTS]
    far = F.array(*(
        sum(((value - F.lit(float(x))) ** 2 for value, x in zip(values, center)), F.lit(0.0))
        for center in segments.centers_of(model)
    ))
    again = model.transform(stats).select("type_id", F.col("segment_id").alias("by_model"))
    rows = stats.select("type_id").join(labelled.select("type_id", "segment_id"), "type_id", "left")
    rows = rows.join(scores, "type_id").join(again, "type_id").withColumn("far", far)
    label = F.col("segment_id")
    return rows.agg(
        F.count("*").alias("n_items"),
        F.count(label).alias("n_assigned"),
        F.count_if(label.between(0, SEGMENTS - 1)).alias("n_labels_within_k"),
        F.count_if(F.get("far", label) > F.array_min("far") + 1e-9).alias("n_elsewhere_nearer"),
        F.count_if(label != F.col("by_model")).alias("n_unlike_model"),
    )


@_register(_with(_MARKET + _STATS, "select type_id, type_id % 8 as segment_id from stats"))
def segment_map_roundtrip(spark, sf_dir):
    """A segment map written as an unpartitioned table, twice as the second replaces the first, and read back."""
    _, labelled = _features_and_map(spark, sf_dir)
    path = scratch_path(spark, "segment-map")
    write_table(labelled.limit(1), path)
    write_table(labelled, path)
    return read_table(spark, path)


# Training

@_register(_with(_SEGMENTED, f"""select {_DATE}, cast(region_id as varchar) as region_id,
  cast(type_id as varchar) as type_id, segment_id, round(price_lag_1, 6) as price_lag_1,
  round(target_next_price, 6) as target_next_price from segmented"""))
def segment_join(spark, sf_dir):
    return training.with_segments(*_features_and_map(spark, sf_dir)).select(
        "date", *REGRESSION_CATEGORIES, "segment_id", "price_lag_1", "target_next_price"
    )


@_register(_with(_FEATURES, f"""select {_DATE}, region_id, type_id, volume_lag_1 from features
where type_id in (select type_id from features group by type_id order by sum(volume_lag_1) desc, type_id limit {_TOP})"""))
def top_n_filter(spark, sf_dir):
    return training.keep_top_items(_feature_table(spark, sf_dir), _TOP).select(
        "date", "region_id", "type_id", "volume_lag_1"
    )


@_register(_with(_MARKET, f"""select {_MARKET_COLUMNS} from market
where cast('0x' || left(md5(concat_ws('|', '42', cast(date as varchar), cast(region_id as varchar),
  cast(type_id as varchar))), 8) as bigint) < {int(_FRACTION * 2**32)}"""))
def hash_sample(spark, sf_dir):
    return training.hash_sample(market(spark, sf_dir), _FRACTION)


@_register(_with(_SEGMENTED, """select segment_id, count(*) as n_rows from segmented
group by segment_id order by n_rows desc, segment_id limit 5"""))
def top_segments(spark, sf_dir):
    return training.largest_segments(training.with_segments(*_features_and_map(spark, sf_dir)), 5).drop("last_date")


@_register(_with(_FEATURES, f"""select {_DATE}, region_id, type_id,
  case when date >= (select max(date) - 60 from features) then 'test' else 'train' end as part from features"""))
def time_split(spark, sf_dir):
    return training.time_split(_feature_table(spark, sf_dir)).select("date", "region_id", "type_id", "part")


@_register(_with(_SEGMENTED, f"""select segment_id, part,
  {_ERRORS.format(y="target_next_price", p="price_lag_1", prefix="")}
from (select *, case when date >= max(date) over (partition by segment_id) - 60 then 'test' else 'train' end as part
      from segmented) group by segment_id, part"""))
def baseline_metrics(spark, sf_dir):
    return training.baseline_metrics(training.time_split_by_segment(_segmented(spark, sf_dir)))


_SPLIT = """,
split as (
  select *, case when date >= max(date) over (partition by segment_id) - 60 then 'test' else 'train' end as part
  from segmented)"""
_MOMENTS = _SPLIT + """,
moments as (
  select segment_id, count(*) as n, (count(*) - 1) / count(*) as a,
         corr(target_next_price, price_lag_1) as r1, corr(target_next_price, volume_lag_1) as r2,
         corr(price_lag_1, volume_lag_1) as r12, stddev_samp(target_next_price) as sy,
         stddev_samp(price_lag_1) as s1, stddev_samp(volume_lag_1) as s2,
         avg(target_next_price) as my, avg(price_lag_1) as m1, avg(volume_lag_1) as m2
  from split where part = 'train' group by segment_id)"""
_WHOLE = _FEATURES + """,
segmented as (select *, 0 as segment_id from features)"""


def _fitted(frame: DataFrame, settings: RidgeSettings, names: tuple[str, ...]) -> DataFrame:
    """Slopes and intercept per segment, with the number of train rows, from the library's own fits."""
    models, report = fit_by_segment(frame, settings)
    rows = [(segment, *slopes, intercept) for segment, (slopes, intercept) in
            ((segment, coefficients(model)) for segment, model in models.items())]
    schema = "segment_id int, " + ", ".join(f"{name} double" for name in (*names, "intercept"))
    found = frame.sparkSession.createDataFrame(rows, schema).withColumn("intercept", F.round("intercept", 3))
    return report.filter("part = 'train'").select("segment_id", "n_rows").join(found, "segment_id")


@_register(_with(_WHOLE + _MOMENTS, f"""select segment_id, n as n_rows,
  round(r1 * a / (a + {_PENALTY} / sy) * sy / s1, 6) as slope,
  round(my - r1 * a / (a + {_PENALTY} / sy) * sy / s1 * m1, 3) as intercept from moments"""))
def ridge_univariate(spark, sf_dir):
    """All items in one segment. The penalty is scaled by the label's deviation, hence the closed form in the SQL."""
    table = _feature_table(spark, sf_dir)
    whole = table.select("type_id", F.lit(0).alias("segment_id")).distinct()
    return _fitted(training_frame(table, whole, _CLOSED), _CLOSED, ("slope",))


_BIVARIATE_SLOPES = f"""
  select *, ((a + {_PENALTY} / sy) * a * r1 - a * r12 * a * r2) / ((a + {_PENALTY} / sy) ** 2 - (a * r12) ** 2) * sy / s1
              as price_slope,
            ((a + {_PENALTY} / sy) * a * r2 - a * r12 * a * r1) / ((a + {_PENALTY} / sy) ** 2 - (a * r12) ** 2) * sy / s2
              as volume_slope from moments"""
_BIVARIATE_SQL = f""", solved as ({_BIVARIATE_SLOPES})
select segment_id, n as n_rows, round(price_slope, 4) as price_slope, round(volume_slope, 4) as volume_slope,
  round(my - price_slope * m1 - volume_slope * m2, 3) as intercept from solved"""


@_register(_with(_SEGMENTED + _MOMENTS, _BIVARIATE_SQL))
def ridge_bivariate_by_segment(spark, sf_dir):
    frame = training_frame(*_features_and_map(spark, sf_dir), _CLOSED_TWO)
    fitted = _fitted(frame, _CLOSED_TWO, ("price_slope", "volume_slope"))
    # Where a fit stops moves the sixth decimal.
    return fitted.withColumns({name: F.round(name, 4) for name in ("price_slope", "volume_slope")})


@_register(_with(_SEGMENTED + _SPLIT, f"""select segment_id, part,
  case when rank > 6 then 'outside the largest n' else 'trained' end as status, count(*) as n_rows,
  {_ERRORS.format(y="target_next_price", p="price_lag_1", prefix="baseline_")},
  case when rank > 6 then 0 else count(*) end as n_predicted
from split join (select segment_id, row_number() over (order by count(*) desc, segment_id) as rank
                 from segmented group by segment_id) using (segment_id)
group by segment_id, part, rank"""))
def ridge_counts(spark, sf_dir):
    """Rows, status and naive errors of every segment, with all but the six largest left unfitted."""
    settings = replace(_CLOSED, top_n_segments=6)
    _, report = train_by_segment(*_features_and_map(spark, sf_dir), settings)
    return report.select("segment_id", "part", "status", "n_rows", "baseline_rmse", "baseline_mae", "baseline_r2", "n_predicted")


@_register(_with(_SEGMENTED, """select segment_id, count(*) as n_rows, cast(2 as double) as least, cast(2 as double) as most
from segmented group by segment_id"""))
def hashed_categories(spark, sf_dir):
    """The hashed part of a row's vector: two categories, one each, which add up where they share a slot.

    There are few slots here, so that some rows do share one."""
    rows = training.with_segments(*_features_and_map(spark, sf_dir))
    for stage in vectorizer(RidgeSettings(hash_slots=32)):
        rows = stage.transform(rows)
    total = F.aggregate(vector_to_array("cat_vec"), F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("segment_id").agg(
        F.count("*").alias("n_rows"), F.min(total).alias("least"), F.max(total).alias("most")
    )


@_register(_with(_SEGMENTED + _MOMENTS, _BIVARIATE_SQL))
def ridge_together(spark, sf_dir):
    """The same fits for all segments at once, one aggregation an iteration."""
    frame = training_frame(*_features_and_map(spark, sf_dir), _CLOSED_TWO)
    slopes = fit_together(frame, _CLOSED_TWO)
    at = lambda slot: F.max(F.when(F.col("slot") == slot, F.col("slope")))
    fitted = slopes.groupBy("segment_id").agg(
        F.round(at(0), 4).alias("price_slope"), F.round(at(1), 4).alias("volume_slope"), F.round(at(INTERCEPT), 3).alias("intercept")
    )
    sizes = frame.filter("part = 'train'").groupBy("segment_id").agg(F.count("*").alias("n_rows"))
    return sizes.join(fitted, "segment_id")


_ALL_NUMERICS = RidgeSettings(categories=(), reg_param=10.0, tolerance=1e-10, max_iter=300)


@_register(_with(_SEGMENTED + _SPLIT, f"""select segment_id, count(*) as n_rows,
  cast({' + '.join(f"(stddev_samp({name}) > 0)::int" for name in REGRESSION_NUMERICS)} as int) as n_slots, cast(0 as int) as n_off
from split where part = 'train' group by segment_id"""))
def ridge_optimality(spark, sf_dir):
    """The fit of all numeric features in every segment: slots whose gradient, penalty included, is not zero."""
    segmented = _segmented(spark, sf_dir)
    table = segmented.drop("segment_id").withColumns({c: F.col(c).cast("int") for c in REGRESSION_CATEGORIES})
    labelled = segmented.select(F.col("type_id").cast("int").alias("type_id"), "segment_id").distinct()
    slopes = fit_together(training_frame(table, labelled, _ALL_NUMERICS), _ALL_NUMERICS)
    names = REGRESSION_NUMERICS
    wide = slopes.groupBy("segment_id").pivot("slot", [INTERCEPT, *range(len(names))]).agg(F.first("slope"))
    train = training.time_split_by_segment(segmented).filter("part = 'train'").join(wide, "segment_id")
    slope = {name: F.coalesce(F.col(str(slot)), F.lit(0.0)) for slot, name in enumerate(names)}
    residual = F.col(LABEL) - sum((slope[name] * F.col(name) for name in names), F.col(str(INTERCEPT)))
    sy = F.stddev_samp(LABEL)

    def gradient(name: str) -> Column:
        sx = F.stddev_samp(name)
        return F.try_divide(F.covar_pop(F.col(name), residual), sx * sy) - _ALL_NUMERICS.reg_param / sy * F.first(slope[name]) * sx / sy

    return train.groupBy("segment_id").agg(
        F.count("*").alias("n_rows"),
        sum(((F.stddev_samp(name) > 0).cast("int") for name in names), F.lit(0)).alias("n_slots"),
        sum((F.coalesce(F.abs(gradient(name)) > 1e-6, F.lit(False)).cast("int") for name in names), F.lit(0)).alias("n_off"),
    )


@_register(_with(_SEGMENTED + _MOMENTS, f""", solved as ({_BIVARIATE_SLOPES}),
predicted as (
  select split.*, my + price_slope * (price_lag_1 - m1) + volume_slope * (volume_lag_1 - m2) as prediction
  from split join solved using (segment_id))
select segment_id, part, count(*) as n_predicted, round(avg(prediction), 1) as mean_prediction,
  {_ERRORS.format(y="target_next_price", p="prediction", prefix="").replace(", 6)", ", 1)")}
from predicted group by segment_id, part"""))
def saved_model_scores(spark, sf_dir):
    """Models fitted and saved, one folder for each segment; all rows scored from the files of all models at once."""
    table, labelled = _features_and_map(spark, sf_dir)
    table = stored(table, "features")
    folder = scratch_path(spark, "models")
    train_by_segment(table, labelled, _CLOSED_TWO, folder)
    rows = stored(training.with_segments(table, labelled), "segmented")
    scores = training.time_split_by_segment(stored(scoring.score_saved(rows, folder), "scores"))
    found = scoring.errors(scores, "segment_id", "part")
    means = scores.groupBy("segment_id", "part").agg(F.round(F.avg("prediction"), 1).alias("mean_prediction"))
    rounded = {name: F.round(name, 1) for name in ("rmse", "mae", "r2")}
    return found.withColumns(rounded).join(means, ["segment_id", "part"])


@_register()
def ridge_segmented(spark, sf_dir):
    """Every segment of the k-means map, with all features; nothing is cut."""
    daily = _daily(spark, sf_dir)
    _, labelled = segments.fit_segments(segments.type_stats(daily))
    table = stored(series.features(daily), "features")
    _, report = train_by_segment(table, labelled, RidgeSettings(), scratch_path(spark, "models"))
    return report


# Streams

_ARRIVAL_DAYS, _DELAY_DAYS, _LATE_ARRIVALS = 5, 12, 5


@_register(f"""with numbered as (
  select *, date_diff('day', (select min(ts)::date from events), ts::date) // {_ARRIVAL_DAYS} as due from events),
last as (select max(due) as due from numbered),
arriving as (
  select numbered.*, event_id % 50 = 0 and numbered.due + {_LATE_ARRIVALS} <= last.due as late from numbered, last),
counted as (
  select ts::date as day, event_type, value from arriving
  where not late and ts::date + 1 <= (select max(ts) from arriving where not late) - interval {_DELAY_DAYS} day)
select day::varchar as day, event_type, count(*) as n, round(sum(value), 2) as total from counted group by 1, 2
union all select null, 'late', (select count(*) from arriving where late), null""")
def event_windows(spark, sf_dir):
    """Daily totals of a stream of the events: some are repeated, some delayed, and some come after the watermark.

    Events arrive in parts of five days; every third is a part behind, every seventh comes twice, every fiftieth five
    parts late. Windows still open at the end are not written.
    """
    events = table(spark, sf_dir, "events")
    event = F.col("event_id")
    first = events.agg(F.min(F.col("ts").cast("date"))).scalar()
    due = F.floor(F.datediff(F.col("ts").cast("date"), first) / _ARRIVAL_DAYS).cast("int")
    known = events.withColumn("due", due)
    last = known.agg(F.max("due")).first()[0]
    late = (event % 50 == 0) & (F.col("due") + _LATE_ARRIVALS <= last)
    usual = F.col("due") + (event % 3 == 1).cast("int")
    times = F.when(late, F.array(F.col("due") + _LATE_ARRIVALS)).when(event % 7 == 0, F.array(usual, usual + 1)).otherwise(F.array(usual))
    arrivals = stored(known.select(*events.columns, F.explode(times).alias("part")), "arrivals", partition_by="part")
    folder, target, progress = (scratch_path(spark, name) for name in ("stream", "windows", "progress"))
    n_late = 0
    for part in range(last + 3):
        arrivals.filter(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
        query = ingest_windows(spark, folder, events.schema, target, progress, f"{_DELAY_DAYS} days")
        query.awaitTermination()
        n_late += late_rows(query)
    windows = closed_windows(spark, target).select(
        F.date_from_unix_date(F.floor(F.unix_seconds("start") / 86400).cast("int")).cast("string").alias("day"), "event_type", "n", F.round("total", 2).alias("total")
    )
    return windows.union(spark.createDataFrame([(None, "late", n_late, None)], windows.schema))


# Names that are taken by imports above.
_ENTRIES["series_slice"] = _ENTRIES.pop("series_slice_of_view")


def queries() -> dict[str, Query]:
    return {name: entry.run for name, entry in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in _ENTRIES.items() if entry.sql is not None}
