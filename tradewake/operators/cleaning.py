"""From raw rows to the clean daily table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import present, year_month
from ..model import DATE_FORMAT, KEY, NON_NEGATIVE

_MODIFIED = "http_last_modified"
# Text that ends with its time of day, and so has no zone.
_MINUTES = r"[ T][0-9]{1,2}:[0-9]{2}$"
_SECONDS = r"[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?$"
_DAY = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"


def _with_zone(text: Column) -> Column:
    """Times without a zone are in UTC, whatever the session's zone."""
    text = F.rtrim(text)
    return (
        F.when(text.rlike(_DAY), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(_MINUTES), F.concat(text, F.lit(":00Z")))
        .when(text.rlike(_SECONDS), F.concat(text, F.lit("Z")))
        .otherwise(text)
    )


def parse_times(raw: DataFrame) -> DataFrame:
    """Turn the two text columns into a date and a timestamp; text that does not parse gives null."""
    text = {name for name, kind in raw.dtypes if kind == "string"}
    parsers = {
        "date": F.try_to_date("date", DATE_FORMAT),
        _MODIFIED: F.try_to_timestamp(_with_zone(F.col(_MODIFIED))),
    }
    return raw.withColumns({name: parse for name, parse in parsers.items() if name in text})


def known_keys(df: DataFrame) -> DataFrame:
    """Rows whose whole key is known."""
    return df.filter(present(df, *KEY))


_MISSING, _NEGATIVE, _NAN, _CROSSED = "{} missing", "{} negative", "{} not a number", "highest below lowest"


def rules(df: DataFrame, keep_nan: bool = False) -> dict[str, Column]:
    """When a row breaks each of the rules of ``valid_rows``, by name; a row is valid if it breaks none."""
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    found = {_MISSING.format(name): F.col(name).isNull() for name in (*KEY, *NON_NEGATIVE)}
    found |= {_NEGATIVE.format(name): F.coalesce(F.col(name) < 0, F.lit(False)) for name in NON_NEGATIVE}
    if not keep_nan:
        found |= {_NAN.format(name): F.coalesce(F.isnan(name), F.lit(False)) for name in NON_NEGATIVE if name in floating}
    return found | {_CROSSED: F.coalesce(F.col("highest") < F.col("lowest"), F.lit(False))}


def judged(raw: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Parsed rows with ``broken``, the names of the rules that each of them breaks."""
    rows = parse_times(raw)
    names = [F.when(broken, F.lit(name)) for name, broken in rules(rows, keep_nan).items()]
    return rows.withColumn("broken", F.array_compact(F.array(*names)))


def rule_counts(raw: DataFrame, keep_nan: bool = False) -> list[Column]:
    """Aggregates over judged rows: how many there are, how many are rejected, and how many break each rule."""
    rejected = F.count_if(F.size("broken") > 0).alias("rejected")
    each = [F.count_if(F.array_contains("broken", name)).alias(name) for name in rules(parse_times(raw), keep_nan)]
    return [F.count("*").alias("rows"), rejected, *each]


def valid_rows(df: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Rows with a known key, no negative price or volume, and highest >= lowest.

    A null in any compared column fails its comparison, so the row goes. NaN compares as larger
    than every number and would pass; it is rejected unless ``keep_nan``.
    """
    rules = [F.col(name) >= 0 for name in NON_NEGATIVE]
    rules.append(F.col("highest") >= F.col("lowest"))
    if not keep_nan:
        floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
        rules += [~F.isnan(name) for name in NON_NEGATIVE if name in floating]
    return known_keys(df).filter(reduce(and_, rules))


def distinct_keys(df: DataFrame) -> DataFrame:
    """The keys that occur, once each."""
    return df.select(*KEY).distinct()


def latest_per_key(df: DataFrame) -> DataFrame:
    """One row per key: the last modified, and among equals the largest in the other columns.

    The order is total, so the survivor does not depend on how the rows are laid out. As a plain
    maximum it is reduced before the shuffle: a key holding a third of all rows costs each task
    one row, where a row number over the key would gather the copies in a single task. A maximum of
    several columns is aggregated by sorting, before and after the shuffle; that is its price.
    """
    others = [name for name in df.columns if name not in KEY]
    newest_first = sorted(others, key=lambda name: name != _MODIFIED)
    if not newest_first:
        return distinct_keys(df)
    return (
        df.groupBy(*KEY)
        .agg(F.max(F.struct(*newest_first)).alias("kept"))
        .select(*KEY, "kept.*")
        .select(*df.columns)
    )


def clean_market(raw: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Parse, validate, deduplicate, and add year and month.

    Copies are resolved after validation, so a good copy outlives a newer bad one.
    """
    good = valid_rows(parse_times(raw), keep_nan=keep_nan)
    return latest_per_key(good).withColumns(year_month())


def clean_judged(rows: DataFrame) -> DataFrame:
    """The same from judged rows."""
    return latest_per_key(rows.filter(F.size("broken") == 0).drop("broken")).withColumns(year_month())
