"""Verdicts on captures of pages by dated lists of hosts and paths.

A list is a log of dated entries: from a day on, a pattern is blocked, allowed, or no longer listed. The entries of a
pattern become intervals of validity, each ending where the next begins. An as-of join then evaluates every capture
against the entries that were active when it was fetched: the capture's host and the domains above it, each with
the prefixes of its path, are joined by equality with the patterns, and the interval must contain the time
of the fetch. Of several active entries the most specific decides, and a block before an allowance.

Scale: a capture gives a key for each depth (labels of the domain, segments of the path) that occurs in the lists and that its
address reaches; depths are few, whatever the number of entries, and no page content is carried. Captures are first reduced to distinct addresses and times, and keys that no
list has are dropped by the join; where one host holds many captures the join is an ordinary equality join that
adaptive execution splits. Of the lists only their distinct depths go to the driver, and no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.workspace import stored

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"
NOT_LISTED = "none"


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and a final dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"(:[0-9]*)?$", "")
    host = F.regexp_replace(F.lower(host), r"\.$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """The path from its first slash, without query and fragment; a slash if it is empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def pattern_of(text: Column) -> Column:
    """A list's pattern in the form of the keys: host without user, port, final dot and leading ``*.``, path segments.

    A scheme, a query, a fragment and empty segments are dropped, and all is in lower case: paths ignore case. Null
    where no host is left.
    """
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    url = F.concat(F.lit("x://"), F.regexp_replace(bare, r"^\*\.", ""))
    parts = _parts(path_of(url))
    return F.concat(host_of(url), F.when(F.size(parts) > 0, F.concat(F.lit("/"), F.array_join(parts, "/"))).otherwise(""))


def validity(entries: DataFrame) -> DataFrame:
    """(list, pattern, action, valid_from, valid_to): the intervals of an entry log, open ends null.

    ``entries`` has list, pattern, action and listed_at. Of entries of one pattern at one time a removal goes first,
    then a block, then an allowance, so the last one holds; repeated rows count once, rows with a null in pattern, action or
    time and unknown actions are left out, and a null list is a list of its own.
    """
    strength = F.when(F.col("action") == REMOVE, 0).when(F.col("action") == BLOCK, 1).otherwise(2)
    known = (
        entries.select("list", pattern_of(F.col("pattern")).alias("pattern"), "action", "listed_at")
        .filter(
            F.col("pattern").isNotNull() & F.col("listed_at").isNotNull() & F.col("action").isin(BLOCK, ALLOW, REMOVE)
        )
        .groupBy("list", "pattern", "listed_at")
        .agg(F.max(F.struct(strength.alias("strength"), "action")).alias("last"))
        .select("list", "pattern", "listed_at", "last.action")
    )
    # A pattern's entries in one list: as many as it changed.
    history = Window.partitionBy("list", "pattern").orderBy("listed_at")
    return (
        known.withColumn("valid_to", F.lead("listed_at").over(history))
        .filter(F.col("action") != REMOVE)
        .select("list", "pattern", "action", F.col("listed_at").alias("valid_from"), "valid_to")
    )


def _parts(path: Column) -> Column:
    return F.filter(F.split(F.lower(path), "/"), lambda x: x != "")


def _depths(entries: DataFrame) -> list[tuple[int, list[int]]]:
    """The numbers of labels that occur in patterns, each with the numbers of path segments that occur with it."""
    host, path = F.split_part("pattern", F.lit("/"), F.lit(1)), F.regexp_replace("pattern", "^[^/]*", "")
    rows = entries.filter(F.col("pattern").isNotNull()).select(
        F.size(F.split(host, r"\.")).alias("labels"), F.size(_parts(path)).alias("segments")
    ).distinct().groupBy("labels").agg(F.sort_array(F.collect_list("segments")).alias("segments")).collect()
    return sorted((r.labels, list(r.segments)) for r in rows)


def _keys(host: Column, path: Column, depths: list[tuple[int, list[int]]]) -> Column:
    """Patterns that could name an address, as structs of key, labels and segments: domains, each with path prefixes.

    Only those of the given depths, as no pattern has others.
    """
    if not depths:
        return F.array().cast("array<struct<key:string,labels:int,segments:int>>")
    labels, parts = F.split(host, r"\."), _parts(path)
    given = F.array(*(F.struct(F.lit(n).alias("labels"), F.array(*map(F.lit, ms)).alias("segments")) for n, ms in depths))

    def keys(d: Column) -> Column:
        domain = F.array_join(F.slice(labels, F.size(labels) - d["labels"] + 1, d["labels"]), ".")
        return F.transform(
            F.filter(d["segments"], lambda m: m <= F.size(parts)),
            lambda m: F.struct(
                F.concat(domain, F.when(m == 0, "").otherwise(F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), m), "/")))).alias("key"),
                d["labels"].alias("labels"),
                m.alias("segments"),
            ),
        )

    return F.flatten(F.transform(F.filter(given, lambda d: d["labels"] <= F.size(labels)), keys))


def verdicts(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at"
) -> DataFrame:
    """(id, host, verdict, list, pattern, valid_from): what the lists said of each capture when it was fetched.

    The verdict is block, allow, or none where no entry was active. A null or malformed url, or a null time, gives
    none, with null list and pattern. Patterns are a domain, which covers the domains below it, optionally with the beginning of
    a path in whole segments, and are brought into one form first (see ``pattern_of``); that form is returned. Between equally specific entries a block wins, then the later one, then the smaller list and
    pattern. An entry holds from its own time on, until just before the next one's. Every capture gives a row, repeated ones too;
    other columns have no effect; with no entries all verdicts are none.
    """
    rows = captures.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.col(time_col).alias("time"),
    )
    addresses = rows.filter(F.col("host").isNotNull() & F.col("time").isNotNull()).select("host", "path", "time").distinct()
    intervals = stored(validity(entries), "validity")
    keys = addresses.select("host", "path", "time", F.inline(_keys(F.col("host"), F.col("path"), _depths(intervals))))
    active = keys.join(intervals, keys["key"] == intervals["pattern"]).filter(
        (F.col("time") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("time") < F.col("valid_to")))
    )
    # The best entry as a minimum: most specific, block first, latest, then by name.
    order = F.struct(
        (-F.col("labels")).alias("a"), (-F.col("segments")).alias("s"),
        F.when(F.col("action") == BLOCK, 0).otherwise(1).alias("b"), (-F.unix_micros(F.col("valid_from").cast("timestamp"))).alias("c"), F.col("list"), F.col("pattern"),
        F.col("action"), F.col("valid_from"),
    )
    best = active.groupBy("host", "path", "time").agg(F.min(order).alias("best")).select(
        "host", "path", "time", "best.list", "best.pattern", "best.action", "best.valid_from"
    )
    return rows.join(best, ["host", "path", "time"], "left").select(
        F.col("id").alias(id_col), "host", F.coalesce("action", F.lit(NOT_LISTED)).alias("verdict"), "list", "pattern", "valid_from"
    )
