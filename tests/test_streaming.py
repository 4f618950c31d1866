import gzip
from datetime import datetime

from pyspark.sql import functions as F

from tradewake.operators.cleaning import clean_market
from tradewake.sources import read_archives
from tradewake.streaming import closed_windows, daily_view, ingest, ingest_windows, late_rows, window_totals
from tradewake.streaming.windows import in_utc

from .test_cleaning import HEADER, line


def write(folder, name, *lines):
    with gzip.open(folder / name, "wt") as out:
        out.write(HEADER + "".join(lines))


def rows(df):
    return sorted(tuple(r) for r in df.select("date", "region_id", "type_id", "average", "year", "month").collect())


def test_ingest_in_steps_equals_one_batch(spark, tmp_path):
    source, target, progress = (tmp_path / name for name in ("in", "out", "progress"))
    source.mkdir()

    def step():
        ingest(spark, str(source), str(target), str(progress), files_per_batch=1).awaitTermination()
        assert rows(daily_view(spark, str(target))) == rows(clean_market(read_archives(spark, str(source))))

    write(source, "a.csv.gz", line(average="1"), line(item="2", average="-1"), line(item="3", day="2025-13-01"))
    write(source, "b.csv.gz", line(day="2025-02-01"), line(item="", average="2"))
    step()
    # A newer copy of a known key, a newer but bad one, and the same file content again.
    write(source, "c.csv.gz", line(average="1.5", modified="2025-02-01T00:00:00Z"))
    write(source, "d.csv.gz", line(average="NaN", modified="2025-03-01T00:00:00Z"), line(day="2025-02-01"))
    step()
    step()  # nothing new
    assert len(rows(daily_view(spark, str(target)))) == 2


EVENTS = "event_id long, ts timestamp, event_type string, value double"


def stream_of(spark, folder, name, parts):
    """Each part arrives as one file and is taken in before the next; returns the windows and the late rows."""
    source, target, progress = (str(folder / f"{name}-{x}") for x in ("in", "out", "progress"))
    late = 0
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
        query = ingest_windows(spark, source, EVENTS, target, progress, delay="3 days")
        query.awaitTermination()
        late += late_rows(query)
    return sorted(tuple(r) for r in closed_windows(spark, target).collect()), late


def test_windows_do_not_depend_on_the_order_of_arrival(spark, tmp_path):
    """Repeated rows count once, rows within the delay count wherever they come, later ones are only counted."""
    at = lambda day, hour: datetime(2025, 3, day, hour)
    events = [(i, at(1 + i % 3, i % 24), "ab"[i % 2], i / 4) for i in range(30)]
    close = [(100, at(20, 0), "a", 1.0)]
    wanted = sorted(tuple(r) for r in window_totals(spark.createDataFrame(events, EVENTS)).collect())
    assert len(wanted) == 6
    one = stream_of(spark, tmp_path, "one", [events[:12] + events[5:9], events[12:] + events[:4], close])
    other = stream_of(spark, tmp_path, "other", [events[20:], events[8:24], events[:10], close, [(200, at(2, 1), "a", 5.0), (201, at(21, 1), "b", 5.0)]])
    assert one == (wanted, 0)
    assert other == (wanted, 1)


def test_times_without_a_zone_are_in_utc(spark):
    naive = spark.createDataFrame([(1, "2025-03-01 23:30:00.5")], "event_id long, t string").select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert in_utc(naive).select(F.unix_micros("ts")).first()[0] == 1740871800500000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
