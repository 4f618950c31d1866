import glob
import os

import pytest

from tradewake.operators.cleaning import clean_market, latest_per_key
from tradewake.plans import pipelines
from tradewake.sources import finish_merge, in_months, merge_by_month, read_archives, read_table, tables, write_by_month

from .helpers import folder_of_jobs, plan
from .test_cleaning import archives, line  # noqa: F401


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def files(path, month):
    return sorted(map(os.path.basename, glob.glob(f"{path}/year=2025/month={month}/*.parquet")))


def test_days_of_a_month_arrive_one_by_one(spark, archives, tmp_path_factory):
    """Newer, older and bad copies of stored keys among them, in either order of the archives."""
    loads = [
        [line(day="2025-01-05"), line(day="2025-01-05", item="2", modified="2025-02-01T00:00:00Z"), line(day="2025-02-01")],
        [line(day="2025-01-06"), line(day="2025-01-05", average="1.5", modified="2025-01-09T00:00:00Z")],
        [line(day="2025-01-05", item="2", average="7"), line(day="2025-01-06", average="-1", modified="2026-01-01T00:00:00Z")],
        [line(day="2025-13-01")],
    ]
    folder = archives({f"{i}.csv.gz": lines for i, lines in enumerate(loads)})
    whole = rows(clean_market(read_archives(spark, folder + "/*.csv.gz")))
    for order in (range(4), reversed(range(4))):
        target = str(tmp_path_factory.mktemp("daily") / "table")
        months = [pipelines.extend(spark, f"{folder}/{i}.csv.gz", target) for i in order]
        assert rows(read_table(spark, target)) == whole
        assert sorted(map(len, months)) == [0, 1, 1, 2]
    assert len(whole) == 4 and not folder_of_jobs(spark)


def test_other_months_are_neither_read_nor_written(spark, archives, tmp_path):
    folder = archives({"a.csv": [line(day="2025-01-05"), line(day="2025-02-01")], "b.csv": [line(day="2025-02-02")]})
    target = str(tmp_path / "daily")
    pipelines.extend(spark, f"{folder}/a.csv", target)
    before = files(target, 1)
    assert pipelines.extend(spark, f"{folder}/b.csv", target) == [(2025, 2)]
    assert files(target, 1) == before and read_table(spark, target).count() == 3
    scan = in_months(read_table(spark, target), [(2025, 2)])
    assert [os.path.basename(os.path.dirname(f)) for f in scan.select("date").inputFiles()]
    text = plan(scan)
    assert "PartitionFilters: [" in text and "year" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_an_interrupted_merge_is_completed(spark, archives, tmp_path, monkeypatch):
    folder = archives({"a.csv": [line(day="2025-01-05")], "b.csv": [line(day="2025-01-06")], "c.csv": [line(day="2025-01-07")]})
    target = str(tmp_path / "daily")
    pipelines.extend(spark, f"{folder}/a.csv", target)

    def broken(spark, path):
        raise OSError("the store went away")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "finish_merge", broken)
        with pytest.raises(OSError):
            merge_by_month(clean_market(read_archives(spark, f"{folder}/b.csv")), target, latest_per_key)
    staged = clean_market(read_archives(spark, f"{folder}/[ab].csv"))
    write_by_month(staged, tables._staged(target))  # what the interrupted run had staged
    (tmp_path / "daily" / "year=2025" / "month=1").rename(tmp_path / "lost")  # and the month it was about to replace
    assert finish_merge(spark, target) and not finish_merge(spark, target)
    assert [r.date.day for r in read_table(spark, target).orderBy("date").collect()] == [5, 6]
    # What was staged in part only has no effect.
    write_by_month(clean_market(read_archives(spark, f"{folder}/c.csv")), tables._staged(target))
    os.remove(tables._staged(target) + "/_SUCCESS")
    assert not finish_merge(spark, target)
    assert pipelines.extend(spark, f"{folder}/c.csv", target) == [(2025, 1)]
    assert [r.date.day for r in read_table(spark, target).orderBy("date").collect()] == [5, 6, 7]
