"""Small hand-made daily frames."""

from __future__ import annotations

import re
from datetime import date, timedelta

from tradewake.sources import job_folder

DAILY = (
    "date date, region_id int, type_id int, average double, highest double, lowest double, "
    "order_count int, volume bigint"
)
START = date(2025, 1, 1)


def day(n: int) -> date:
    return START + timedelta(days=n)


def daily_rows(prices, region=1, item=1, days=None, volumes=None):
    """One series: price i on day i (or on the given days), range of 2 around the price."""
    days = range(len(prices)) if days is None else days
    volumes = [10 * (i + 1) for i in range(len(prices))] if volumes is None else volumes
    return [
        (day(d), region, item, float(p), float(p) + 1, float(p) - 1, 1, v) for d, p, v in zip(days, prices, volumes)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DAILY)


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def parts(split):
    """Train rows and test rows of a frame with ``part``."""
    return tuple(split.filter(f"part = '{name}'").drop("part") for name in ("train", "test"))


def scans(df, of: str) -> int:
    """How many scans of files below a folder the plan has; a repeated one that is reused counts once."""
    return sum("Location" in line and of in line for line in df._jdf.queryExecution().executedPlan().toString().split("\n"))


def folder_of_jobs(spark) -> list[str]:
    """Folders of ended jobs that are still there."""
    with job_folder(spark) as folder:
        pass
    path = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return [name for name in names if re.fullmatch("[0-9a-f]{32}", name)]
