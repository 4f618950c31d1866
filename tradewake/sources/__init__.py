"""Readers, writers and the shared work folder."""

from .archives import read_archives
from .tables import between_dates, finish_merge, in_months, merge_by_month, read_table, read_version, write_by_month, write_table, write_version
from .workspace import discard, job_folder, release, scratch_path, stored

__all__ = [
    "read_archives", "between_dates", "finish_merge", "in_months", "merge_by_month", "read_table", "read_version", "write_by_month", "write_table", "write_version",
    "discard", "job_folder", "release", "scratch_path", "stored",
]
