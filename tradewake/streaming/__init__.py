"""The cleaning rules over a stream of new daily files."""

from .ingest import daily_view, ingest, new_archives
from .windows import closed_windows, ingest_windows, late_rows, window_totals

__all__ = ["daily_view", "ingest", "new_archives", "closed_windows", "ingest_windows", "late_rows", "window_totals"]
