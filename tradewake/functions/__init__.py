"""Column expressions; all of them built-in, none of them a Python UDF."""

from .expressions import (
    day_name,
    day_number,
    log_size,
    median,
    pearson,
    present,
    ratio,
    relative_spread,
    spread,
    year_month,
)
from .metrics import mae, r2, rmse, score, usable

__all__ = [
    "day_name", "day_number", "log_size", "median", "pearson", "present", "ratio", "relative_spread",
    "spread", "year_month", "mae", "r2", "rmse", "score", "usable",
]
