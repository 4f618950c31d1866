"""The feature table extended by new days, without the history.

A feature looks back at most 14 rows of its series, and a label one row ahead. So the last 15 rows of every series are a
sufficient state: the last of them still waits for its label, and has its 14 predecessors beside it. A load of new days
computes the waiting rows and all new rows but the last of each series, which waits in its turn. The work grows with the
new rows and the number of series, not with the days on record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import day_number, spread, year_month
from ..model import FEATURE_IDS, FEATURES, KEY, LABEL, SERIES
from .series import LONGEST_FRAME, lag_columns, rolling_columns, target_column

STATE_ROWS = LONGEST_FRAME + 1
STATE_COLUMNS = (*KEY, "average", "highest", "lowest", "volume")


def late_rows(state: DataFrame, new: DataFrame) -> DataFrame:
    """New rows that are not after the last stored day of their series; their series have to be computed anew."""
    last = state.groupBy(*SERIES).agg(F.max("date").alias("last_date"))
    return new.join(last, list(SERIES)).filter(F.col("date") <= F.col("last_date")).drop("last_date")


def extended(state: DataFrame | None, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feature rows that are complete now, the state afterwards) from the state and the clean rows of new days.

    New rows come after the stored ones of their series (see ``late_rows``); a series may pause, begin or end. Without a
    state the first load begins the table. Over all loads the feature rows are those of one computation of
    all days, whatever the days are cut into.
    """
    rows = new.select(*STATE_COLUMNS, F.lit(True).alias("is_new"))
    if state is not None:
        rows = rows.union(state.select(*STATE_COLUMNS, F.lit(False)))
    by_date = Window.partitionBy(*SERIES).orderBy("date")
    computed = rows.withColumns({"spread": spread(), "dow": day_number(), **year_month()}).withColumns(
        {**lag_columns(), **rolling_columns(), **target_column(), "next_is_new": F.lead("is_new").over(by_date)}
    )
    # The label of a row is the next one; it was there before unless that one is new.
    complete = (
        computed.filter("next_is_new").na.drop(subset=[*FEATURES, LABEL]).select(*FEATURE_IDS, *FEATURES, LABEL)
    )
    from_the_end = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    after = rows.withColumn("back", F.row_number().over(from_the_end)).filter(F.col("back") <= STATE_ROWS)
    return complete, after.select(*STATE_COLUMNS)
