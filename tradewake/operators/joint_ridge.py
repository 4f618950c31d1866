"""Ridge regression for all segments together: one aggregation per iteration, however many segments there are.

The loss of a segment is quadratic, so conjugate gradients need one product of its matrix with a vector for each
step, a sum over its rows. One pass over all rows gives the products of all segments; the vectors of the iteration,
a number for each segment and slot that occurs in it, are kept beside each other and every segment has steps of its own.
Segments that have converged stand still. Jobs are as many as iterations, not as segments.

What is minimised is what MLlib's regression minimises with scaled features: half the mean square error over the label's
deviation, plus half the penalty over that deviation times the squares of the standardized slopes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import LABEL
from ..sources.workspace import stored
from .regression import VECTOR, RidgeSettings
from .scoring import COEFFICIENTS, INTERCEPT, entries_of

MOST_SLOTS = 2_000_000  # of all segments that are fitted together; more segments are fitted in several rounds


def _statistics(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """(segment_id, slot, mean, deviation) over all rows of a segment, rows that do not fill a slot counting as zero."""
    filled = entries.groupBy("segment_id", "slot").agg(
        F.count("*").alias("k"), F.avg("value").alias("filled_mean"), F.var_pop("value").alias("filled_variance")
    )
    k, n, mean = F.col("k"), F.col("n"), F.col("filled_mean")
    squares = k * F.col("filled_variance") + k * mean * mean * (n - k) / n
    joined = filled.join(sizes, "segment_id")
    return joined.select(
        "segment_id", "slot", (k * mean / n).alias("mean"), F.sqrt(F.when(n > 1, squares / (n - 1)).otherwise(0.0)).alias("deviation")
    )


class _Systems:
    """The equations of some segments; positions are those of (segment, slot) in ascending order."""

    def __init__(self, table: pd.DataFrame, sizes: pd.DataFrame, penalty: float):
        self.segments = sizes.segment_id.to_numpy()
        self.n = sizes.n.to_numpy(dtype=float)
        self.label_mean, self.label_deviation = (sizes[c].to_numpy(dtype=float) for c in ("label_mean", "label_deviation"))
        self.owner = np.searchsorted(self.segments, table.segment_id.to_numpy())
        self.slot = table.slot.to_numpy()
        self.mean, deviation = table["mean"].to_numpy(dtype=float), table.deviation.to_numpy(dtype=float)
        self.scale = np.divide(1.0, deviation, out=np.zeros(len(deviation)), where=deviation > 0)
        safe = np.where(self.label_deviation > 0, self.label_deviation, 1.0)
        self.penalty = penalty / safe
        self.keys = (table.segment_id.to_numpy(dtype=np.int64) << 32) | self.slot

    def by_segment(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=values, minlength=len(self.segments))

    def centred(self, sums: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Mean products with the standardized slots, from the sums of products with the slots and the sums alone."""
        return self.scale * (sums - self.mean * totals[self.owner]) / self.n[self.owner]


def _positions(rows: DataFrame, systems: _Systems) -> DataFrame:
    """(segment, label, at, value): the rows with positions in place of slots, written to the shared folder."""
    shared = rows.sparkSession.sparkContext.broadcast((systems.segments, systems.keys))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, keys = shared.value
        for batch in batches:
            segment, label, slots, values = batch.columns
            sizes = np.diff(slots.offsets.to_numpy())
            key = (np.repeat(segment.to_numpy().astype(np.int64), sizes) << 32) | slots.flatten().to_numpy()
            at = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.searchsorted(keys, key), pa.int32())
            )
            own = pa.array(np.searchsorted(segments, segment.to_numpy()), pa.int32())
            yield pa.RecordBatch.from_arrays([own, label, at, values], ["segment", "label", "at", "value"])

    return stored(rows.mapInArrow(number, "segment int, label double, at array<int>, value array<double>"), "positions")


def _products(rows: DataFrame, systems: _Systems, direction: np.ndarray | None) -> np.ndarray:
    """One pass: for each segment the mean products of its standardized slots with a number of each row.

    The number is the row's value in the given direction, or its standardized label if there is none.
    """
    n_segments, n = len(systems.segments), len(systems.keys)
    if direction is None:
        offset = -systems.label_mean / np.where(systems.label_deviation > 0, systems.label_deviation, 1.0)
        weight = np.divide(1.0, systems.label_deviation, out=np.zeros(n_segments), where=systems.label_deviation > 0)
    else:
        weight = systems.scale * direction
        offset = -systems.by_segment(weight * systems.mean)
    shared = rows.sparkSession.sparkContext.broadcast((weight, offset))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, offset = shared.value
        sums, totals = np.zeros(n), np.zeros(n_segments)
        for batch in batches:
            segment, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at, value = batch.column(2), batch.column(3)
            sizes = np.diff(at.offsets.to_numpy())
            at, value = at.flatten().to_numpy(), value.flatten().to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            if direction is None:
                number = label * weight[segment] + offset[segment]
            else:
                number = np.bincount(row, weights=weight[at] * value, minlength=len(sizes)) + offset[segment]
            np.add.at(sums, at, number[row] * value)
            np.add.at(totals, segment, number)
        both = np.concatenate([sums, totals])
        place = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(both[place])], ["place", "total"])

    added = rows.mapInArrow(add, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).toPandas()
    both = np.zeros(n + n_segments)
    both[added.place.to_numpy()] = added.total.to_numpy()
    shared.unpersist()
    return systems.centred(both[:n], both[n:])


def _solved(rows: DataFrame, systems: _Systems, max_iter: int, tolerance: float) -> np.ndarray:
    """The standardized slopes of all segments, by conjugate gradients side by side."""
    slopes = np.zeros(len(systems.keys))
    rest = _products(rows, systems, None)
    direction = rest.copy()
    square = systems.by_segment(rest * rest)
    enough = tolerance**2 * square
    for _ in range(max_iter):
        going = square > enough
        if not going.any():
            break
        direction *= going[systems.owner]
        product = _products(rows, systems, direction) + systems.penalty[systems.owner] * direction
        curve = systems.by_segment(direction * product)
        step = np.divide(square, curve, out=np.zeros(len(square)), where=going & (curve > 0))
        slopes += step[systems.owner] * direction
        rest -= step[systems.owner] * product
        after = systems.by_segment(rest * rest)
        ratio = np.divide(after, square, out=np.zeros(len(square)), where=going)
        direction = rest + ratio[systems.owner] * direction
        square = np.where(going, after, square)
    return slopes


def fit_together(frame: DataFrame, settings: RidgeSettings = RidgeSettings(), most_slots: int = MOST_SLOTS) -> DataFrame:
    """(segment_id, slot, slope) of the ridge models of all segments of a training frame, with intercepts in slot -1.

    Fits the train rows of segments that have as many as the settings ask for, at least two. The iteration's vectors, a
    few numbers for each segment and filled slot, are held by the driver and by each task; beyond ``most_slots`` of
    them the segments are fitted in several rounds. Each segment stops by itself when its gradient has shrunk by
    the tolerance. A penalty with an absolute part (elastic net) is not quadratic and is refused.
    """
    if settings.elastic_net:
        raise ValueError("only squared penalties are fitted together; see fit_by_segment")
    spark = frame.sparkSession
    filled = entries_of(F.unwrap_udt(F.col(VECTOR)))
    train = frame.filter((F.col("part") == "train") & F.col(LABEL).isNotNull())
    rows = stored(
        train.select("segment_id", F.col(LABEL).alias("label"), filled.alias("entries"))
        .select("segment_id", "label", F.col("entries.slot").alias("slot"), F.col("entries.value").alias("value")),
        "train-entries",
    )
    sizes = stored(
        rows.groupBy("segment_id")
        .agg(F.count("*").alias("n"), F.avg("label").alias("label_mean"), F.stddev_samp("label").alias("label_deviation"))
        .filter(F.col("n") >= max(settings.min_rows_train, 2)),
        "segment-sizes",
    )
    entries = rows.select("segment_id", F.inline(F.arrays_zip("slot", "value")))
    statistics = stored(_statistics(entries, sizes), "slot-statistics")
    # A row per segment: how many slots it has decides the rounds.
    slots = sizes.join(statistics.groupBy("segment_id").agg(F.count("*").alias("slots")), "segment_id")
    chosen = slots.orderBy("segment_id").toPandas()
    found = []
    while len(chosen):
        round_ = chosen[: max(1, int((chosen.slots.cumsum() <= most_slots).sum()))]
        chosen = chosen[len(round_) :]
        within = F.col("segment_id").between(int(round_.segment_id.min()), int(round_.segment_id.max()))
        table = statistics.filter(within).orderBy("segment_id", "slot").toPandas()
        systems = _Systems(table, round_, settings.reg_param)
        of_round = rows.join(F.broadcast(sizes.filter(within).select("segment_id")), "segment_id", "left_semi")
        standardized = _solved(_positions(of_round, systems), systems, settings.max_iter, settings.tolerance)
        slopes = standardized * systems.scale * systems.label_deviation[systems.owner]
        intercepts = systems.label_mean - systems.by_segment(slopes * systems.mean)
        found.append(pd.DataFrame({
            "segment_id": np.concatenate([systems.segments[systems.owner], systems.segments]),
            "slot": np.concatenate([systems.slot, np.full(len(systems.segments), INTERCEPT)]),
            "slope": np.concatenate([slopes, intercepts]),
        }))
    if not found:
        return spark.createDataFrame([], COEFFICIENTS)
    return stored(spark.createDataFrame(pd.concat(found), COEFFICIENTS), "coefficients")
