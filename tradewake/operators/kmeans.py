"""k-means whose result depends on the rows alone, not on how they are laid out or added up.

Points are rows of a few numbers and an id. Every quantity that is summed over rows is rounded to a decimal first, so sums
are exact whatever the order of adding; every draw is a hash of the row's id, the seed and the round. So any number of
partitions and executors gives the same centroids, and each step is an aggregation that ends in a few rows: the cost,
the drawn candidates (a few times k for each round) or a sum for each cluster.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = 12  # decimals of a summed value
_EXACT = f"decimal(30,{_SCALE})"
_DRAWS = 2**40


def exact_sum(value: Column) -> Column:
    """A sum of numbers below 10^18 that does not depend on the order of rows, as a double; null if there are none."""
    return F.sum(F.round(value, _SCALE).cast(_EXACT)).cast("double")


def standardizer(rows: DataFrame, names: list[str]) -> tuple[list[float], list[float]]:
    """Mean and sample deviation of each column, the latter zero where a column is constant."""
    first = rows.agg(F.count("*").alias("n"), *(exact_sum(F.col(c)).alias(c) for c in names)).first()
    means = [first[c] / first.n for c in names]
    squares = rows.agg(*(exact_sum((F.col(c) - mean) ** 2).alias(c) for c, mean in zip(names, means))).first()
    return means, [math.sqrt(squares[c] / (first.n - 1)) if first.n > 1 else 0.0 for c in names]


def scaled(name: str, mean: float, deviation: float) -> str:
    """SQL of a standardized column; zero for a constant one."""
    return f"((`{name}` - {mean!r}D) / {deviation!r}D)" if deviation > 0 else "0.0D"


def square_distances(values: list[str], centers: list[tuple[float, ...]]) -> str:
    """SQL of the array of square distances from a row to each centre."""
    return "array(" + ", ".join(
        " + ".join(f"({v} - {float(x)!r}D) * ({v} - {float(x)!r}D)" for v, x in zip(values, center)) for center in centers
    ) + ")"


def nearest(values: list[str], centers: list[tuple[float, ...]]) -> str:
    """SQL of the number of the nearest centre, the first among equals."""
    far = square_distances(values, centers)
    return f"transform(array({far}), d -> cast(array_position(d, array_min(d)) - 1 as int))[0]"


def _draw(id_col: str, seed: int, round_: int) -> Column:
    """A number in [0, 1) that depends on the row's id, the seed and the round."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(round_)), F.lit(_DRAWS)) / F.lit(float(_DRAWS))


def _candidates(points: DataFrame, id_col: str, values: list[str], k: int, seed: int, rounds: int) -> list[tuple]:
    """Points drawn in proportion to their square distance from those drawn before, about 2 k in each round."""
    row = [F.col(v) for v in values]
    first = points.orderBy(_draw(id_col, seed, 0), id_col).select(*row).first()
    found = [tuple(first)]
    for round_ in range(1, rounds + 1):
        cost = F.array_min(F.expr(square_distances(values, found)))
        rows = points.withColumn("cost", cost)
        total = rows.agg(exact_sum(F.col("cost")).alias("cost")).first().cost
        if not total:
            break
        drawn = rows.filter(_draw(id_col, seed, round_) < 2 * k * F.col("cost") / F.lit(total))
        found += [tuple(r) for r in drawn.select(*row).distinct().collect()]
    return sorted(set(found))


def _starts(candidates: list[tuple], weights: np.ndarray, k: int, seed: int) -> list[tuple]:
    """k of the candidates by weighted k-means++, improved by a few rounds among the candidates."""
    points, draw = np.array(candidates, dtype=float), np.random.default_rng(seed)
    chosen = [int(weights.argmax())]
    far = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(points)):
        mass = np.cumsum(weights * far)
        if not mass[-1]:
            break
        chosen.append(int(np.searchsorted(mass, draw.random() * mass[-1], side="right")))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    centers = points[chosen]
    for _ in range(30):
        label = ((points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        held = np.array([weights[label == i].sum() for i in range(len(centers))])
        moved = np.array([
            (points[label == i] * weights[label == i, None]).sum(axis=0) / held[i] if held[i] else centers[i]
            for i in range(len(centers))
        ])
        if (moved == centers).all():
            break
        centers = moved
    return [tuple(map(float, center)) for center in centers]


def _moved(points: DataFrame, values: list[str], centers: list[tuple[float, ...]]) -> list[tuple[float, ...]]:
    """Each centre moved to the mean of its points; one without points stays."""
    sums = (
        points.groupBy(F.expr(nearest(values, centers)).alias("cluster"))
        .agg(F.count("*").alias("n"), *(exact_sum(F.col(v)).alias(v) for v in values))
        .collect()  # a row per centre
    )
    means = {row.cluster: tuple(row[v] / row.n for v in values) for row in sums}
    return [means.get(i, center) for i, center in enumerate(centers)]


def fit(
    points: DataFrame, id_col: str, values: list[str], k: int, seed: int, rounds: int = 5, max_iter: int = 50
) -> list[tuple[float, ...]]:
    """The centroids of at most k clusters, in ascending order, of a stored table of points without nulls.

    Starting points come from k-means||: candidates are drawn over ``rounds`` passes, weighted by the number of points
    nearest to each, and reduced to k. Then centres move to the means of their points until none moves, or
    ``max_iter`` times. Fewer different points than k give fewer clusters.
    """
    candidates = _candidates(points, id_col, values, k, seed, rounds)
    near = points.groupBy(F.expr(nearest(values, candidates)).alias("cluster")).count().collect()  # a row per candidate
    weights = np.zeros(len(candidates))
    for row in near:
        weights[row["cluster"]] = row["count"]
    centers = _starts(candidates, weights, k, seed)
    for _ in range(max_iter):
        moved = _moved(points, values, centers)
        if moved == centers:
            break
        centers = moved
    return sorted(set(centers))


def total_cost(points: DataFrame, values: list[str], centers: list[tuple[float, ...]]) -> float:
    """The sum of square distances from points to their centres."""
    return points.agg(exact_sum(F.array_min(F.expr(square_distances(values, centers))))).first()[0]
