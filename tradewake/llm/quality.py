"""A quality score per document: regularised quadratic discriminant over document statistics.

Every text is described by a few statistics of its characters, words and lines, transformed so that shares
and counts spread evenly (logit and logarithm). Each class gets a mean and a covariance, shrunk towards the
covariance of both and towards its diagonal; the score is the logistic function of the difference of the two log
densities, from Mahalanobis distances by Cholesky factors that are computed once at the fit.

Scale: the fit needs counts, sums and products of the statistics per class. They are summed in the tasks and then by
Spark over all labelled rows; what reaches the driver has a fixed size. Scoring is one pass over the text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored
from .common import id_hash, id_map, is_set, map_arrow, rows_where

THRESHOLD = 0.3
SHRINKAGE = 0.1  # towards the covariance of both classes
RIDGE = 0.1  # added to variances, in units of the statistics' overall variance
TEMPERATURE = 4.0  # divides the density difference, since the statistics are not independent draws

_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SPACES = b" \t\n\r\x0b\x0c"
_PLAIN_MARKS = b".,;:'\"()-?!@+/=_"  # of prose, addresses and numbers
_ENDS = b".!?"
_BLOCK = 1 << 20  # bytes compressed at a time

NAMES = (
    "length", "word_length", "letters", "upper", "symbols", "marks", "ends", "lines", "distinct", "top_word",
    "repeats", "joined_marks", "bare_marks", "distinct_lines", "compression", "long_words",
)


def _logit(part: float, whole: float) -> float:
    """The log odds of a share, with half a case added to either side."""
    return math.log((part + 0.5) / (max(whole - part, 0.0) + 0.5))


def statistics(data: bytes | None) -> list[float]:
    """The transformed statistics of a text in UTF-8, in the order of ``NAMES``; defined for an empty text."""
    data = data or b""
    n = len(data)
    words = data.split()
    count = len(words)
    size = lambda kept: n - len(data.translate(None, kept))
    letters, upper, digits, spaces = size(_LETTERS), size(_UPPER), size(_DIGITS), size(_SPACES)
    marks, ends = size(_PLAIN_MARKS), size(_ENDS)
    symbols = n - letters - digits - spaces - marks
    seen = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    tails = sum(not word[-1:].isalnum() and word[-1] < 128 and word[-1:] not in (b".", b",") for word in words)
    packed = sum(len(zlib.compress(data[i : i + _BLOCK], 1)) for i in range(0, n, _BLOCK))
    return [
        math.log1p(n),
        math.log1p(n / (count + 1)),
        _logit(letters + digits, n),
        _logit(upper, letters),
        _logit(symbols, n),
        _logit(marks, n),
        _logit(ends, count),
        math.log1p(100 * len(lines) / (count + 1)),
        math.log1p(len(seen)) - 0.8 * math.log1p(count),
        _logit(max(seen.values(), default=0), count),
        _logit(repeats, count),
        _logit(tails, count),
        _logit(sum(k for w, k in seen.items() if len(w) == 1 and not w.isalnum() and w[0] < 128), count),
        _logit(len(lines) - len(set(lines)), len(lines)),
        math.log((packed + 20) / (n + 20)),
        _logit(sum(k for w, k in seen.items() if len(w) > 20), count),
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", out_col: str = "statistics") -> DataFrame:
    """The rows with an array of statistics of the text."""

    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(text) for text in texts])

    return docs.withColumn(out_col, measure(F.col(text_col).cast("binary")))


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): log prior plus log determinant term, mean, and inverse Cholesky factor; or a constant score."""

    constant: float | None
    terms: tuple = ()
    temperature: float = TEMPERATURE

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The score of class 1, from 0 to 1, for rows of statistics."""
        if self.constant is not None:
            return np.full(len(rows), self.constant)
        bad, good = (
            bias - 0.5 * (((rows - mean) @ factor.T) ** 2).sum(axis=1) for bias, mean, factor in self.terms
        )
        return 1 / (1 + np.exp(np.clip((bad - good) / self.temperature, -700, 700)))


def _moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class its count, sums and sums of products. ``labelled`` has ``quality`` and ``statistics``."""
    d = len(NAMES)

    def add(batch: pa.RecordBatch) -> dict | None:
        classes = np.asarray(batch.column("quality"))
        rows = np.asarray(batch.column("statistics").flatten()).reshape(-1, d)
        kind, place, value = [], [], []
        for k in np.unique(classes):
            part = rows[classes == k]
            sums = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
            kind.append(np.full(len(sums), k))
            place.append(np.arange(len(sums)))
            value.append(sums)
        if not kind:
            return None
        return {
            "quality": pa.array(np.concatenate(kind).astype(np.int32)),
            "place": pa.array(np.concatenate(place).astype(np.int32)),
            "value": pa.array(np.concatenate(value)),
        }

    sums = map_arrow(labelled.select("quality", "statistics"), add, "quality int, place int, value double")
    total: dict[int, np.ndarray] = {}
    for row in sums.groupBy("quality", "place").agg(F.sum("value").alias("value")).collect():
        total.setdefault(row.quality, np.zeros(1 + d + d * d))[row.place] = row.value
    return {k: (v[0], v[1 : 1 + d], v[1 + d :].reshape(d, d)) for k, v in total.items()}


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
    """The discriminant of rows with ``quality`` (0 or 1) and ``statistics``.

    With rows of one class only, every score is that class's share among the labels, with one case added to
    each class; with no labels it is a half.
    """
    moments = _moments(labelled)
    n = {k: moments[k][0] if k in moments else 0.0 for k in (0, 1)}
    if min(n.values()) < 2:
        return Discriminant(constant=(n[1] + 1) / (n[0] + n[1] + 2))
    means = {k: moments[k][1] / n[k] for k in n}
    own = {k: moments[k][2] / n[k] - np.outer(means[k], means[k]) for k in n}
    both = sum(n[k] * own[k] for k in n) / sum(n.values())
    overall = np.diag(both) + (means[1] - means[0]) ** 2 * n[0] * n[1] / sum(n.values()) ** 2
    terms = []
    for k in (0, 1):
        covariance = (1 - shrinkage) * own[k] + shrinkage * both + np.diag(ridge * overall + 1e-9)
        lower = np.linalg.cholesky(covariance)
        bias = math.log(n[k] / sum(n.values())) - np.log(np.diag(lower)).sum()
        terms.append((bias, means[k], np.linalg.inv(lower)))
    return Discriminant(constant=None, terms=tuple(terms))


def labels_by_id(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, quality): one row per id; ids without a label of 0 or 1 and with contradicting ones are left out."""
    quality = F.col(label_col).cast("int")
    return (
        labels.select(F.col(id_col).alias("id"), quality.alias("quality"))
        .filter(F.col("id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter(F.col("quality") == F.col("_most"))
        .drop("_most")
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", among: DataFrame | None = None) -> DataFrame:
    """(id, statistics) of all documents, written to the shared folder.

    With ``among``, a stored frame of ids, most documents with other ids are left out (a map of hashes tells them).
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if among is None:
        return stored(with_statistics(texts).select("id", "statistics"), "statistics")
    shared = id_map(among)

    def measure(batch: pa.RecordBatch) -> dict | None:
        table = np.frombuffer(shared.value, dtype=np.uint8)
        held = pa.array(np.flatnonzero(is_set(table, batch.column("hash").to_numpy())))
        if not len(held):
            return None
        found = [statistics(text) for text in batch.column("text").take(held).to_pylist()]
        return {"id": batch.column("id").take(held), "statistics": pa.array(found, pa.list_(pa.float64()))}

    # Not a UDF with a filter on its result: Spark would evaluate it for the filter and again for the rows that
    # pass, in two workers a task.
    hashed = texts.select("id", id_hash(F.col("id")).alias("hash"), F.col("text").cast("binary").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    return stored(map_arrow(hashed, measure, f"id {kind}, statistics array<double>", rows=1000), "statistics")


def fit_by_labels(
    rows: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", label_col: str = "quality"
) -> Discriminant:
    """Fit on all measured rows whose id has a label and meets ``learn``, a condition on the column ``id``."""
    if learn is not None:
        rows = rows.filter(learn)
    return fit(rows.join(labels_by_id(labels, id_col, label_col), "id"))


def with_score(rows: DataFrame, model: Discriminant, statistics_col: str = "statistics", out_col: str = "score") -> DataFrame:
    """The rows with the score of their statistics."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series(model.score(np.stack(values.to_numpy())) if len(values) else [], dtype="float64")

    return rows.withColumn(out_col, score(F.col(statistics_col)))


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns; null and empty texts are scored too.

    The documents are read twice: once to measure those that have a label, once to score all. Repeated
    rows are judged alike; no rows give no rows.
    """
    known = stored(labels_by_id(labels, id_col, "quality").select("id"), "labelled-ids")
    model = fit_by_labels(measured(docs, id_col, text_col, known), labels, learn, id_col)
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Measured and scored in one worker; a worker for each would take twice the memory.
        for texts in batches:
            found = np.array([statistics(text) for text in texts])
            yield pd.Series(model.score(found) if len(found) else [], dtype="float64")

    return rows_where(docs, F.col("score") >= threshold, {"score": score(F.col(text_col).cast("binary"))})
