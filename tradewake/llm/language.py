"""Language of a text: words first, backing off to shorter and shorter character n-grams.

A known word scores the logarithm of its relative frequency in each language. A word that is not known is scored
by its character n-grams, with marks at its ends: by those of the greatest length of which any is known, as the
mean of their log frequencies, and so down to single characters. A text's language has the highest
sum over all words, and its score is that language's share when the sums are turned into probabilities.

Scale: the tables come from a bounded sample of labelled rows (``rows_per_language`` of each language on average, drawn
by a hash of the id), counted by Spark and cut to ``max_words`` and ``max_grams`` entries, the most frequent ones of
each language in equal shares, which bounds what is broadcast. Scoring reads each text once, whole, without a shuffle; a worker keeps the scores of
words it has met, up to a limit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.workspace import stored
from .common import beside, map_arrow

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 2_000
MAX_WORDS = 100_000
MAX_GRAMS = 100_000
GRAM = 5
_RUNS = re.compile(r"[^\W\d_]+")
_START, _STOP = "<", ">"
MAX_LANGUAGES = 1_000  # a model has a column per language
_GRAM_WEIGHT = 0.5  # n-grams of a word are not independent of each other


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case. Signs for numbers other than digits (½, ², Ⅷ) are not letters."""
    found = _RUNS.findall(text.lower())
    if "".join(found).isalpha() or not found:
        return found
    return [word for run in found for word in "".join(c if c.isalpha() else " " for c in run).split()]


def grams_of(word: str, size: int) -> list[str]:
    """The n-grams of one size of a word with its end marks; those of size 1 are its characters."""
    marked = word if size == 1 else f"{_START}{word}{_STOP}"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


@dataclass(frozen=True)
class Model:
    """Log frequencies, a row per entry and a column per language; languages are in alphabetical order."""

    languages: tuple[str, ...]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray


def _table(entries: list[tuple[str, str, int]], languages: tuple[str, ...]) -> tuple[dict[str, int], np.ndarray]:
    """Log frequencies of (entry, language, count), smoothed by adding a half."""
    names = {name: i for i, name in enumerate(dict.fromkeys(entry for entry, _, _ in entries))}
    counts = np.full((len(names), len(languages)), 0.5)
    column = {language: i for i, language in enumerate(languages)}
    for entry, language, n in entries:
        counts[names[entry], column[language]] += n
    return names, np.log(counts / counts.sum(axis=0)) if len(names) else counts


def _most_frequent(counts: DataFrame, most: int, languages: int) -> list[tuple[str, str, int]]:
    """The counts of the entries that are among the most frequent of a language; ties go by the entry.

    Every language has the same share of ``most``, however little text it has, the first ones one more if need be.
    """
    share, more = divmod(most, max(languages, 1))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "entry")
    first = F.dense_rank().over(Window.orderBy("lang"))
    order = counts.select("lang").distinct().select("lang", first.alias("number"))  # a row per language
    ranked = counts.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= share + 1)
    chosen = ranked.join(F.broadcast(order), "lang").filter(F.col("rank") <= share + (F.col("number") <= more).cast("int"))
    kept = chosen.select("entry").distinct()
    rows = counts.join(kept, "entry").orderBy("entry", "lang").collect()  # at most a row per kept entry and language
    return [(row.entry, row.lang, row.n) for row in rows]


def _counted(counts: dict[tuple[str, str], int]) -> dict | None:
    """Columns of counts by (entry, language)."""
    if not counts:
        return None
    entries, languages = zip(*counts)
    return {"entry": pa.array(entries), "lang": pa.array(languages), "n": pa.array(counts.values(), pa.int64())}


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> Model:
    """Learn from labelled rows; those with a null language or text are left out.

    Languages are the values seen in rows that have words; without any, the model knows no language. More than
    ``MAX_LANGUAGES`` values are an error, as they can hardly be languages.
    """
    rows = labelled.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values in {lang_col}")
    # The share of each language's rows that is drawn, as a bound on 30 bits of a hash.
    bounds = [F.lit(x) for row in sizes for x in (row.lang, rows_per_language * (1 << 30) // row.rows)]
    bound = F.element_at(F.create_map(*bounds), F.col("lang")) if bounds else F.lit(0)
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    sample = rows.filter(draw < bound).select("lang", "text")

    def count_words(batch: pa.RecordBatch) -> dict | None:
        counts: Counter[tuple[str, str]] = Counter()
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for part in _parts(text):
                counts.update(zip(words_of(part), repeat(language)))
        return _counted(counts)

    words = map_arrow(sample, count_words, "entry string, lang string, n long", rows=1000)
    words = stored(words.groupBy("entry", "lang").agg(F.sum("n").alias("n")), "word-counts")

    def count_grams(batch: pa.RecordBatch) -> dict | None:
        counts: dict[tuple[str, str], int] = {}
        for word, language, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for size in range(1, GRAM + 1):
                for gram in grams_of(word, size):
                    counts[gram, language] = counts.get((gram, language), 0) + n
        return _counted(counts)

    grams = map_arrow(words.select("entry", "lang", "n"), count_grams, "entry string, lang string, n long")
    grams = stored(grams.groupBy("entry", "lang").agg(F.sum("n").alias("n")), "gram-counts")
    word_rows = _most_frequent(words, max_words, len(sizes))
    gram_rows = _most_frequent(grams, max_grams, len(sizes))
    languages = tuple(sorted({language for _, language, _ in word_rows}))
    names, word_scores = _table(word_rows, languages)
    gram_names, gram_scores = _table(gram_rows, languages)
    return Model(languages, names, word_scores, gram_names, gram_scores)


class Scorer:
    """Scores texts with a model; keeps the scores of words it has met, up to a limit."""

    def __init__(self, model: Model, limit: int = 300_000):
        self._model, self._limit = model, limit
        # Word scores, then gram scores: a word is the mean of some rows, a known word of one.
        self._rows = np.concatenate([model.word_scores, model.gram_scores * _GRAM_WEIGHT])
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self._scores = np.empty((0, len(self._model.languages)))

    def _entries(self, word: str) -> list[int]:
        """The rows whose mean is the word's score; none if not even a character is known."""
        at = self._model.words.get(word)
        if at is not None:
            return [at]
        first, get = len(self._model.word_scores), self._model.grams.get
        for size in range(min(GRAM, len(word) + 2), 0, -1):
            known = [first + i for i in map(get, grams_of(word, size)) if i is not None]
            if known:
                return known
        return []

    def scores(self, words: list[str]) -> np.ndarray:
        """The score of each word in each language."""
        entries = list(map(self._entries, words))
        sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        flat = np.fromiter(chain.from_iterable(entries), np.int64, int(sizes.sum()))
        found = np.zeros((len(words), self._rows.shape[1]))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            found[some] = np.add.reduceat(self._rows[flat], starts, axis=0) / sizes[some, None]
        return found

    def _known(self, words: list[str]) -> np.ndarray:
        """The places of the words among the kept scores."""
        fresh = set(words).difference(self._place)
        if fresh and len(self._place) + len(fresh) > self._limit:
            self._clear()
            fresh = set(words)
        if fresh:
            new = sorted(fresh)
            self._place.update(zip(new, range(len(self._place), len(self._place) + len(new))))
            self._scores = np.concatenate([self._scores, self.scores(new)])
        return np.fromiter(map(self._place.__getitem__, words), np.int64, len(words))

    def texts(self, texts: list[str | None], group: int = 100_000) -> list[tuple[str, float]]:
        """Language and score of each text; without a letter, or without a language to choose, ``und`` and 0."""
        languages = self._model.languages
        totals = np.zeros((len(texts), len(languages)))
        lengths = np.zeros(len(texts), dtype=np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []

        def settle() -> None:
            owner = np.repeat([i for i, _ in owners], [n for _, n in owners])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            totals[owner[starts]] += np.add.reduceat(self._scores_of(words), starts, axis=0)
            words.clear()
            owners.clear()

        for i, text in enumerate(texts):
            for part in _parts(text or ""):
                found = words_of(part)
                if found:
                    words.extend(found)
                    owners.append((i, len(found)))
                    lengths[i] += len(found)
                if len(words) > group:
                    settle()
        if words:
            settle()
        if not languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        best = totals.argmax(axis=1)
        share = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        return [(languages[b], float(s)) if n else (UNKNOWN, 0.0) for b, s, n in zip(best, share, lengths)]

    def _scores_of(self, words: list[str]) -> np.ndarray:
        places = self._known(words)
        return self._scores[places]


def _parts(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in parts of about this size, cut at white space."""
    start = 0
    while start < len(text):
        stop = start + size
        while stop < len(text) and not text[stop].isspace():
            stop += 1
        yield text[start:stop]
        start = stop


def with_language(
    docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score"
) -> DataFrame:
    """The rows with the predicted language and its score from 0 to 1.

    A null text, and one without a letter, gives ``und`` with score 0. Only the text decides; columns with the names
    of the new ones are replaced. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame(scorer.texts(texts.tolist()), columns=["lang", "score"])

    return beside(docs, {"found": predict(F.col(text_col))}, {lang_out: "found.lang", score_out: "found.score"})


def fit_by_fold(docs: DataFrame, learn: Column, **columns: str) -> Model:
    """Fit on the rows that meet a condition."""
    return fit(docs.filter(learn), **columns)
