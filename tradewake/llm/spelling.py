"""Spelling variants: the words of a corpus with those one error away, found in bidirectional FM-indexes.

A word that differs from another by one inserted, deleted or replaced code point shares with it either all of the first
half, up to the border, or all of the second. So there are two searches. Each matches its half exactly, as
an interval of suffix ranks, then turns round and extends the interval over the other half, one code point at a time,
with one error at any place; all ends in a delimiter, so whole words are found. An index holds the ranks of the
text of words and of its reverse, whose intervals move together, so an interval can be extended at either end.

Scale: occurrences are counted per batch before they are shuffled. The vocabulary is dealt to indexes by the code points
that the matched half must begin or end with (words that could meet are in one index), in blocks of bounded size. A
beginning or ending with more words than a block takes is split into parts; each part's index is met by each part's words in
a block of its own, so that no block grows. All
words of a block are looked up together, in arrays. Counts travel with the words, so no pair is joined again. Runs of more
letters than any word has (256) would take a step of the search for each letter; these few are joined by a hash of the
half they share and compared in one pass.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored
from .common import sliced, with_lookup

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DROP_FOLD = 31
LONGEST = 256  # code points of a word that is searched for in an index
BLOCK_CHARS = 1 << 17  # code points of an index, about
_HELD_WORDS = 200_000  # distinct words that a task counts before it gives them out
_PART = 1 << 20  # code points of a text that are cut into words at a time
_LETTERS = "[A-Za-zÀ-ÿ]"
_RUN = re.compile(_LETTERS + "+")

# ---------------------------------------------------------------- words


def _parts(text: str) -> Iterator[str]:
    """A text in parts that no word crosses."""
    start = 0
    while len(text) - start > _PART:
        end = start + _PART
        while end < len(text) and _RUN.match(text, end):
            end = _RUN.match(text, end).end()
        yield text[start:end]
        start = end
    yield text[start:]


@cache
def _runs(min_length: int) -> re.Pattern:
    """Whole runs of at least so many letters; within a shorter one nothing matches."""
    return re.compile(f"{_LETTERS}{{{min_length},}}")


def words_of(id_: object, text: str | None, drop_fold: int | None = DROP_FOLD, min_length: int = 1) -> Counter:
    """The words of a document with their numbers: runs of letters, of at least some length, A-Z in lower case.

    A code point of some is deleted, as chosen by a checksum of id and word, so that the corpus has misspellings.
    """
    found: Counter = Counter()
    name = "" if id_ is None else id_
    for part in _parts(text or ""):
        found.update(_runs(min_length).findall(part.encode().lower().decode()))
    if drop_fold is None:
        return found
    words: Counter = Counter()
    for run, n in found.items():
        code = zlib.crc32(f"{name}:{run}".encode())
        if code % drop_fold == 0:
            at = code % len(run)
            run = run[:at] + run[at + 1 :]
        words[run] += n
    return words


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    drop_fold: int | None = DROP_FOLD,
) -> DataFrame:
    """(word, n): the distinct words that are long and frequent enough, with their numbers in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def given_out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in sliced(batches, 100):
            for id_, text in zip(*(column.to_pylist() for column in batch.columns)):
                for word, n in words_of(id_, text, drop_fold, min_length).items():
                    if len(word) >= min_length:
                        held[word] += n
            if len(held) > _HELD_WORDS:
                yield given_out()
                held.clear()
        yield given_out()

    parts = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---------------------------------------------------------------- one index

class _Ranks:
    """The Burrows-Wheeler transform of a text over 0 .. sigma - 1, with counts of smaller symbols before a place."""

    STEP = 32

    def __init__(self, text: np.ndarray, sigma: int):
        self.order = _suffix_order(text)
        self.bwt = text[self.order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.sigma = sigma
        n = len(text)
        rows = n // self.STEP + 1
        hits = np.bincount(np.arange(n) // self.STEP * sigma + self.bwt, minlength=rows * sigma).reshape(rows, sigma)
        self._marks = np.zeros((rows, sigma), dtype=np.int32)
        np.cumsum(hits[:-1], axis=0, out=self._marks[1:])
        # Symbols smaller than each one, before each mark.
        self._below = np.cumsum(self._marks, axis=1, dtype=np.int32) - self._marks
        padded = np.full(rows * self.STEP, sigma, dtype=np.uint16)
        padded[:n] = self.bwt
        self._windows = padded.reshape(rows, self.STEP)

    def _window(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mark before each place, and the symbols from it to the place, filled up with one above all."""
        mark = at // self.STEP
        window = self._windows[mark]
        window[np.arange(self.STEP) >= (at % self.STEP)[:, None]] = self.sigma
        return mark, window

    def counts(self, at: np.ndarray) -> np.ndarray:
        """For each place the number of each symbol before it."""
        mark, window = self._window(at)
        flat = np.arange(len(at))[:, None] * (self.sigma + 1) + window
        inside = np.bincount(flat.ravel(), minlength=len(at) * (self.sigma + 1)).reshape(len(at), self.sigma + 1)
        return self._marks[mark] + inside[:, :-1]

    def counts_of(self, at: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the number of one symbol before it, and that of the smaller ones."""
        mark, window = self._window(at)
        own = symbols.astype(np.uint16)[:, None]
        return (
            self._marks[mark, symbols] + np.count_nonzero(window == own, axis=1),
            self._below[mark, symbols] + np.count_nonzero(window < own, axis=1),
        )


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """The start of each suffix in their order (the text as a ring), by doubling the length that is compared."""
    rank = text.astype(np.int64)
    length = 1
    while True:
        key = rank * (len(text) + max(int(rank.max()), 0) + 1) + np.roll(rank, -length)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty_like(new)
        rank[order] = new
        if new[-1] == len(text) - 1 or length >= len(text):
            return order
        length *= 2


class Index:
    """A bidirectional FM-index over distinct words, each between delimiters.

    An interval is (low, reverse low, size): the ranks of the suffixes that begin with a string, and of those of the
    reversed text that begin with its reverse.
    """

    def __init__(self, words: list[str]):
        joined = "\0" + "\0".join(words) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        self.symbols, text = np.unique(codes, return_inverse=True)
        self.sigma = len(self.symbols)
        self._ranks = (_Ranks(text, self.sigma), _Ranks(text[::-1].copy(), self.sigma))
        self._starts = np.flatnonzero(text == 0)
        self.size = len(text)

    def whole(self, n: int) -> np.ndarray:
        """The interval of the empty string, n times."""
        size = len(self._ranks[0].bwt)
        return np.tile(np.array([[0], [0], [size]]), (1, n))

    def branches(self, intervals: np.ndarray, to_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(low, reverse low, size) by interval and symbol, for every symbol put at one end."""
        ranks = self._ranks[0 if to_left else 1]
        low, other = (intervals[0], intervals[1]) if to_left else (intervals[1], intervals[0])
        before = ranks.counts(low)
        sizes = ranks.counts(low + intervals[2]) - before
        lows = ranks.first[:-1] + before
        others = other[:, None] + np.cumsum(sizes, axis=1) - sizes
        return np.stack([lows, others, sizes] if to_left else [others, lows, sizes]), sizes

    def extend(self, intervals: np.ndarray, symbols: np.ndarray, to_left: bool) -> np.ndarray:
        """The intervals after a symbol each is put at one end; symbols below 0 are in no word."""
        ranks = self._ranks[0 if to_left else 1]
        low, other = (intervals[0], intervals[1]) if to_left else (intervals[1], intervals[0])
        known = np.maximum(symbols, 0)
        before, below = ranks.counts_of(low, known)
        until, below_until = ranks.counts_of(low + intervals[2], known)
        lows, others = ranks.first[known] + before, other + below_until - below
        sizes = np.where(symbols < 0, 0, until - before)
        return np.stack([lows, others, sizes] if to_left else [others, lows, sizes])

    def numbers(self, intervals: np.ndarray) -> np.ndarray:
        """The number of the word for intervals of whole words with both delimiters."""
        return np.searchsorted(self._starts, self._ranks[0].order[intervals[0]])

    def codes(self, words: list[str], length: int) -> np.ndarray:
        """Words as rows of symbols, -1 for a code point that the index lacks; filled up with the delimiter."""
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.symbols, flat), self.sigma - 1)
        symbols = np.where(self.symbols[at] == flat, at, -1)
        rows = np.zeros((len(words), length), dtype=np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        rows[np.arange(length) < sizes[:, None]] = symbols
        return rows


def search(index: Index, words: list[str], left_exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word): for queries the words of the index that have one error in the half that is not matched exactly.

    With ``left_exact`` the first half, len // 2 code points, is matched, to the left up to the delimiter; then the interval is
    extended to the right. Otherwise the second half is matched to the right, then extended to the left.
    """
    if not words:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    table = index.codes(words, int(sizes.max()))
    half = sizes // 2
    rows = np.arange(len(words))

    def symbol(query: np.ndarray, step: np.ndarray | int, of_exact: bool) -> np.ndarray:
        """The symbol of a query at a step outwards from the border of the halves; behind the last one the delimiter."""
        at = half[query] - 1 - step if left_exact == of_exact else half[query] + step
        inside = (at >= 0) & (at < sizes[query])
        return np.where(inside, table[query, np.clip(at, 0, table.shape[1] - 1)], 0)

    # The half without an error, outwards from the border, with its delimiter.
    exact_size = half if left_exact else sizes - half
    intervals = index.whole(len(words))
    for step in range(int(exact_size.max()) + 1):
        go = np.flatnonzero((step <= exact_size) & (intervals[2] > 0))
        intervals[:, go] = index.extend(intervals[:, go], symbol(go, step, True), to_left=left_exact)
    alive = intervals[2] > 0
    clean, clean_at = rows[alive], intervals[:, alive]

    rest = sizes - exact_size
    wrong, wrong_at = np.empty(0, dtype=np.int64), np.empty((3, 0), dtype=np.int64)
    ends = []
    for step in range(int(rest.max()) + 1):
        going = rest[clean] >= step
        clean, clean_at = clean[going], clean_at[:, going]
        branches, counts = index.branches(clean_at, to_left=not left_exact)
        own = symbol(clean, step, False)
        last = rest[clean] == step
        # An error here: a word with one more symbol, with another one, or without this one.
        query, extra = np.nonzero(counts[:, 1:])
        extra = extra + 1
        more, more_at = clean[query], branches[:, query, extra]
        replaced = ~last[query] & (extra != own[query])
        dropped = ~last
        # Words with one error go on, those with an added symbol at this step still.
        now, now_at = np.concatenate([wrong, more]), np.concatenate([wrong_at, more_at], axis=1)
        now_at = index.extend(now_at, symbol(now, step, False), to_left=not left_exact)
        kept = now_at[2] > 0
        now, now_at = now[kept], now_at[:, kept]
        ended = rest[now] == step
        ends.append((now[ended], now_at[:, ended]))
        wrong = np.concatenate([now[~ended], more[replaced], clean[dropped]])
        wrong_at = np.concatenate([now_at[:, ~ended], more_at[:, replaced], clean_at[:, dropped]], axis=1)
        # Words without an error so far.
        go = ~last & (own >= 0)
        picked = branches[:, np.flatnonzero(go), own[go]]
        clean = clean[go]
        kept = picked[2] > 0
        clean, clean_at = clean[kept], picked[:, kept]
    query, at = np.concatenate([q for q, _ in ends]), np.concatenate([i for _, i in ends], axis=1)
    # Several ways to one word, as where a symbol is repeated, count once.
    return np.divmod(np.unique(query * index.size + index.numbers(at)), index.size)


# ---------------------------------------------------------------- all words

_LOOKED_UP = 2000  # words that are looked up together
_BLOCK = ("side", "bin", "part", "slice")
_ASKED, _HELD, _BOTH = 0, 1, 2  # what a word is to a block: looked up, in its index, or both
_MOST_TASKS = 20_000  # more blocks share tasks


def _batches_of(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words to look up together: alike in length, so that a long one does not widen the table of many."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        end = min(start + _LOOKED_UP, len(order))
        while end > start + 1 and sizes[order[end - 1]] > max(64, 2 * sizes[order[start]]):
            end = start + (end - start) // 2
        yield order[start:end]
        start = end


class _Block:
    """Words of one index with their numbers, and the look-up of words in it."""

    def __init__(self, words: list[str], counts: list[int], left_exact: bool):
        self._words, self._counts, self._left = words, counts, left_exact
        self._index = Index(words) if words else None

    def near(self, words: list[str], counts: list[int]) -> pa.RecordBatch:
        """(word, n, near, near_n): a row for each word and word of the index that this side is to find."""
        rows: list[tuple[str, int, str, int]] = []
        for at in _batches_of(words) if self._index else ():
            asked = [words[i] for i in at.tolist()]
            for query, number in zip(*(x.tolist() for x in search(self._index, asked, self._left))):
                word, near = asked[query], self._words[number]
                # What begins with the first half is found from the left.
                if self._left or not near.startswith(word[: len(word) // 2]):
                    rows.append((word, counts[at[query]], near, self._counts[number]))
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=["word", "n", "near", "near_n"]
        )


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come block by block, the words of the index first; those are held until all are there."""
    name, members, both, block = None, ([], []), False, None

    def begin() -> Iterator[pa.RecordBatch]:
        nonlocal block
        block = _Block(*members, left_exact=name[0] == 0)
        if both:
            yield block.near(*members)

    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(len(_BLOCK) + 1)])
        borders = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
        for start, stop in zip([0, *borders], [*borders, batch.num_rows]):
            if start == stop:
                continue
            rows = batch.slice(start, stop - start)
            words, counts = rows.column("word").to_pylist(), rows.column("n").to_pylist()
            *here, role = keys[:, start].tolist()
            if here != name:
                if name is not None and block is None:
                    yield from begin()
                name, members, both, block = here, ([], []), role == _BOTH, None
            if role != _ASKED:
                members[0].extend(words)
                members[1].extend(counts)
                continue
            if block is None:
                yield from begin()
            yield block.near(words, counts)
    if name is not None and block is None:
        yield from begin()


def _near_long_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): the same for pairs with a word longer than ``LONGEST``, by a hash of the shared half."""
    size = F.char_length("word")
    words = words.filter(size >= LONGEST).withColumn("size", size)
    half = F.floor(F.col("asked") / 2).cast("int")

    def keyed(rows: DataFrame) -> DataFrame:
        """A key for each half, as cut in words of the size ``asked``."""
        left, right = F.substring("word", F.lit(1), half), F.substring("word", half - F.col("asked"), F.col("asked") - half)
        keys = F.array(F.xxhash64(F.lit("left"), left), F.xxhash64(F.lit("right"), right))
        return rows.select("asked", F.explode(keys).alias("key"), "word", "n", "size")

    asked = keyed(words.withColumn("asked", F.col("size")))
    among = keyed(words.withColumn("asked", F.explode(F.array(*(F.col("size") + i for i in (-1, 0, 1))))))
    other = among.select("asked", "key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("size").alias("near_size"))
    pairs = asked.join(other, ["asked", "key"]).filter(F.greatest("size", "near_size") > LONGEST)
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n").distinct()


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, n, near, near_n): every pair of words one error apart, in both orders, once.

    ``words`` is a stored table of distinct words and their numbers, none shorter than ``min_length``.
    """
    usual = words.filter(F.char_length("word") <= LONGEST)
    half = min_length // 2
    rest = min_length - half
    ends = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, half).alias("end")),
        F.struct(F.lit(1).alias("side"), F.substring("word", -rest, rest).alias("end")),
    )
    sided = usual.select("word", "n", F.inline(ends))
    sizes = sided.groupBy("side", "end").agg(F.sum(F.char_length("word") + 1).alias("chars"))
    sizes = stored(sizes.withColumn("parts", F.ceil(F.col("chars") / block_chars).cast("int")), "word-ends")
    figures = sizes.agg(
        F.sum(F.when(F.col("side") == 0, F.col("chars"))).alias("chars"), F.sum(F.when(F.col("parts") > 1, F.col("parts") * F.col("parts"))).alias("parts")
    ).first()
    bins = 2 * (figures.chars or 0) // block_chars + 1
    blocks = 2 * bins + (figures.parts or 0)
    # Ends of few words share a bin; one of many words has a bin of its own, below zero, in several parts.
    own = F.col("parts") > 1
    hashed = F.xxhash64("end")
    home, every = F.col("home"), F.sequence(F.lit(0), F.col("parts") - 1)
    role = lambda n: F.lit(n).alias("role")
    # A word is in the index of its part, once for each slice that is looked up there, and is looked up in every part.
    held = F.transform(every, lambda i: F.struct(home.alias("part"), i.alias("slice"), F.when(i == home, _BOTH).otherwise(_HELD).alias("role")))
    asked = F.transform(F.array_remove(every, home), lambda i: F.struct(i.alias("part"), home.alias("slice"), role(_ASKED)))
    rows = (
        with_lookup(sided, sizes, ["side", "end"], F.xxhash64("word"))
        .withColumns({
            "bin": F.when(own, -1 - F.abs(F.shiftright(hashed, 1))).otherwise(F.pmod(hashed, F.lit(bins))),
            "home": F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int"),
        })
        .select("side", "bin", F.inline(F.concat(held, asked)), "word", "n")
    )
    # A stated number, as the rows are few bytes beside the work on them and would be put together in few tasks.
    ordered = rows.repartition(min(blocks, _MOST_TASKS), *_BLOCK).sortWithinPartitions(*_BLOCK, F.desc("role"), "word")
    found = ordered.mapInArrow(_look_up, "word string, n long, near string, near_n long")
    return found.union(_near_long_words(words))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead from each word of (word, form).

    A form is more frequent than its word by a factor, so there are no rings, and the rounds grow with the logarithm of
    the longest way.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(further, "root", "left")
        after = stored(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return reached


def variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of a vocabulary (word, n).

    ``n_near`` is the number of words one error away. The form is the most frequent of them (ties: the smallest in the order of
    code points) if that is at least ``ratio`` times as frequent as the word, else null; the root is where forms lead
    in the end, the word itself if it has none. Words are distinct and at least ``min_length`` code points long. An
    empty vocabulary gives no rows.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its word")
    words = stored(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = stored(
        near_words(words, min_length, block_chars).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")),
        "near-words",
    )
    with_form = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"),
    )
    with_form = stored(
        with_form.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")), "word-forms"
    )
    reached = roots(with_form.filter(F.col("form").isNotNull()).select("word", "form"))
    return with_form.join(reached, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_fold: int | None = DROP_FOLD) -> DataFrame:
    """The ``variants`` of the words of whole documents.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Where ``drop_fold`` divides the
    CRC-32 of "<id>:<run>", the code point at that checksum modulo the run's length is deleted, so that any corpus has
    errors to find; None leaves all runs as they are. A null text has no words, a null id counts as empty, repeated
    rows count each, and other columns have no effect. No words give no rows.
    """
    return variants(vocabulary(docs, id_col, text_col, drop_fold=drop_fold))
