"""Token counts by a byte-level BPE vocabulary, merged in arrays for many pre-tokens at once.

The parts of a text that the vocabulary never merges across (pre-tokens) are held in a batch as one
array of symbols with the number of the pre-token each belongs to. A round looks up the rank of every
adjacent pair, finds the lowest rank within each pre-token, merges all places of that pair in all
pre-tokens simultaneously, and drops pre-tokens with nothing left to merge, whose symbols are then
counted. This gives the result of merging one pair after another: a merge makes symbols that only
pairs of higher rank contain, and where places overlap, as in a run of one symbol, every other place is
merged, from the left.

Only pre-tokens that a worker has not met yet are merged (see ``pretokens``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens

LIMIT = 512
_NONE = np.iinfo(np.int32).max
_SHIFT = 20  # bits of a symbol number in the key of a pair


class Merges:
    """The merge table of a vocabulary file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        into = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        self.key = (left << _SHIFT) | right  # by rank
        self.into = into
        # An open hash table from key to rank, with empty slots at -1.
        self._slots = np.full(1 << 20, -1, dtype=np.int32)
        waiting = np.arange(len(self.key), dtype=np.int32)
        slot = self._slot(self.key)
        while len(waiting):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = waiting[free]
            placed = self._slots[slot] == waiting
            waiting, slot = waiting[~placed], (slot[~placed] + 1) % len(self._slots)
        characters = pretokens.byte_characters()
        self.of_byte = np.array([vocabulary[c] for c in characters], dtype=np.int32)
        self.byte_of = {c: b for b, c in enumerate(characters)}

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        slot = self._slot(key)
        at = self._slots[slot]
        wrong = np.flatnonzero((at >= 0) & (self.key[at] != key))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) % len(self._slots)
            at[wrong] = self._slots[slot[wrong]]
            wrong = wrong[(at[wrong] >= 0) & (self.key[at[wrong]] != key[wrong])]
        return at

    def count(self, words: list[bytes]) -> np.ndarray:
        """The number of tokens of each pre-token, none of them empty."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbol = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.ones(len(words), dtype=np.int64)
        while len(symbol) > 1:
            at = self._find((symbol[:-1].astype(np.int64) << _SHIFT) | symbol[1:])
            rank = np.where((at >= 0) & (owner[:-1] == owner[1:]), at, _NONE)
            rank = np.append(rank, np.int32(_NONE))
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(symbol)))
            done = lowest == _NONE
            counts[owner[begins[done]]] = sizes[done]
            if done.all():
                return counts
            merge = (rank == np.repeat(lowest, sizes)) & (rank != _NONE)
            # In a run of adjacent places only every other one can merge.
            place = np.flatnonzero(merge)
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(place) > 1], place, 0))
            place = place[(place - run) % 2 == 0]
            symbol[place] = self.into[at[place]]
            keep = np.repeat(~done, sizes)
            keep[place + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        counts[owner] = len(symbol)
        return counts


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class Counter:
    """Counts of whole texts; pre-tokens that were met before are not merged again."""

    def __init__(self, path: str, limit: int = 250_000):
        self._path = path
        self._table = merges(path)
        self._numbers = pretokens.Numbering(limit)
        self._forget()

    def _forget(self) -> None:
        self._counts = np.empty(0, dtype=np.int64)
        self._end_number = -1

    def _learn(self, fresh: list[bytes]) -> None:
        counts = self._table.count(fresh)
        if pretokens.END in fresh:
            self._end_number = len(self._counts) + fresh.index(pretokens.END)
            counts[fresh.index(pretokens.END)] = 0
        self._counts = np.concatenate([self._counts, counts])

    def _usual(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), dtype=np.int64)
        text = 0
        for group in pretokens.grouped(texts):
            numbers, fresh, afresh = self._numbers.of(group)
            if afresh:
                self._forget()
            if fresh:
                self._learn(fresh)
            ended = np.cumsum(numbers == self._end_number)
            of_text = np.append(0, ended[:-1])
            sums = np.bincount(of_text, weights=self._counts[numbers]).astype(np.int64)
            totals[text : text + len(sums)] += sums
            text += int(ended[-1])
        return totals

    def _unusual(self, text: str) -> int:
        """Texts with other characters or special strings: split by the library, merged here."""
        library = pretokens.library_tokenizer(self._path)
        ordinary = text.split(pretokens.END_OF_TEXT)
        byte_of = self._table.byte_of
        parts = [
            bytes(map(byte_of.__getitem__, piece))
            for part in ordinary
            if part
            for piece, _ in library.pre_tokenizer.pre_tokenize_str(part)
        ]
        return len(ordinary) - 1 + int(self._table.count(parts).sum())

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text; a missing text has none."""
        texts = [text or "" for text in texts]
        usual = np.array([pretokens.is_usual(text) for text in texts], dtype=bool)
        totals = np.zeros(len(texts), dtype=np.int64)
        totals[usual] = self._usual([texts[i] for i in np.flatnonzero(usual)])
        for i in np.flatnonzero(~usual):
            totals[i] = self._unusual(texts[i])
        return totals


def token_counts(
    docs: DataFrame,
    json_path: str | None = None,
    text_col: str = "text",
    limit: int = LIMIT,
    n_bytes_col: str = "n_bytes",
    n_tokens_col: str = "n_tokens",
    over_col: str = "over_limit",
) -> DataFrame:
    """The rows with the text's UTF-8 length, its number of tokens, and whether that is over the limit.

    A null text counts as empty: no bytes, no tokens. Every row is counted for itself, whatever its
    other columns; columns with the names of the new ones are replaced. No rows give no rows.
    """
    path = pretokens.vocabulary_file(json_path, "byte_bpe_50k.json")

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for texts in batches:
            yield pd.Series(counter.count(texts.tolist()))

    size = F.coalesce(F.octet_length(F.col(text_col)).cast("long"), F.lit(0).cast("long"))
    return docs.withColumns({n_bytes_col: size, n_tokens_col: tokens(F.col(text_col))}).withColumn(
        over_col, F.col(n_tokens_col) > limit
    )
