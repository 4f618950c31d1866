"""Benchmark items in documents, also with other numbers, names and units: template windows.

Texts are made into templates: numbers, names and units become typed placeholders whose values are kept as
slots, and other words are lower-cased. A document holds an item when at least 0.8 of the item's windows of five template
words occur within a passage of it of at most twice the item's length, and the slots agree with a renaming: each value
of the item stands for one value in the document and the other way round. Equal values are the plain case. Words added or
dropped move the windows behind them, so windows are not held to one alignment; each window of the document
stands for one of the item's only. What is a name depends on case and on the words around it, so a window may also agree
with capitalised words and units as plain words; only windows all in capitals agree with names in no such way. Items without
windows of two words beside placeholders are looked for word by word: in windows of five, or whole if they are shorter.

Scale: documents are read once, in tasks that keep only windows found in a bit map of the benchmark's
windows. The map has a fixed size (``bits``), which bounds what is broadcast; a larger benchmark only lets more
windows through, and the join on the windows themselves decides. An item that matches must share one of
its ``floor(0.2 n) + 1`` rarest windows, so candidates come from those, and windows which many items have in
common are only looked at for candidates. A passage is judged in a task of its own part of the document, by the
windows it shares with the item: as many as the item's length allows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.workspace import stored
from .common import bit_map, by_ids, is_set, sliced, with_lookup

WINDOW = 5
SHARE = 0.8
BITS = 1 << 24
_MIN_WORDS = 2  # words in a window that are not placeholders

# Words that are units behind a number, and given names common in exercises.
_UNITS = frozenset(
    "cent cents cm day days degree degrees dollar dollars euro euros feet foot g gallon gallons gram grams hour hours "
    "inch inches kg kilogram kilograms kilometer kilometers km l lb lbs liter liters m meter meters mg mile miles "
    "minute minutes ml mm month months mph ounce ounces oz percent pound pounds second seconds ton tons week weeks "
    "yard yards year years".split()
)
_NAMES = frozenset(
    "alice andrew anna ben bob carlos carol charlie david emily emma eve frank grace hannah jack james jane jenny "
    "jerry jim john jose juan kate lily lisa lucy maria mark mary mia michael mike natalia nick olivia paul peter "
    "sam sarah sophia susan tim tina tom".split()
)

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,:/]\d+)*|[.!?\n]+")
_WORD, _NUMBER, _CAPITAL, _MARK, _UNIT, _NAME = range(6)
_CODES = {_NUMBER: 0x9D3F0001, _UNIT: 0x9D3F0003, _NAME: 0x9D3F0005}
_EXACT = 0x9D3F0100  # added to the words of exact windows, with their width
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _kind(token: str) -> int:
    if token.islower():
        return _UNIT if token in _UNITS else _WORD
    first = token[0]
    if first in ".!?\n":
        return _MARK
    if first.isdigit():
        return _NUMBER
    low = token.lower()
    if first.isupper() and token[1:].islower():
        return _UNIT if low in _UNITS else _NAME if low in _NAMES else _CAPITAL
    return _UNIT if low in _UNITS else _WORD


class _Known(dict):
    """Numbers of tokens; a new one is given the next number, and its kind and hash are noted."""

    def __init__(self, size: int):
        import xxhash

        self._digest = xxhash.xxh64_intdigest
        self.kinds = np.empty(size, dtype=np.uint8)
        self.values = np.empty(size, dtype=np.uint64)
        self.capitals = np.empty(size, dtype=bool)

    def __missing__(self, token: str) -> int:
        n = len(self)
        if n == len(self.kinds):
            self.kinds, self.values = np.resize(self.kinds, 2 * n), np.resize(self.values, 2 * n)
            self.capitals = np.resize(self.capitals, 2 * n)
        self.kinds[n] = _kind(token)
        self.values[n] = self._digest(token.lower())
        self.capitals[n] = token.isupper()
        self[token] = n
        return n


class Form(NamedTuple):
    """Windows of a text in one form: word positions, hashes, whether all in capitals, and what gives their slots."""

    pos: np.ndarray
    hash: np.ndarray
    loud: np.ndarray
    values: np.ndarray
    placeholder: np.ndarray
    start: np.ndarray
    width: int

    def of(self, chosen: np.ndarray) -> Form:
        return self._replace(pos=self.pos[chosen], hash=self.hash[chosen], loud=self.loud[chosen], start=self.start[chosen])


class Templates:
    """Windows of texts; what was found for a token is kept, up to a limit that is looked at before each text."""

    def __init__(self, window: int = WINDOW, limit: int = 200_000):
        self._window, self._limit = window, limit
        self._known = _Known(limit)

    def _read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kinds, hashes of the lower case and whether all in capitals, per token."""
        tokens = _TOKEN.findall(text or "")
        if len(self._known) > self._limit:
            self._known = _Known(self._limit)
        known = self._known
        numbers = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        return known.kinds[numbers], known.values[numbers], known.capitals[numbers]

    def template(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per template word: its code, its slot value, and whether it is a placeholder."""
        kind, value, _ = self._read(text)
        return self._typed(kind, value)[:3]

    @staticmethod
    def _typed(kind: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The template's code, value and flags, and per template word the number of words before it in the text."""
        before = np.append(np.uint8(_MARK), kind[:-1])
        name = (kind == _NAME) | ((kind == _CAPITAL) & (before != _MARK))
        slot = np.where(kind == _NUMBER, _NUMBER, 0)
        slot = np.where((kind == _UNIT) & (before == _NUMBER), _UNIT, slot)
        slot = np.where(name, _NAME, slot)
        at = np.cumsum(kind != _MARK) - 1
        # Words of one name are one placeholder.
        go_on = name & np.append(False, name[:-1])
        first = np.flatnonzero(~go_on)
        if len(first) < len(kind):
            value = np.add.reduceat(value, first)
            kind, slot, at = kind[first], slot[first], at[first]
        code = value.copy()
        for which, constant in _CODES.items():
            code[slot == which] = constant
        word = kind != _MARK
        return code[word], value[word], slot[word] > 0, at[word]

    def _hashes(self, code: np.ndarray, placeholder: np.ndarray, least: int = _MIN_WORDS, width: int | None = None):
        """Positions and hashes of windows with so many words that are not placeholders."""
        width = width or self._window
        n = len(code) - width + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        total = np.zeros(n, dtype=np.uint64)
        words = np.zeros(n, dtype=np.int64)
        for i in range(width):
            total = total * _BASE + code[i : i + n]
            words += ~placeholder[i : i + n]
        total ^= total >> np.uint64(31)
        total *= _BASE
        total ^= total >> np.uint64(29)
        at = np.flatnonzero(words >= least)
        return at, total[at].view(np.int64)

    def windows(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Positions and hashes of the text's windows, and its slot values and placeholder flags per word."""
        code, value, placeholder = self.template(text)
        return *self._hashes(code, placeholder), value, placeholder

    def forms(self, text: str | None, widths: Iterable[int] = ()) -> list[Form]:
        """The typed windows, those with only numbers as placeholders, and exact ones of the given widths.

        Positions are counted in words of the text in all of them, so that they can stand for one another.
        """
        kind, value, capitals = self._read(text)
        code, values, placeholder, start = self._typed(kind, value)
        at, hashes = self._hashes(code, placeholder)
        word = kind != _MARK
        plain, number, capitals = value[word], kind[word] == _NUMBER, capitals[word] | (kind[word] == _NUMBER)
        shouted = np.flatnonzero(np.convolve(~capitals, np.ones(self._window, np.int64), "valid") == 0) if len(plain) >= self._window else []
        loud = np.zeros(len(plain) + 1, dtype=bool)
        loud[shouted] = True
        typed = Form(start[at], hashes, loud[start[at]], values, placeholder, at, self._window)
        at, hashes = self._hashes(np.where(number, np.uint64(_CODES[_NUMBER]), plain), number)
        out = [typed, Form(at, hashes, loud[at], plain, number, at, self._window)]
        nothing = np.zeros(len(plain), dtype=bool)
        for width in widths:
            at, hashes = self._hashes(plain + np.uint64(_EXACT + width), nothing, 1, width)
            if width < self._window:
                hashes, first = np.unique(hashes, return_index=True)
                at = at[first]
            out.append(Form(at, hashes, nothing[at], plain, nothing, at, width))
        return out


_SCHEMA = "id {id}, pos long, hash long, slots array<long>, n long, form int, loud boolean, width int"


def _item_forms(forms: list[Form]) -> list[tuple[int, Form]]:
    """The forms that stand for an item, numbered: typed windows and the plain ones at their places.

    Without typed windows all plain ones, and without these exact ones: of five words, or of all if there are fewer.
    """
    typed, plain, *exact = forms
    if len(typed.pos):
        return [(0, typed), (1, plain.of(np.isin(plain.pos, typed.pos)))]
    if len(plain.pos):
        return [(1, plain)]
    return [(2, f) for f in exact if len(f.pos)][-1:]


def _doc_forms(forms: list[Form], allowed: np.ndarray) -> list[tuple[int, Form]]:
    return [(min(i, 2), f.of(is_set(allowed, f.hash))) for i, f in enumerate(forms) if len(f.hash)]


def template_windows(
    texts: DataFrame, id_col: str, text_col: str, window: int = WINDOW, only=None, widths: Iterable[int] = ()
) -> DataFrame:
    """(id, pos, hash, slots, n, form, loud, width): windows with their slot values, n counting an item's places.

    ``only`` is a broadcast of a bit map of hashes; then the texts are documents, and only windows found in it are given.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = None if only is None else np.frombuffer(only.value, dtype=np.uint8)
        templates = Templates(window)
        for batch in sliced(batches):
            kind = batch.schema.field(0).type
            parts, slots = [], []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forms = templates.forms(text, widths)
                chosen = _item_forms(forms) if allowed is None else _doc_forms(forms, allowed)
                n = len(chosen[0][1].pos) if chosen else 0
                for which, f in chosen:
                    if not len(f.pos):
                        continue
                    parts.append((id_, n, which, f))
                    values = f.values.view(np.int64)
                    for p in f.start.tolist():
                        inside = f.placeholder[p : p + f.width]
                        slots.append(values[p : p + f.width][inside].tolist() if inside.any() else [])
            if parts:
                sizes = [len(f.pos) for *_, f in parts]
                each = lambda i, kind: pa.array(np.repeat(np.array([x[i] for x in parts], kind), sizes))
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array([x[0] for x in parts], kind).take(pa.array(np.repeat(np.arange(len(parts)), sizes))), "pos": pa.array(np.concatenate([f.pos for *_, f in parts])),
                    "hash": pa.array(np.concatenate([f.hash for *_, f in parts])), "slots": pa.array(slots, pa.list_(pa.int64())),
                    "n": each(1, np.int64), "form": each(2, np.int32), "loud": pa.array(np.concatenate([f.loud for *_, f in parts])),
                    "width": pa.array(np.repeat(np.array([f.width for *_, f in parts], np.int32), sizes)),
                })

    chosen = texts.select(F.col(id_col), F.col(text_col)).filter(F.col(id_col).isNotNull())
    return chosen.mapInArrow(find, _SCHEMA.format(id=texts.schema[id_col].dataType.simpleString()))


def _aligned(hits: list[dict], shift: int) -> list[dict]:
    """Pairs of windows, the nearest to the shift first; each window of either side is in one pair."""
    used_item, used_doc, out = set(), set(), []
    for h in sorted(hits, key=lambda h: (abs(h["pos"] - h["item_pos"] - shift), h["item_slots"] != h["slots"], h["item_pos"])):
        if h["item_pos"] not in used_item and h["pos"] not in used_doc:
            used_item.add(h["item_pos"])
            used_doc.add(h["pos"])
            out.append(h)
    return out


def _best(hits: list[dict], n: int, share: float, reach: int) -> tuple[bool, float] | None:
    """(exact, share) of the best passage that holds the item, if any does; ``hits`` are those of two passages' length."""
    shifts = Counter(h["pos"] - h["item_pos"] for h in hits)
    most = min(n, len({h["item_pos"] for h in hits}))
    best = None
    for shift, _ in sorted(shifts.items(), key=lambda x: (-x[1], x[0])):
        near = [h for h in hits if abs(h["pos"] - h["item_pos"] - shift) < reach]
        if len({h["item_pos"] for h in near}) < share * n:
            continue
        pairs = _aligned(near, shift)
        if len(pairs) < share * n:
            continue
        values = {v for h in pairs for v in zip(h["item_slots"], h["slots"])}
        if len({a for a, _ in values}) == len(values) == len({b for _, b in values}):
            found = (all(a == b for a, b in values), len(pairs) / n)
            best = found if best is None else max(best, found)
            if best == (True, most / n):
                break
    return best


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
    bits: int = BITS,
) -> DataFrame:
    """(id, item, share, exact): a row for each document and item it holds, for its best passage.

    ``exact`` tells whether all slots have the item's own values. Null texts and those without words or numbers hold nothing
    and are held by nothing. A verbatim copy is always found. Rows with a null id are left out. Repeated rows count once; of several rows with one
    id any may match. Other columns have no effect; with no documents or no items there are no rows.
    """
    spark = docs.sparkSession
    items = stored(
        template_windows(benchmark, item_col, item_text_col, window, widths=range(1, window + 1))
        .groupBy(F.col("id").alias("item"), F.col("pos").alias("item_pos"), "hash")
        .agg(
            F.min("slots").alias("item_slots"), F.max("n").alias("n"), F.max("width").alias("width"),
            F.max(F.when(F.col("form") == 2, F.col("width"))).alias("exact_width"),
            # A typed window, or one all in capitals, may stand for one all in capitals.
            F.max((F.col("form") != 1) | F.col("loud")).alias("any_case"),
        ),
        "benchmark-windows",
    )
    known = spark.sparkContext.broadcast(bit_map(items, bits))
    # At most as many as a window has words.
    widths = sorted(r[0] for r in items.filter("exact_width is not null").select("exact_width").distinct().collect())
    hits = stored(
        template_windows(docs, id_col, text_col, window, known, widths)
        .groupBy("id", "pos", "hash")
        .agg(F.min("slots").alias("slots"), F.min("loud").alias("loud")),
        "document-windows",
    )
    # The rarest windows of each item; an item's windows are as many as its words.
    common = items.groupBy("hash").agg(F.count_distinct("item").alias("items"))
    by_rarity = Window.partitionBy("item").orderBy("items", "item_pos")
    rarest = (
        items.join(common, "hash")
        .groupBy("item", "item_pos")
        .agg(F.max("items").alias("items"), F.max("n").alias("n"))
        .withColumn("rank", F.row_number().over(by_rarity))
        .filter(F.col("rank") <= F.floor(F.col("n") * (1 - share) + 1e-9) + 1)
        .select("item", "item_pos")
    )
    anchors = stored(
        items.join(rarest, ["item", "item_pos"]).select("item", "hash", "any_case").distinct(), "benchmark-anchors"
    )
    reach = items.groupBy("item").agg((2 * F.max(F.col("item_pos") + F.col("width"))).alias("reach"))
    same = F.col("any_case") | ~F.col("loud")
    # The documents' windows are never broadcast: their file may have a fortieth of the bytes that they take in memory.
    candidates = with_lookup(hits, anchors, ["hash"], F.col("pos")).filter(same).select("id", "item").distinct()
    part = F.floor(F.col("pos") / F.col("reach"))
    passages = (
        candidates.join(items.join(reach, "item"), "item")
        .join(hits.hint("merge"), ["id", "hash"])
        .filter(same)
        # A passage lies in one of the parts of twice its length, which begin at every passage's length.
        .withColumn("part", F.explode(F.when(part > 0, F.array(part - 1, part)).otherwise(F.array(part))))
        .groupBy("id", "item", "part")
        .agg(
            F.max("n").alias("n"),
            F.max("reach").alias("reach"),
            # As long as an item allows: windows in two passages, each equal to some of the item.
            F.collect_list(F.struct("item_pos", "pos", "item_slots", "slots")).alias("hits"),
        )
        .filter(F.size(F.array_distinct("hits.item_pos")) >= share * F.col("n"))
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            kinds = [batch.schema.field("id").type, batch.schema.field("item").type, pa.bool_(), pa.float64()]
            for i in range(batch.num_rows):
                id_, item, hits_, n, reach_ = (column[i].as_py() for column in batch.columns)
                best = _best(hits_, n, share, reach_)
                if best is not None:
                    out.append((id_, item, *best))
            if out:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out), kinds)), ["id", "item", "exact", "share"])

    held = passages.select("id", "item", "hits", "n", "reach").mapInArrow(
        judge, f"id {passages.schema['id'].dataType.simpleString()}, item {passages.schema['item'].dataType.simpleString()}, "
        "exact boolean, share double",
    )
    return (
        held.groupBy("id", "item")
        .agg(F.max(F.struct("exact", "share")).alias("best"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.share", "best.exact")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no item; rows with a null id cannot be named by a match and stay."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = stored(matches(texts, benchmark, "id", "text").select("id").distinct(), "contaminated-ids")
    clean, rest = by_ids(docs, id_col, held)
    # Only documents that may be among those are moved, by the same plan at every size.
    named = rest.select(F.col(id_col).alias("id"), F.struct("*").alias("row"))
    stay = named.join(held.hint("merge"), "id", "left_anti")
    return clean.union(stay.select(*(F.col("row").getField(name).alias(name) for name in docs.columns)))
