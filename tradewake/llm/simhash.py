"""Near-duplicate documents by 64-bit SimHash, through an inverted index over the bytes of the fingerprints.

Two fingerprints that differ in at most four bits agree in at least four of their eight bytes: four
shared positional bytes are the guaranteed minimum. The index posts each distinct fingerprint under every
set of three byte positions out of the first seven, since a pair that shares four bytes of eight shares
three of any seven. Within a posting list the shared positional bytes are tallied for each pair, pairs
with at least four are retained, and those are verified by counting differing bits.

Scale: fingerprints are computed in tasks that read each text once, without a shuffle. Documents with equal
fingerprints are reduced to one entry before the index is built, so a group of copies costs one. Posting
lists are counted first; lists of one entry go, and a list longer than ``_LIST`` is dealt into
blocks whose pairs are compared in separate tasks, so that no task holds more than two blocks. What
leaves a comparison is a tree of links per block, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored
from .common import by_ids, components, map_arrow, with_lookup
from .graph import lowest_reachable

SHINGLE = 4
SEED = 42
MAX_BITS = 4
_BYTES = 8
_MIN_SHARED = _BYTES - MAX_BITS
_INDEXED = 7  # byte positions that are indexed
_KEY_BYTES = _MIN_SHARED - (_BYTES - _INDEXED)  # of these, a linked pair shares so many
_LIST = 1024
_HASHES = 1 << 16  # shingles hashed at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text, as an unsigned number; zero for a text without words."""
    import xxhash

    words = (text or b"").lower().split()  # on bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(stops), _HASHES):
        part = [digest(joined[a:b], seed) for a, b in zip(starts[i : i + _HASHES], stops[i : i + _HASHES])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(stops), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """The rows with their fingerprint as a signed long (the same 64 bits)."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(out_col, prints(F.col(text_col).cast("binary")))


def _postings(prints: DataFrame) -> DataFrame:
    """(key, fp): a row for each set of indexed positions; the key holds the set's number and the bytes."""

    def byte(position: int) -> Column:
        return F.shiftrightunsigned(F.col("fp"), 8 * position).bitwiseAND(F.lit(255))

    keys = []
    for number, positions in enumerate(combinations(range(_INDEXED), _KEY_BYTES)):
        key: Column = F.lit(number).cast("long")
        for position in positions:
            key = key * 256 + byte(position)
        keys.append(key)
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _blocks(postings: DataFrame) -> DataFrame:
    """(left, right): lists of fingerprints to compare, with each other or, without right, among themselves."""
    sizes = postings.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    blocks = F.ceil(F.col("size") / _LIST).cast("int")
    # Always by a merge: Spark takes an exploded table for as many rows as before, here a 35th, and would broadcast it.
    dealt = (
        postings.join(sizes.hint("merge"), "key")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("fp", "key"), F.col("blocks")).cast("int"))
    )
    # Each fingerprint goes to every pair of blocks that holds its own.
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
    pairs = dealt.select("key", "fp", "block", partner).select(
        "key",
        F.least("block", "partner").alias("i"),
        F.greatest("block", "partner").alias("j"),
        F.when(F.col("block") <= F.col("partner"), F.col("fp")).alias("left"),
        F.when(F.col("block") > F.col("partner"), F.col("fp")).alias("right"),
    )
    return pairs.groupBy("key", "i", "j").agg(
        F.collect_list("left").alias("left"), F.collect_list("right").alias("right")
    ).select("left", "right")


def _close(left: np.ndarray, right: np.ndarray, max_bits: int) -> np.ndarray:
    """Boolean matrix of verified pairs; both sides are rows of eight bytes."""
    shared = np.zeros((len(left), len(right)), dtype=np.uint8)
    for position in range(_BYTES):
        shared += left[:, position, None] == right[None, :, position]
    i, j = np.nonzero(shared >= _BYTES - max_bits)
    differing = np.bitwise_count(left.view("<u8")[i, 0] ^ right.view("<u8")[j, 0])
    linked = np.zeros(shared.shape, dtype=bool)
    linked[i, j] = differing <= max_bits
    return linked


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect what the verified pairs connect. ``prints`` has distinct longs in ``fp``."""

    def compare(batch: pa.RecordBatch) -> dict | None:
        one, other = [], []
        for left, right in zip(batch.column(0), batch.column(1)):
            x = np.asarray(left.values, dtype=np.int64)
            y = np.asarray(right.values, dtype=np.int64)
            fps = np.concatenate([x, y])
            order = np.argsort(fps)  # so that the links lead to the lowest fingerprint, not from it
            fps, second = fps[order], order >= len(x)
            rows = fps.view(np.uint8).reshape(-1, _BYTES)
            linked = _close(rows, rows, max_bits)
            if len(y):  # two blocks; what is within either is compared elsewhere
                linked &= second[:, None] != second[None, :]
            np.fill_diagonal(linked, False)
            root = components(linked)
            moved = np.flatnonzero(root != np.arange(len(fps)))
            one.append(fps[moved])
            other.append(fps[root[moved]])
        if not one:
            return None
        return {"a": pa.array(np.concatenate(one)), "b": pa.array(np.concatenate(other))}

    return map_arrow(_blocks(_postings(prints)), compare, "a long, b long")


def _classes(docs: DataFrame, id_col: str, text_col: str, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp, k1, k2) of every row, and (fp, best) of the fingerprints whose class has more than one row.

    k1 and k2 are a hash of id and text. ``best`` is the first row of the class: that with the smallest id (null ids last),
    among equal ids by the hash. Rows alone in their class are not in the second table, which so grows with the copies.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the index guarantees links up to {MAX_BITS} bits")
    id_, text = F.col(id_col), F.col(text_col)
    keyed = docs.select(id_.alias("id"), text.alias("text"), *row_keys(id_col, text_col))
    rows = stored(with_fingerprint(keyed, "text", "fp").select("id", "fp", "k1", "k2"), "fingerprints")
    best = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "k1", "k2")).alias("best")
    prints = stored(rows.groupBy("fp").agg(F.count("*").alias("n"), best), "distinct-fingerprints")
    roots = lowest_reachable(links(prints.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    shared = stored(
        prints.join(roots, "fp", "left")
        .filter((F.col("n") > 1) | F.col("root").isNotNull())
        .select("fp", "best", F.coalesce("root", "fp").alias("root")),
        "shared-fingerprints",
    )
    firsts = stored(shared.groupBy("root").agg(F.min("best").alias("best")), "first-of-class")
    named = with_lookup(shared.select("fp", "root"), firsts, ["root"], F.col("fp")).select("fp", "best")
    return rows, stored(named, "classes")


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """128 bits that tell rows apart by id and text."""
    id_, text = F.col(id_col), F.col(text_col)
    return [F.xxhash64(id_, text).alias("k1"), F.xxhash64(text, F.lit("|"), id_).alias("k2")]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fp long, component_id): the fingerprint of each row and the smallest id of its class.

    A class holds what a chain of links connects. Texts without words, null or empty, have fingerprint
    zero and form a class with each other and with what lies within ``max_bits`` of zero. Every row gives a
    row, repeated ones too; a null id is never a class's smallest. Columns besides id and text have
    no effect; no rows give no rows. ``max_bits`` is at most 4.
    """
    rows, classes = _classes(docs, id_col, text_col, max_bits)
    named = with_lookup(rows, classes, ["fp"], F.col("k1"), how="left")
    return named.select(F.col("id").alias(id_col), "fp", F.coalesce("best.id", "id").alias("component_id"))


def one_of_each_class(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents without near-duplicates: of each class one row stays, with all its columns.

    It is the row with the smallest id; a null id comes after all others, and between rows with one id a hash of the text
    decides, so that rows are judged one by one also where ids are missing or repeated. Of rows alike in id and text any
    one stays. Only ids and hashes are moved to find what goes, and only documents that may go are moved to be joined.
    """
    rows, classes = _classes(docs, id_col, text_col, max_bits)
    first = (F.col("k1") == F.col("best.k1")) & (F.col("k2") == F.col("best.k2"))
    judged = with_lookup(rows, classes, ["fp"], F.col("k1")).select("k1", "k2", first.alias("stays"))
    decisions = judged.groupBy("k1", "k2").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
    # Rows that go, and rows of which one of several alike stays; these are moved, the others only read.
    special = stored(decisions.filter(~F.col("stays") | (F.col("n") > 1)).select("k1", "k2", "stays"), "class-decisions")
    packed = docs.select(*row_keys(id_col, text_col), F.struct("*").alias("row"))
    others, rest = by_ids(packed, "k1", special.select("k1"))
    joined = rest.join(special.hint("merge"), ["k1", "k2"], "left")
    untouched = joined.filter(F.col("stays").isNull())
    single = joined.filter("stays").dropDuplicates(["k1", "k2"])
    kept = others.select("row").union(untouched.select("row")).union(single.select("row"))
    return kept.select(*(F.col("row").getField(name).alias(name) for name in docs.columns))


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
