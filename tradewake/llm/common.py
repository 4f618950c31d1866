"""What several of the operators share: learning folds, and Python stages over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """The fold of a row: CRC-32 of its id's text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def beside(docs: DataFrame, found: dict[str, Column], fields: dict[str, str]) -> DataFrame:
    """The rows, whatever their columns are called, with new ones after them: name -> field of ``found``, in SQL.

    Columns with a new one's name are replaced.
    """
    packed = docs.select(F.struct("*").alias("row"), *(column.alias(name) for name, column in found.items()))
    kept = [F.col("row").getField(name).alias(name) for name in docs.columns if name not in fields]
    return packed.select(*kept, *(F.col(field).alias(name) for name, field in fields.items()))


def rows_where(docs: DataFrame, condition: Column, found: dict[str, Column]) -> DataFrame:
    """The rows that meet a condition on new columns, with their own columns only."""
    packed = docs.select(F.struct("*").alias("row"), *(column.alias(name) for name, column in found.items()))
    return packed.filter(condition).select(*(F.col("row").getField(name).alias(name) for name in docs.columns))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows, which bounds what is unpacked into Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict | None], schema: str, rows: int | None = None
) -> DataFrame:
    """Apply a function from a batch to columns, in tasks; batches for which it returns None give no row.

    ``rows`` bounds the rows of a batch, for functions that unpack texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if rows is None else sliced(batches, rows):
            columns = function(batch)
            if columns is not None:
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


def components(linked):
    """For a square boolean matrix: the smallest index that each row reaches."""
    n = len(linked)
    root = np.arange(n)
    # Rows with no link need no rounds.
    active = np.flatnonzero(linked.any(axis=1))
    inner = linked[np.ix_(active, active)] | np.eye(len(active), dtype=bool)
    label = active.copy()
    while len(active):
        lowest = np.where(inner, label[None, :], n).min(axis=1)
        # Jump: a label is itself an active row, whose label may be lower still.
        lowest = lowest[np.searchsorted(active, lowest)]
        if (lowest == label).all():
            break
        label = lowest
    root[active] = label
    return root


def bit_map(hashes: DataFrame, bits: int) -> bytes:
    """A bit per hash modulo ``bits`` (a power of two), from a column ``hash`` of longs.

    Its size is fixed: at most bits / 64 numbers come to the driver, whatever the number of hashes.
    """
    place = F.col("hash").bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("set")).toArrow()
    table = np.zeros(bits // 64, dtype=np.int64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy()
    return table.tobytes()


def bits_for(n: int, per_entry: int = 16, least: int = 1 << 20, most: int = 1 << 29) -> int:
    """The size of a map for so many entries, a power of two; ``most`` (64 MB) bounds what is broadcast."""
    return min(max(1 << (per_entry * max(n, 1) - 1).bit_length(), least), most)


SMALL_ROWS = 1_000_000  # of a few numbers each: some tens of megabytes
SALTS = 32


def with_lookup(
    rows: DataFrame, lookup: DataFrame, on: list[str], salt: Column, small: int = SMALL_ROWS, how: str = "inner"
) -> DataFrame:
    """The rows joined (inner or left) with a stored table of narrow rows, one or few for each key, whatever the keys' sizes.

    The table is counted. Up to ``small`` rows it is broadcast; beyond, each of its rows is repeated for a few salts
    and the rows are dealt to them by ``salt``, any column of whole numbers, so that a hot key is in many tasks. These are
    joined by a merge, as Spark sizes repeated rows like single ones and might broadcast them. A null in a key joins nothing.
    """
    if lookup.count() <= small:
        return rows.join(F.broadcast(lookup), on, how)
    salted = lookup.withColumn("salt of key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt of key", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    return dealt.join(salted.hint("merge"), [*on, "salt of key"], how).drop("salt of key")


def is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of some hashes are set in a map, given as bytes in an array."""
    place = hashes.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def id_hash(id_: Column) -> Column:
    return F.xxhash64(id_.cast("string"))


def id_map(ids: DataFrame, bits: int | None = None):
    """A broadcast bit map of ids, a stored frame of one column, sized by their number up to a bound."""
    bits = bits_for(ids.count()) if bits is None else bits
    table = bit_map(ids.select(id_hash(F.col(ids.columns[0])).alias("hash")), bits)
    return ids.sparkSession.sparkContext.broadcast(table)


def by_ids(docs: DataFrame, id_col: str, ids: DataFrame, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows whose id is certainly not among ``ids`` (a stored frame of one column), and the others, to be joined.

    So that few whole documents are moved when a few of them are to go, the ids are made into a bit map, sized by their
    number (sixteen bits each) up to a bound; beyond it more and more rows are in the second part, at the end all.
    """
    shared = id_map(ids, bits)

    @F.pandas_udf("boolean")
    def may_be(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = np.frombuffer(shared.value, dtype=np.uint8)
        for hashes in batches:
            yield pd.Series(is_set(found, hashes.to_numpy(dtype=np.int64)))

    found = {"held": may_be(id_hash(F.col(id_col)))}
    return rows_where(docs, ~F.col("held"), found), rows_where(docs, F.col("held"), found)
