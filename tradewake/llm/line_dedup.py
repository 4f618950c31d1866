"""Lines that many documents repeat, found with two Bloom filters and confirmed exactly.

Every long line of every document has a key (stripped, A-Z in lower case) and a digest of it. Two filters take in the
digests: one those seen, the other those that the first one held already. A digest that occurs twice, in whichever
tasks, is in the second filter; only digests found there are suspected, and only suspected ones are shuffled: they are
counted exactly and the document that keeps the line is chosen.

Scale:

* Texts are read once to make digests and once to drop lines. In between there are only rows of four numbers.
* Every task fills filters of its own. They are united piece by piece: a place set in both of two tasks' first filters
  is one of the second filter. This never loses a repeat; what it adds is suspected for nothing and falls at the count.
* The filters' size follows the number of digests up to ``most_bits``. Beyond that more and more digests are suspected
  for nothing, at most all of them, which then costs the shuffle of a narrow row each; results stay the same.
* A line in a third of all documents is counted with a partial sum in each task, and its holders are told by a
  broadcast of checked size or a salted join. Only documents that lose lines are moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored
from .common import bits_for, by_ids, is_set, sliced, with_lookup

MIN_LENGTH = 40
MIN_DOCS = 5
HASHES = 3
MOST_BITS = 1 << 29
_PIECE = 1 << 13  # bytes of a filter that are united at a time
_WHITE = b" \t\n\x0b\x0c\r"


def _key(line: bytes, min_length: int) -> bytes | None:
    """The key of a line in lower case, or None if it is too short to count."""
    key = line.strip(_WHITE)
    if len(key) < min_length or not (key.isascii() or len(key.decode()) >= min_length):
        return None
    return key


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def line_digests(docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """(row, id, h1, h2): the 128-bit digest of each distinct long line of each row.

    ``row`` is a hash of id and text: rows alike in both have the same lines.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            owner, digests = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                if text is None or len(text) < min_length:
                    continue
                keys = {_key(line, min_length) for line in text.encode().lower().split(b"\n")}
                keys.discard(None)
                owner += [i] * len(keys)
                digests += map(_digest, keys)
            if owner:
                numbers = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                at = pa.array(owner)
                yield pa.RecordBatch.from_pydict({
                    "row": batch.column(0).take(at), "id": batch.column(1).take(at),
                    "h1": pa.array(numbers[:, 0]), "h2": pa.array(numbers[:, 1]),
                })

    return row_key(docs, id_col, text_col).mapInArrow(run, f"row long, id {id_type}, h1 long, h2 long")


def row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_, text = F.col(id_col), F.col(text_col)
    return docs.select(F.xxhash64(id_, text).alias("row"), id_.alias("id"), text.alias("text"))


def _places(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    """The places of each digest in a filter of so many bits, a row for each of them."""
    step = h2.view(np.uint64) | np.uint64(1)
    start = h1.view(np.uint64)
    return np.stack([(start + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(HASHES)])


def _held(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([is_set(table, row) for row in places])


def _put(table: np.ndarray, places: np.ndarray) -> None:
    """Set bits, also where several are in one byte."""
    places = np.unique(places)
    byte = (places >> np.uint64(3)).astype(np.int64)
    bit = np.left_shift(np.uint8(1), (places & np.uint64(7)).astype(np.uint8))
    first = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]]) if len(byte) else byte
    table[byte[first]] |= np.bitwise_or.reduceat(bit, first) if len(byte) else bit


def filters_of(lines: DataFrame, bits: int) -> DataFrame:
    """(piece, once, twice): the two filters over the digests, in pieces; pieces that hold nothing are left out."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (np.zeros(bits // 8, dtype=np.uint8) for _ in range(2))
        for batch in batches:
            pairs = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
            pairs, counts = np.unique(pairs, axis=0, return_counts=True)
            places = _places(pairs[:, 0].copy(), pairs[:, 1].copy(), bits)
            _put(twice, places[:, (counts > 1) | _held(once, places)])
            _put(once, places)
        size = min(_PIECE, bits // 8)
        for piece in np.flatnonzero(once.reshape(-1, size).any(axis=1)).tolist():
            part = slice(piece * size, (piece + 1) * size)
            yield pa.RecordBatch.from_pydict(
                {"piece": [piece], "once": [once[part].tobytes()], "twice": [twice[part].tobytes()]}
            )

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces come in order; one is held at a time."""
        number, once, twice = None, None, None
        for batch in batches:
            for piece, seen, again in zip(*(column.to_pylist() for column in batch.columns)):
                seen, again = (np.frombuffer(x, dtype=np.uint8) for x in (seen, again))
                if piece == number:
                    twice |= again | (once & seen)
                    once |= seen
                    continue
                if number is not None:
                    yield pa.RecordBatch.from_pydict({"piece": [number], "once": [once.tobytes()], "twice": [twice.tobytes()]})
                number, once, twice = piece, seen.copy(), again.copy()
        if number is not None:
            yield pa.RecordBatch.from_pydict({"piece": [number], "once": [once.tobytes()], "twice": [twice.tobytes()]})

    schema = "piece long, once binary, twice binary"
    pieces = lines.select("h1", "h2").mapInArrow(fill, schema)
    return pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(unite, schema)


def suspected(lines: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """The digests that the second filter holds: all that occur twice, and few others."""
    table = np.zeros(bits // 8, dtype=np.uint8)
    size = min(_PIECE, bits // 8)
    pieces = filters.select("piece", "twice").toArrow()  # bits / 8 bytes at most
    for piece, twice in zip(pieces.column("piece").to_pylist(), pieces.column("twice")):
        table[piece * size : (piece + 1) * size] = np.frombuffer(twice.as_buffer(), dtype=np.uint8)
    shared = lines.sparkSession.sparkContext.broadcast(table.tobytes())

    @F.pandas_udf("boolean")
    def held(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        found = np.frombuffer(shared.value, dtype=np.uint8)
        for h1, h2 in batches:
            yield pd.Series(_held(found, _places(h1.to_numpy(dtype=np.int64), h2.to_numpy(dtype=np.int64), bits)))

    return lines.filter(held("h1", "h2"))


def repeated(suspects: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, last): the digests that enough rows hold, with the largest id that holds them."""
    counted = suspects.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("id").alias("last"))
    return counted.filter(F.col("docs") >= min_docs).drop("docs")


def losses(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_docs: int, most_bits: int) -> DataFrame:
    """(row, lost): for each row that loses lines, their digests as an array of (h1, h2)."""
    lines = stored(line_digests(docs, id_col, text_col, min_length), "line-digests")
    bits = bits_for(lines.count(), most=most_bits)
    suspects = stored(suspected(lines, stored(filters_of(lines, bits), "line-filters"), bits), "line-suspects")
    lasts = stored(repeated(suspects, min_docs), "repeated-lines")
    lost = with_lookup(suspects, lasts, ["h1", "h2"], F.col("row")).filter(~F.col("id").eqNullSafe(F.col("last")))
    return stored(lost.groupBy("row").agg(F.collect_set(F.struct("h1", "h2")).alias("lost")), "line-losses")


def without_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS,
    n_lines_col: str = "n_lines",
    n_dropped_col: str = "n_dropped",
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """The documents, with all their columns, without the lines that many of them hold, and two counts of lines.

    A line counts by its key: the line without spaces and control characters 9 to 13 at its ends, A-Z in lower case. A
    key of at least ``min_length`` code points that at least ``min_docs`` rows hold loses its lines in all rows but
    those with the largest id that holds it. Other lines stay as they are, joined by line breaks. Repeated rows are rows;
    a null id is smaller than any. A null or empty text has one empty line and stays null or empty. Columns with
    the names of the two counts are replaced; others have no effect. No rows give no rows.
    """
    lost = losses(docs, id_col, text_col, min_length, min_docs, most_bits)
    named = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"), F.struct("*").alias("of")
    )
    whole, cut = by_ids(named, "row", lost.select("row"))
    kept_type = "struct<text: string, dropped: long>"

    @F.pandas_udf(kept_type)
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, sets in batches:
            found = []
            for text, pairs in zip(texts, sets):
                if pairs is None or text is None:
                    found.append((text, 0))
                    continue
                gone = {np.array([p["h1"], p["h2"]], dtype=np.int64).tobytes() for p in pairs}
                lines = text.encode().split(b"\n")
                stay = []
                for line in lines:
                    key = _key(line.lower(), min_length)
                    if key is None or _digest(key) not in gone:
                        stay.append(line)
                found.append((b"\n".join(stay).decode(), len(lines) - len(stay)))
            yield pd.DataFrame(found, columns=["text", "dropped"])

    joined = cut.join(lost, "row", "left").select("of", "text", kept("text", "lost").alias("kept"))
    parts = whole.select("of", "text", F.struct("text", F.lit(0).cast("long").alias("dropped")).alias("kept")).union(joined)
    n_lines = F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)).cast("long") + 1
    of = [F.col("of").getField(name).alias(name) for name in docs.columns if name not in (text_col, n_lines_col, n_dropped_col)]
    return parts.select(
        *of, F.col("kept.text").alias(text_col), n_lines.alias(n_lines_col), F.col("kept.dropped").alias(n_dropped_col)
    )
