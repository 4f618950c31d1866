"""Packing of tokenized documents into training sequences, by the sum-of-squares rule.

Every document becomes its token ids and an end id. Whole windows are cut off first; what remains, less
than a window, is placed online: among the fill levels where it fits, and a new window, the one
is chosen after which the sum over levels of the squared number of partly filled windows at that level is
smallest. The counts per level are the only state of the choice, an array as long as a window.
Levels that are powers of two need no padding and do not count.

Each partition of the input is packed on its own, in one pass and in the task that tokenizes it, so
nothing is shuffled and no state outgrows the open windows of one partition. At the end of a partition the
documents in its emptiest open windows are cut to fill up the fullest ones, and the single window that then
remains is cut into powers of two: a partition needs no padding.

Sequence ids join the partition's number and a running number. They depend on the layout of the
input and on the order within a partition; where rows arrive in another order, as after a shuffle, a task
that is repeated may number its sequences otherwise. Write the result before using it several times.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .common import sliced

WINDOW = 1024
END_ID = 0
_SEQUENCE_BITS = 33  # running number within a partition


class Encoder:
    """Token ids of texts, as the tokenizers library gives them; equal pre-tokens are encoded once."""

    def __init__(self, json_path: str, limit: int = 250_000):
        self._library = pretokens.library_tokenizer(json_path)
        self._character = dict(enumerate(pretokens.byte_characters()))
        self._numbers = pretokens.Numbering(limit)
        self._forget()

    def _forget(self) -> None:
        self._pool = np.empty(0, dtype="<u4")
        self._start = np.empty(0, dtype=np.int64)
        self._length = np.empty(0, dtype=np.int64)
        self._end_number = -1

    def _learn(self, fresh: list[bytes]) -> None:
        tokenize, character = self._library.model.tokenize, self._character
        found = [
            [END_ID] if part == pretokens.END else [t.id for t in tokenize(part.decode("latin-1").translate(character))]
            for part in fresh
        ]
        if pretokens.END in fresh:
            self._end_number = len(self._start) + fresh.index(pretokens.END)
        length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(length.sum()))
        self._start = np.concatenate([self._start, len(self._pool) + np.cumsum(length) - length])
        self._length = np.concatenate([self._length, length])
        self._pool = np.concatenate([self._pool, ids])

    def _ended(self, texts: list[str]) -> Iterator[bytes]:
        """For usual texts: the ids of each, with the end id, as little-endian unsigned 32-bit numbers."""
        open_parts: list[bytes] = []
        for group in pretokens.grouped(texts):
            numbers, fresh, afresh = self._numbers.of(group)
            if afresh:
                self._forget()
            if fresh:
                self._learn(fresh)
            length = self._length[numbers]
            ends = np.cumsum(length)
            ids = self._pool[np.repeat(self._start[numbers] - (ends - length), length) + np.arange(ends[-1])].tobytes()
            begin = 0
            for stop in (4 * ends[numbers == self._end_number]).tolist():
                yield b"".join([*open_parts, ids[begin:stop]])
                open_parts = []
                begin = stop
            if begin < len(ids):
                open_parts.append(ids[begin:])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order, with the end id."""
        usual = [pretokens.is_usual(text) for text in texts]
        ended = self._ended([text for text, plain in zip(texts, usual) if plain])
        for text, plain in zip(texts, usual):
            if plain:
                yield next(ended)
            else:
                ids = self._library.encode(text, add_special_tokens=False).ids
                yield np.array([*ids, END_ID], dtype="<u4").tobytes()


def is_power_of_two(n: int) -> bool:
    return n & (n - 1) == 0


class SumOfSquares:
    """Online choice of windows; a piece is (document, start, length) and is given out when its window closes."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.closed: list[tuple[int, list[tuple[int, int, int]]]] = []  # (sequence, pieces)
        self._next = 0
        self._open: dict[int, list[int]] = {}  # fill level -> windows
        self._pieces: dict[int, list[tuple[int, int, int]]] = {}
        self._padded = np.array([h and not is_power_of_two(h) for h in range(window + 1)], dtype=bool)
        # What the sum of squares gains when a window leaves a level or enters it.
        self._leave = np.full(window + 1, np.inf)
        self._leave[0] = 0
        self._enter = self._padded.astype(float)
        self._enter[window] = 0

    def _set(self, level: int) -> None:
        n = len(self._open.get(level, ()))
        self._leave[level] = (1.0 - 2 * n) * self._padded[level] if n else np.inf
        self._enter[level] = (1.0 + 2 * n) * self._padded[level]

    def add(self, document: int, length: int) -> None:
        """Place a document: its whole windows, then the rest."""
        whole = length - length % self.window
        for start in range(0, whole, self.window):
            self._close([(document, start, self.window)])
        if length > whole:
            self._place((document, whole, length - whole))

    def _place(self, piece: tuple[int, int, int]) -> None:
        size = piece[2]
        gain = self._leave[: self.window - size + 1] + self._enter[size:]
        level = len(gain) - 1 - int(gain[::-1].argmin())  # among equals the fullest
        if level:
            number = self._open[level].pop()
            self._set(level)
            self._pieces[number].append(piece)
        else:
            number = self._next
            self._next += 1
            self._pieces[number] = [piece]
        level += size
        if level == self.window:
            self.closed.append((number, self._pieces.pop(number)))
        else:
            self._open.setdefault(level, []).append(number)
            self._set(level)

    def _close(self, pieces: list[tuple[int, int, int]]) -> None:
        self.closed.append((self._next, pieces))
        self._next += 1

    def finish(self) -> None:
        """Close what is open; only documents of the emptiest windows are cut."""
        rest = []
        for level, numbers in self._open.items():
            for number in numbers:
                pieces = self._pieces.pop(number)
                if self._padded[level]:
                    rest.append((level, pieces))
                else:
                    self.closed.append((number, pieces))
        self._open.clear()
        rest.sort(key=lambda x: x[0])
        spare: list[tuple[int, int, int]] = []  # pieces of windows given up
        low, high = 0, len(rest) - 1
        while low <= high:
            level, pieces = rest[high]
            high -= 1
            need = self.window - level
            while need and (spare or low <= high):
                if not spare:
                    spare = rest[low][1]
                    low += 1
                document, start, length = spare.pop()
                take = min(length, need)
                pieces.append((document, start + length - take, take))
                need -= take
                if take < length:
                    spare.append((document, start, length - take))
            if need:
                spare = pieces
                break
            self._close(pieces)
        # Less than one window is left, or the rest of a cut one.
        total = sum(length for _, _, length in spare)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part = []
            while size:
                document, start, length = spare.pop()
                take = min(length, size)
                part.append((document, start, take))
                size -= take
                if take < length:
                    spare.append((document, start + take, length - take))
            self._close(part)


def pack(
    docs: DataFrame,
    json_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and token_ids if asked for.

    A null or empty text is a document of the end id alone. Every row is a document, repeated rows and
    null ids included; columns besides id and text have no effect. An empty table gives no rows.
    """
    json_path = pretokens.vocabulary_file(json_path, "byte_bpe_50k.json")
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(json_path)
        packer = SumOfSquares(window)
        first = TaskContext.get().partitionId() << _SEQUENCE_BITS
        # Documents with pieces not yet given out: number -> [id, bytes of their last tokens, how many are still to
        # be given out, how many the document has].
        documents: dict[int, list] = {}
        number = 0

        def given_out() -> pa.RecordBatch | None:
            rows = []
            for sequence, pieces in packer.closed:
                offset = 0
                for document, start, length in pieces:
                    entry = documents[document]
                    begin = 4 * (start - entry[3]) + len(entry[1])
                    part = entry[1][begin : begin + 4 * length]
                    rows.append((entry[0], start, length, zlib.crc32(part), entry[3], first + sequence, offset, part))
                    offset += length
                    entry[2] -= length
                    if not entry[2]:
                        del documents[document]
            packer.closed.clear()
            # What waits in an open window is the end of a document, less than a window.
            for entry in documents.values():
                entry[1] = entry[1][len(entry[1]) - 4 * entry[2] :]
            if not rows:
                return None
            ids, start, length, crc, tokens, sequence, offset, parts = zip(*rows)
            long = pa.int64()
            columns = {
                "doc_id": ids_of(ids), "start": pa.array(start, long), "length": pa.array(length, long),
                "ids_crc32": pa.array(crc, long), "doc_tokens": pa.array(tokens, long),
                "sequence_id": pa.array(sequence, long), "offset": pa.array(offset, long),
            }
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum(length)]).astype("i4")
                values = np.frombuffer(b"".join(parts), dtype="<i4")
                columns["token_ids"] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
            return pa.RecordBatch.from_pydict(columns)

        arrow_type = None

        def ids_of(values):
            return pa.array(values, arrow_type)

        size = 0
        for batch in sliced(batches):
            arrow_type = batch.schema.field(0).type
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for id_, tokens in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                documents[number] = [id_, tokens, len(tokens) // 4, len(tokens) // 4]
                packer.add(number, len(tokens) // 4)
                number += 1
                size += len(tokens)
                if size > 1 << 22:  # give out by about 4 MB of ids
                    size = 0
                    if (out := given_out()) is not None:
                        yield out
        packer.finish()
        if (out := given_out()) is not None:
            yield out

    schema = (
        f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long"
    )
    if with_ids:
        schema += ", token_ids array<int>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
