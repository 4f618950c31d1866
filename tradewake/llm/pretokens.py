"""Cutting many texts into pre-tokens at once, and numbering the distinct ones.

The vocabularies split text by a fixed pattern before they merge, and never merge across the parts. For
texts of characters whose classes are beyond doubt (ASCII without control characters, line breaks, Latin
letters) the parts follow from the class of each byte and of its neighbours, so they are found with array
operations over the texts of a batch joined together. Other texts, and texts that hold special strings, go
to the library's own splitter.

Parts repeat a lot. A worker numbers the distinct ones, so that what follows (merging) is done once per part; when it
holds more than its limit it starts afresh. A hash only brings equal parts together: their bytes are compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

END_OF_TEXT = "<|endoftext|>"
END = b"\0"  # stands behind each text; no usual text holds it

_UNUSUAL = re.compile("[^\n -~À-ÖØ-öø-ɏ]")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SUFFIXES = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")  # fixed values of the pattern, after an apostrophe

_LETTER, _DIGIT, _SPACE, _OTHER, _END = range(5)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
for _bytes, _kind in ((range(65, 91), _LETTER), (range(97, 123), _LETTER), (range(128, 256), _LETTER),
                      (range(48, 58), _DIGIT), ((32, 10), _SPACE), ((0,), _END)):
    _CLASS[list(_bytes)] = _kind


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The printable character by which such vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b if b in set(plain) else 256 + rest.index(b)) for b in range(256)]


def is_usual(text: str) -> bool:
    """Whether the text has usual characters only and no special string."""
    return not _UNUSUAL.search(text) and END_OF_TEXT not in text


def vocabulary_file(path: str | None, name: str) -> str:
    """The given path, or that of the installed public vocabulary of this name."""
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library_tokenizer(path: str):
    """The tokenizer of a JSON vocabulary, one per worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _segments(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut before a single space, where a pre-token begins."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def grouped(texts: list[str], size: int = 1 << 19) -> Iterator[bytes]:
    """The texts joined, an end byte behind each, in parts of about ``size``; a part may end within a long text."""
    parts: list[bytes] = []
    held = 0
    for text in texts:
        for segment in _segments(text, size):
            if held >= size:
                yield b"".join(parts)
                parts, held = [], 0
            parts.append(segment.encode())
            held += len(parts[-1])
        parts.append(END)
    if parts:
        yield b"".join(parts)


def starts_of(data: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens begin in joined texts."""
    kind = _CLASS[data]
    before = np.append(np.uint8(_END), kind[:-1])
    after = np.append(kind[1:], np.uint8(_END))
    spaced = np.append(False, data[:-1] == 32)  # a space joins what follows it
    white = kind == _SPACE
    start = np.where(
        white,
        (before != _SPACE) | ((after != _SPACE) & (after != _END)),  # the last of several stands apart
        ((before != kind) | (kind == _END)) & ~spaced,
    )
    start[kind == _END] = True
    if len(data):
        start[0] = True
    for at in np.flatnonzero((data == 39) & (before != _OTHER) & ~spaced):
        following = data[at + 1 : at + 3].tobytes()
        for suffix in _SUFFIXES:
            if following.startswith(suffix):
                start[at + 1] = False
                end = at + 1 + len(suffix)
                if end < len(data) and kind[end] == _LETTER:
                    start[end] = True
                break
    return np.flatnonzero(start)


_random = np.random.default_rng(20_250_101)
_SUBSTITUTE = _random.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, np.uint64(base))
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A polynomial hash of each part, modulo 2^64, with the byte values replaced by random ones."""
    n = 1 << max(16, len(data).bit_length())
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_SUBSTITUTE[data] * _powers(int(_BASE), n)[: len(data)], out=sums[1:])
    ends = np.append(starts[1:], len(data))
    value = (sums[ends] - sums[starts]) * _powers(int(_INVERSE), n)[starts]
    return (value ^ (value >> np.uint64(29))) * _BASE


_DIRECT = 256  # bytes; longer parts are compared as byte strings


def _unlike(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Places of the parts that differ from another part each, given by its place; compared byte by byte, eight at a time."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    differs = length != length[other]
    active = np.flatnonzero(~differs & (other != np.arange(len(starts))))
    for at in active[length[active] > _DIRECT].tolist():
        a, b = slice(starts[at], ends[at]), slice(starts[other[at]], ends[other[at]])
        differs[at] = data[a].tobytes() != data[b].tobytes()
    active = active[length[active] <= _DIRECT]
    for offset in range(0, _DIRECT, 8):
        if not len(active):
            break
        unequal = words[starts[active] + offset] ^ words[starts[other[active]] + offset]
        spare = np.maximum(offset + 8 - length[active], 0).astype(np.uint64)  # bytes beyond the part
        differs[active] |= (unequal << (np.uint64(8) * spare)) != 0
        active = active[length[active] > offset + 8]
    return np.flatnonzero(differs)


class Numbering:
    """Numbers for distinct pre-tokens, from 0; grows until ``limit`` and then forgets all.

    Within a group equal parts are brought together by a hash, and each is compared with the one that stands for it, so
    that parts which share a hash are told apart. Numbers are kept by the parts themselves.
    """

    def __init__(self, limit: int = 250_000):
        self._limit = limit
        self.clear()

    def clear(self) -> None:
        self._numbers: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self._numbers)

    def of(self, group: bytes) -> tuple[np.ndarray, list[bytes], bool]:
        """The number of each pre-token of a joined group, the new ones, and whether numbers began afresh."""
        data = np.frombuffer(group, dtype=np.uint8)
        starts = starts_of(data)
        ends = np.append(starts[1:], len(data))
        _, first, inverse = np.unique(_hashes(data, starts), return_index=True, return_inverse=True)
        apart = _unlike(data, starts, ends, first[inverse])
        places = np.concatenate([first, apart])
        parts = [group[a:b] for a, b in zip(starts[places].tolist(), ends[places].tolist())]
        new = [part for part in dict.fromkeys(parts) if part not in self._numbers]
        afresh = len(self) + len(new) > self._limit and len(self) > 0
        if afresh:
            self.clear()
            new = list(dict.fromkeys(parts))
        self._numbers.update(zip(new, range(len(self), len(self) + len(new))))
        numbers = np.fromiter(map(self._numbers.__getitem__, parts), dtype=np.int64, count=len(parts))
        found = numbers[: len(first)][inverse]
        found[apart] = numbers[len(first) :]
        return found, new, afresh
