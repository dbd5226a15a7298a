"""Hashes of words and word sequences of whole texts, computed on UTF-8 bytes with NumPy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Byte classes of the two word definitions, in natural order.
WHITE = bytes([0x20, *range(0x09, 0x0E)])  # words are runs of anything else
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])  # after lower-casing A-Z

BLOCK = 1 << 18
_RADIX = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64


def word_bytes(separators: bytes) -> np.ndarray:
    """For each byte value, whether it belongs to a word. Upper case counts as lower case."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


SPACED = word_bytes(WHITE)
ALNUM = word_bytes(NON_ALNUM)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection that makes all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_CODES = _EXACT.copy()  # upper case A-Z has the code of its lower case
_CODES[0x41:0x5B] = _CODES[0x61:0x7B]
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size, inverse = max(n, BLOCK + 1), pow(_RADIX, -1, 1 << 64)
        up, down = np.full(size, _RADIX % (1 << 64), np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _spans(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = is_word[raw]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _blocks(raw: np.ndarray, is_word: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of about ``BLOCK`` bytes that end between words, so that memory follows the block, not the text."""
    at = 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw):
            gap = np.flatnonzero(~is_word[raw[end : end + BLOCK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + BLOCK, len(raw))
        yield raw[at:end]
        at = end


def _hashed_spans(raw: np.ndarray, is_word: np.ndarray, codes: np.ndarray, pick) -> np.ndarray:
    """Hashes of the spans that ``pick(starts, ends)`` gives for the words of each block of a text.

    Prefix sums of ``code(byte) * radix**place`` give every span's polynomial hash at once."""
    found = []
    for block in _blocks(raw, is_word):
        starts, ends = pick(*_spans(block, is_word))
        if not len(starts):
            continue
        up, down = _powers(len(block) + 1)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(codes[block] * up[: len(block)], out=sums[1:])
        found.append(mix((sums[ends] - sums[starts]) * down[starts]))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def word_hashes(raw: np.ndarray, is_word: np.ndarray = SPACED, exact_case: bool = False) -> np.ndarray:
    """A 64-bit hash for each word of a UTF-8 text, upper case A-Z read as lower case unless ``exact_case``."""
    return _hashed_spans(raw, is_word, _EXACT if exact_case else _CODES, lambda starts, ends: (starts, ends))


def stem_hashes(raw: np.ndarray, is_word: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """A hash for each word, and for the first bytes of each longer word, as many as each of ``sizes``; A-Z as a-z."""

    def pick(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        long = [starts[ends - starts > size] for size in sizes]
        return np.concatenate([starts, *long]), np.concatenate([ends, *(s + size for s, size in zip(long, sizes))])

    return _hashed_spans(raw, is_word, _CODES, pick)


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total = (total + words[j : j + n]) * np.uint64(0xD1342543DE82EF95)
    return mix(total ^ np.uint64(width))


def utf8(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The bytes of each string of an Arrow column, without decoding; None for a null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    nulls = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else np.zeros(len(column), bool)
    for i in range(len(column)):
        yield None if nulls[i] else body[places[i] : places[i + 1]]
