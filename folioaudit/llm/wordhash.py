"""Hashes of all words of many texts at once, from sums over their bytes.

A word's hash is a polynomial in its bytes' values, taken as the difference of
two running sums, so no word becomes a Python object. Words of more than
``LONG`` bytes are hashed one by one. Texts are worked through in blocks of
``BLOCK`` bytes that end between words, whatever their length.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

BLOCK = 1 << 19
LONG = 4096
BASE = 0x9E3779B97F4A7C15
_VALUES = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _block_powers() -> tuple[np.ndarray, np.ndarray]:
    return powers(BASE, BLOCK), powers(pow(BASE, -1, 2**64), BLOCK)


def mixed(total: np.ndarray) -> np.ndarray:
    total = (total ^ (total >> np.uint64(32))) * np.uint64(BASE)
    return total ^ (total >> np.uint64(29))


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values`` from each start to its end; equal sequences have equal ones."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(pow(BASE, -1, 2**64), len(values))[starts])


def buffers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts, and the last one ends; NULL is empty."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), offsets


def bytes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """As ``buffers_of``, for texts themselves."""
    encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    return np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)], dtype=np.int64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and hashes of all words of neighbouring texts, in their order."""
    starts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = _block_end(data, offsets, at, end)
        if stop > at:
            own, found = _of_block(data[at:stop], offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop)] - at)
        else:
            stop = _word_end(data, offsets, at)
            own, found = np.zeros(1, np.int64), np.array([_of_long(data[at:stop])], np.uint64)
        starts.append(own + at)
        hashes.append(found)
        at = stop
    return np.concatenate(starts), np.concatenate(hashes)


def _block_end(data: np.ndarray, offsets: np.ndarray, at: int, end: int) -> int:
    """The last place between words in the block from ``at`` on, or ``at`` if one word fills it."""
    stop = at + BLOCK
    if stop >= end:
        return end
    edge = max(at, int(offsets[np.searchsorted(offsets, stop, "right") - 1]))
    spaces = np.flatnonzero(_SPACE[data[edge:stop]])
    return edge + int(spaces[-1]) + 1 if len(spaces) else edge


def _word_end(data: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """Where the word that fills the block from ``at`` on ends."""
    end = int(offsets[np.searchsorted(offsets, at, "right")])
    for k in range(at, end, BLOCK):
        spaces = np.flatnonzero(_SPACE[data[k : min(end, k + BLOCK)]])
        if len(spaces):
            return k + int(spaces[0])
    return end


def _of_long(word: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(word.tobytes())


def _of_block(part: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of one block, in which other texts start at ``heads``."""
    word = ~_SPACE[part]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[heads] = word[heads]
    last[heads - 1] = word[heads - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    ahead, back = _block_powers()
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_VALUES[part] * ahead[: len(part)], out=sums[1:])
    found = mixed((sums[ends] - sums[starts]) * back[starts])
    for k in np.flatnonzero(ends - starts > LONG):
        found[k] = _of_long(part[starts[k] : ends[k]])
    return starts, found


def words_per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(starts, offsets))


def line_heads(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lines that have words: their first words, and their numbers in their texts."""
    own = data[offsets[0] : offsets[-1]]
    breaks = np.flatnonzero(own == 10) + offsets[0]
    before = np.searchsorted(breaks, starts)
    text = np.searchsorted(offsets, starts, "right") - 1
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (before[1:] != before[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(fresh)
    return heads, before[heads] - np.searchsorted(breaks, offsets)[text[heads]]


def groups(offsets: np.ndarray, size: int) -> list[slice]:
    """Neighbouring texts of about ``size`` bytes together."""
    out, start = [], 0
    while start + 1 < len(offsets):
        stop = int(np.searchsorted(offsets, offsets[start] + size))
        stop = min(max(stop, start + 1), len(offsets) - 1)
        out.append(slice(start, stop))
        start = stop
    return out
