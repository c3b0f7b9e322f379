"""Words of Arrow text columns as 64-bit hashes, whole batches at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are looked at together, and that are hashed together.
SLICE_BYTES = 4 << 20
HASH_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
# White space and ASCII punctuation: between words where punctuation is no part of them.
_MARKS = np.array([not (chr(i).isalnum() or i > 127) for i in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, dtype=np.uint64)
    values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWER = _powers(_BASE, HASH_BYTES)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), HASH_BYTES)


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The rows of a text column in slices: first row, end row, their bytes, each row's offset in them.

    NULL is the empty text. A slice has at most SLICE_BYTES unless one row has more.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, values = column.buffers()
    n = len(column)
    if n == 0:
        return
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(places, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(ends, ends[low] + SLICE_BYTES, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, marks: bool = False, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """Hashes of the words of rows of text, and each row's offset among them.

    A-Z are lower-cased. Words are runs without white space, or with ``marks``
    runs without white space and ASCII punctuation. A word's hash is a
    polynomial of its bytes modulo 2**64, mixed; it depends on the word alone.
    For each of ``prefixes`` follow the hashes of the words' first so many bytes.
    """
    data = _LOWER[data]
    inside = ~(_MARKS if marks else _WHITE)[data]
    n = len(data)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    opens[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    heads = [np.empty(len(starts), dtype=np.uint64) for _ in prefixes]
    low = 0
    while low < len(starts):
        first = starts[low]
        high = int(np.searchsorted(ends, first + HASH_BYTES, side="right"))
        if high == low:  # one word of more than HASH_BYTES
            hashes[low] = _long_word(data[first : ends[low]])
            for head, size in zip(heads, prefixes):
                head[low] = _long_word(data[first : min(first + size, ends[low])])
            low += 1
            continue
        part = data[first : ends[high - 1]]
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _POWER[: len(part)], out=sums[1:])
        own = starts[low:high] - first
        hashes[low:high] = (sums[ends[low:high] - first] - sums[own]) * _INVERSE[own]
        for head, size in zip(heads, prefixes):
            cut = np.minimum(ends[low:high] - first, own + size)
            head[low:high] = (sums[cut] - sums[own]) * _INVERSE[own]
        low = high
    return mix(hashes), np.searchsorted(starts, offsets), *[mix(head) for head in heads]


def _long_word(data: np.ndarray) -> np.uint64:
    total, power = 0, 1
    for low in range(0, len(data), HASH_BYTES):
        part = data[low : low + HASH_BYTES]
        total += int(np.sum(_BYTE[part] * _POWER[: len(part)], dtype=np.uint64)) * power
        power = power * pow(_BASE, HASH_BYTES, 1 << 64) % (1 << 64)
    return np.uint64(total % (1 << 64))


def shingles(
    hashes: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside rows, and each row's offset among them.

    A row of fewer words, but any, has one: its whole sequence.
    """
    n_words = np.diff(offsets)
    n_own = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    places = np.concatenate([[0], np.cumsum(n_own)])
    row = np.repeat(np.arange(len(n_own)), n_own)
    first = np.arange(places[-1]) - places[row] + offsets[row]
    length = np.minimum(n_words, width)[row]
    runs = length.astype(np.uint64)
    for i in range(width):
        inside = i < length
        word = hashes[np.minimum(first + i, max(len(hashes) - 1, 0))] if len(hashes) else runs
        runs = np.where(inside, mix(runs * np.uint64(0x9E3779B97F4A7C15) + word), runs)
    return runs, places
