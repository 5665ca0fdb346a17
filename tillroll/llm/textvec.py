"""Words, hashes and shingles of whole Arrow string columns, with numpy.

Every function works on the UTF-8 bytes of many texts at once. A word is a
run of bytes other than 0x20 and 0x09 to 0x0D, so no multi-byte character is
ever cut. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything of ASCII but letters and digits, for words without punctuation.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (splitmix finaliser); a bijection."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_STEP = _U(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; text i is bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets from 0) for ranges of texts of a column."""
    data, offsets = utf8(column)
    for i, j in slices(offsets, most):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every word, in order."""
    inside = ~breaks[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and don't overlap, none is empty."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    inside = np.arange(at[-1]) - np.repeat(at[:-1], size)
    value = _BYTE[data[inside + np.repeat(start, size)]] * _powers(int(size.max()))[inside]
    return mix(np.add.reduceat(value, at[:-1]) + size.astype(np.uint64) * _U(0xA24BAED4963EE407))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word; ``lower`` lower-cases A-Z only."""
    start, end, text = word_spans(data, offsets, breaks)
    return hash_spans(LOWER[data] if lower else data, start, end), text


_PLACE = mix(np.arange(100, 164, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def shingles(words: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every run of k words; a text of fewer words gives its whole sequence as one."""
    n = len(words)
    if not n:
        return words, text
    full = max(n - k + 1, 0)
    value = np.zeros(full, np.uint64)
    for j in range(k):
        value += words[j:j + full] * _PLACE[j]
    whole = text[:full] == text[k - 1:k - 1 + full]
    out, of = mix(value[whole] + _U(k)), text[:full][whole]
    starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    size = np.diff(np.r_[starts, n])
    short = size < k
    if short.any():
        place = np.arange(n) - np.repeat(starts, size)
        value = np.add.reduceat(words * _PLACE[np.minimum(place, 63)], starts)[short]
        out = np.r_[out, mix(value + size[short].astype(np.uint64))]
        of = np.r_[of, text[starts[short]]]
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def distinct(values: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text. The upper bits of a value that the number
    of texts leaves free are compared: 64 for one text, 54 for a thousand."""
    bits = max(int(texts - 1).bit_length(), 0)
    if bits:
        keys = (text.astype(np.uint64) << _U(64 - bits)) | (values >> _U(bits))
    else:
        keys = values
    order = np.argsort(keys)
    keys = keys[order]
    keep = np.ones(len(keys), bool)
    keep[1:] = keys[1:] != keys[:-1]
    order = order[keep]
    return values[order], text[order]


def per_text(text: np.ndarray, texts: int) -> np.ndarray:
    """Offsets of each text's run in an array ordered by text."""
    return np.searchsorted(text, np.arange(texts + 1))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of runs given by offsets; an empty run is 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), values.dtype)
    np.cumsum(values, axis=0, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
