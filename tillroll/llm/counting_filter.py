"""Counting quotient filters of packed word-id n-grams, as numpy arrays.

A key is 2 or 3 word ids of ``bits`` bits each. It is permuted first: lane 0 is
XORed with a function of the others, then each other lane with a function of
lane 0; both steps can be undone, and lane 0 spreads evenly. Its first bits name
the range that a filter is of, the next ones are the quotient, and all other bits
of all lanes are kept as the remainder, so no two keys are ever taken for one.

A filter holds its keys in order: a bit for each quotient that occurs, a bit for
each entry that ends its quotient's run, the remainders and the counters (a byte;
255 and more in a list behind). Merging is one pass over filters in order.
"""

from __future__ import annotations

import numpy as np

from .textvec import mix

_U = np.uint64
_ADD = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)]


def mask(bits: int) -> np.uint64:
    return _U(2 ** bits - 1)


def permute(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    rest = lanes[1:]
    head = lanes[0] ^ _fold(rest, bits)
    return [head, *[x ^ (mix(head + _ADD[i]) & mask(bits)) for i, x in enumerate(rest)]]


def restore(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    head = lanes[0]
    rest = [x ^ (mix(head + _ADD[i]) & mask(bits)) for i, x in enumerate(lanes[1:])]
    return [head ^ _fold(rest, bits), *rest]


def _fold(rest: list[np.ndarray], bits: int) -> np.ndarray:
    value = mix(rest[0] + _ADD[2])
    for x in rest[1:]:
        value = mix(value + mix(x + _ADD[1]))
    return value & mask(bits)


def summed(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order, with the sums of their counts. Sorted parts are merged, not sorted anew."""
    if not len(counts):
        return lanes, counts
    order = np.argsort(lanes[0], kind="stable")
    lanes = [x[order] for x in lanes]
    counts = counts[order]
    same = lanes[0][1:] == lanes[0][:-1]
    other = same & np.logical_or.reduce([x[1:] != x[:-1] for x in lanes[1:]])
    if other.any():  # different keys with one first lane: rare, put them in order by all lanes
        order = np.lexsort(lanes[::-1])
        lanes = [x[order] for x in lanes]
        counts = counts[order]
    first = np.ones(len(counts), bool)
    first[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])
    heads = np.flatnonzero(first)
    return [x[heads] for x in lanes], np.add.reduceat(counts, heads)


def _bytes(bits: int) -> int:
    return (bits + 7) // 8


def encode(lanes: list[np.ndarray], counts: np.ndarray, bits: int, ranged: int) -> bytes:
    """The filter of distinct permuted keys in order that agree in the first ``ranged`` bits."""
    n = len(counts)
    quotient_bits = min(max(n.bit_length() - 1, 0), bits - ranged)
    low = bits - ranged - quotient_bits
    quotient = ((lanes[0] >> _U(low)) & mask(quotient_bits)).astype(np.int64) if quotient_bits else np.zeros(n, np.int64)
    occupied = np.zeros(2 ** quotient_bits, bool)
    occupied[quotient] = True
    run_ends = np.ones(n, bool)
    run_ends[:-1] = quotient[1:] != quotient[:-1]
    parts = [np.array([quotient_bits, n], np.int64).tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_ends).tobytes()]
    for x, width in [(lanes[0] & mask(low), _bytes(low)), *[(x, _bytes(bits)) for x in lanes[1:]]]:
        parts.append(np.ascontiguousarray(x).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width].tobytes())
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()]
    return b"".join(parts)


def decode(blob: bytes, order: int, bits: int, ranged: int, of: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(permuted lanes in order, counts) of a filter of range number ``of``."""
    data = np.frombuffer(blob, np.uint8)
    quotient_bits, n = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    low = bits - ranged - quotient_bits
    at = 16

    def part(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return data[at - size:at]

    occupied = np.flatnonzero(np.unpackbits(part(_bytes(2 ** quotient_bits)), count=2 ** quotient_bits))
    ends = np.unpackbits(part(_bytes(n)), count=n).astype(np.int64)
    run = np.cumsum(ends) - ends
    lanes = []
    for i in range(order):
        width = _bytes(low) if i == 0 else _bytes(bits)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = part(n * width).reshape(n, width)
        lanes.append(wide.reshape(-1).view("<u8").astype(_U))
    head = (_U(of) << _U(quotient_bits)) | occupied[run].astype(_U)
    lanes[0] |= (head << _U(low)) if low < 64 else _U(0)
    counts = part(n).astype(np.int64)
    counts[counts == 255] = data[at:].view("<i8")
    return lanes, counts


def ranges(lanes: list[np.ndarray], bits: int, ranged: int) -> tuple[np.ndarray, np.ndarray]:
    """(range numbers, offsets) of keys in order."""
    of = (lanes[0] >> _U(bits - ranged)).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    return of[heads], np.r_[heads, len(of)]
