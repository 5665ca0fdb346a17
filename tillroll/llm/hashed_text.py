"""Hashed features of whole texts, labelled samples of bounded size, and folds, for the trained models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .util import staged

_U = np.uint64
GRAMS = (3, 4)


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary") if isinstance(id_col, str) else id_col.cast("string").cast("binary")) % folds


def sampled(rows: DataFrame, by: str, most: int | dict, id_col: str = "id", name: str = "sample") -> DataFrame:
    """Of the rows with each value of ``by``, about ``most`` at most, chosen by the hash of
    their id: a share of them that shrinks as they grow, and the same rows each time. ``most`` may differ by value."""
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(by) == F.lit(value), F.lit(min(1.0, (most[value] if isinstance(most, dict) else most) / n))).otherwise(share)
    return staged(rows.where(F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(2 ** 24)) < share * 2 ** 24), name)


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U(64 - bits)).astype(np.int64)


def gram_buckets(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every run of n bytes inside a text, offsets of each text's runs)."""
    count = max(len(data) - n + 1, 0)
    code = np.full(count, n, np.uint64)
    for k in range(n):
        code = code * _U(257) + data[k:k + count]
    code = code * _U(0x9E3779B97F4A7C15)
    code = (code ^ (code >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    size = np.diff(offsets)
    inside = np.ones(count, bool)
    for k in range(1, n):  # runs that would go on into the next text
        past = offsets[1:] - k
        past = past[(past >= 0) & (past < count)]
        inside[past] = False
    at = np.zeros(len(offsets), np.int64)
    np.cumsum(np.maximum(size - n + 1, 0), out=at[1:])
    return buckets(code[inside], bits), at


def run_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums over runs given by offsets; an empty run is 0."""
    out = np.zeros((len(at) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.add.reduceat(values, at[:-1][full], axis=0)
    return out


def lowered(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) for slices of a text column, A-Z lower-cased."""
    for i, j, data, offsets in tv.text_slices(column):
        yield i, j, tv.LOWER[data], offsets


def bag(found: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct buckets and how often each occurs, as bytes."""
    b, n = np.unique(found, return_counts=True)
    return b.astype(np.uint32).tobytes(), n.astype(np.float32).tobytes()


def dense(bags: list[tuple[bytes, bytes]], bits: int) -> np.ndarray:
    """Shares of each bucket, a row for each bag."""
    out = np.zeros((len(bags), 2 ** bits), np.float32)
    for r, (b, n) in enumerate(bags):
        n = np.frombuffer(n, np.float32)
        if len(n):
            out[r, np.frombuffer(b, np.uint32)] = n / n.sum()
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
