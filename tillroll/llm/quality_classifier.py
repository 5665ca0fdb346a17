"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(s - t_k) with one score s for a text and ordered
thresholds t_0 < t_1 < ...: the grades share all weights. The score is the mean
weight of the text's hashed byte 3- and 4-grams plus the weights of a few
shape tokens (length, share of distinct words, share of repeated lines),
hashed into the same table. Training (numpy, on the driver) takes a bounded
sample of rated whole texts and maximises the ordinal likelihood; a part held
back calibrates the cut on the tail probability P(grade >= wanted).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .hashed_text import GRAMS, bag, dense, gram_buckets, run_sums, sampled, sigmoid
from .util import staged

_U = np.uint64
BITS = 15
TRAIN_PER_GRADE = 700   # about, with whole texts
LOST = 0.01             # share of calibration texts of the wanted grade that the cut may lose


@dataclass
class OrdinalModel:
    weights: np.ndarray     # by bucket
    shape: np.ndarray       # by shape token
    thresholds: np.ndarray  # one fewer than grades
    grades: list[int]
    wanted: int             # index of the lowest grade that is selected
    cut: float


def shape_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Three small numbers a text, each from 0 to 15 in its own range of 16: length, distinct words, repeated lines."""
    n = len(offsets) - 1
    words, of = tv.word_hashes(data, offsets)
    count = np.bincount(of, minlength=n)
    kinds = np.bincount(tv.distinct(words, of, n)[1], minlength=n)
    start, end, own = tv.word_spans(data, offsets, np.arange(256) == 10)
    hashes = tv.hash_spans(data, start, end)
    lines = np.bincount(own, minlength=n)
    line_kinds = np.bincount(tv.distinct(hashes, own, n)[1], minlength=n)
    return np.stack([np.minimum(np.log2(count + 1), 15).astype(np.int64),
                     16 + np.minimum(15 * kinds // np.maximum(count, 1), 15),
                     32 + np.minimum(15 * (lines - line_kinds) // np.maximum(lines, 1), 15)], axis=1)


def train(bags: list[tuple[bytes, bytes]], shapes: np.ndarray, grades: list[int], held: np.ndarray, wanted_from: int, bits: int = BITS,
          epochs: int = 10, rate: float = 0.03, batch: int = 32, lost: float = LOST, seed: int = 1) -> OrdinalModel:
    levels = sorted(set(grades))
    y = np.array([levels.index(g) for g in grades])
    rng = np.random.default_rng(seed)
    k = len(levels) - 1
    # The parameters: table, shape weights, first threshold and the logs of the gaps to the next ones.
    w, s = np.zeros(2 ** bits), np.zeros(48)
    low, gaps = np.zeros(1), np.zeros(max(k - 1, 0))
    params, sq = [w, s, low, gaps], [np.full(p.shape, 1e-8) for p in (w, s, low, gaps)]
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(y))
    weight = 1 / np.maximum(np.bincount(y[fit], minlength=k + 1), 1)
    weight = weight / weight[y[fit]].mean()

    def cuts() -> np.ndarray:
        return low[0] + np.r_[0, np.cumsum(np.exp(gaps))][:k]

    def score(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return 100 * (x @ w) + s[shapes[rows]].sum(axis=1)

    for epoch in range(epochs):
        order = rng.permutation(fit)
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            x = dense([bags[r] for r in rows], bits)
            t = np.r_[-np.inf, cuts(), np.inf]
            z = score(x, rows)
            up, down = sigmoid(t[y[rows] + 1] - z), sigmoid(t[y[rows]] - z)   # P(grade <= y), P(grade < y)
            p = np.maximum(up - down, 1e-9)
            du, dd = up * (1 - up), down * (1 - down)
            c = weight[y[rows]] / len(rows)
            dz = c * (du - dd) / p                                            # of the loss, by the score
            gt = np.zeros(k + 2)
            np.add.at(gt, y[rows] + 1, -c * du / p)
            np.add.at(gt, y[rows], c * dd / p)
            gt = gt[1:-1]
            ggap = np.array([gt[i + 1:].sum() * np.exp(gaps[i]) for i in range(k - 1)])
            gs = np.zeros(48)
            np.add.at(gs, shapes[rows].ravel(), np.repeat(dz, 3))
            for q, g in zip(range(4), (100 * (x.T @ dz), gs, np.array([gt.sum()]), ggap), strict=True):
                sq[q][...] = 0.95 * sq[q] + 0.05 * g * g
                params[q] -= rate * (1 - epoch / epochs) * (10 if q else 1) * g / (np.sqrt(sq[q]) + 1e-4)
    wanted = next((i for i, g in enumerate(levels) if g >= wanted_from), k)
    cal = np.flatnonzero(held) if held.any() else fit
    z = np.concatenate([score(dense([bags[r] for r in cal[a:a + 64]], bits), cal[a:a + 64]) for a in range(0, len(cal), 64)])
    tail = sigmoid(z - cuts()[wanted - 1]) if wanted else np.ones(len(z))
    good = np.sort(tail[y[cal] >= wanted])
    cut = min(0.5, float(good[int(lost * len(good))])) if len(good) else 0.5
    return OrdinalModel((100 * w).astype(np.float32), s, cuts(), levels, wanted, cut)


def _bags(data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    return [gram_buckets(data, offsets, n, bits) for n in GRAMS]


def fit_quality(rows: DataFrame, wanted_from: int = 1) -> OrdinalModel | None:
    """A model from a small table of id, text and grade (int); None without two grades."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in tv.text_slices(batch.column(1)):
                grams = _bags(data, offsets)
                bags = [bag(np.concatenate([b[at[t]:at[t + 1]] for b, at in grams])) for t in range(j - i)]
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in (batch.column(0), batch.column(2), batch.column(3))]
                                                 + [pa.array([b for b, _ in bags], pa.binary()), pa.array([n for _, n in bags], pa.binary()),
                                                    pa.array(shape_tokens(data, offsets).tolist(), pa.list_(pa.int64()))],
                                                 ["h", "grade", "held", "b", "n", "shape"])

    got = (rows.select(F.xxhash64("id", "text").alias("h"), "text", F.col("grade").cast("int").alias("grade"),
                       (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(4)) == 0).alias("held"))
           .mapInArrow(run, "h long, grade int, held boolean, b binary, n binary, shape array<long>").collect())
    got.sort(key=lambda r: (r.h, r.grade, r.b))
    if len({r.grade for r in got}) < 2:
        return None
    return train([(r.b, r.n) for r in got], np.array([r.shape for r in got]), [r.grade for r in got], np.array([r.held for r in got]), wanted_from)


def grade_quality(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, expected_grade, tail (P(grade >= the wanted one)) and kept (tail at the calibrated cut or more).

    Null and empty texts are graded by their shape tokens alone. Without a
    model expected_grade and tail are null and everything is kept. Null and repeated ids
    pass through; other columns of ``docs`` are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches):
        m = OrdinalModel(**held.value) if held.value else None
        for batch in batches:
            for i, j, data, offsets in tv.text_slices(batch.column(1)):
                if m:
                    total, count = np.zeros(j - i), np.zeros(j - i)
                    for found, at in _bags(data, offsets):
                        total += run_sums(m.weights[found], at)
                        count += np.diff(at)
                    z = total / np.maximum(count, 1) + m.shape[shape_tokens(data, offsets)].sum(axis=1)
                    over = sigmoid(z[:, None] - m.thresholds)
                    expected = pa.array(m.grades[0] + over @ np.diff(m.grades))
                    tail = over[:, m.wanted - 1] if m.wanted else np.ones(j - i)
                    tail, kept = pa.array(tail), pa.array(tail >= m.cut)
                else:
                    expected = tail = pa.nulls(j - i, pa.float64())
                    kept = pa.array(np.ones(j - i, bool))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), expected, tail, kept], ["id", "expected_grade", "tail", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, expected_grade double, tail double, kept boolean").withColumnRenamed("id", id_col)


def learn_and_grade(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", wanted_from: int = 1,
                    per_grade: int = TRAIN_PER_GRADE) -> DataFrame:
    """``grade_quality`` with a model from the rated rows. ``ratings`` has ``id_col`` and an integer grade
    (null: not rated); of several ratings of an id the lowest counts."""
    rated = (ratings.select(F.col(id_col).cast("long").alias("id"), F.col("grade").cast("int").alias("grade")).where("id is not null and grade is not null")
             .groupBy("id").agg(F.min("grade").alias("grade")))
    few = sampled(rated, "grade", per_grade, name="quality-ratings")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return grade_quality(docs, fit_quality(staged(texts.join(few, "id"), "quality-sample"), wanted_from), id_col, text_col)
