"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's byte 3- and 4-grams (A-Z lower-cased) are hashed to embedding rows;
their mean goes through a linear layer and a softmax. Embeddings and layer are
trained by stochastic gradient descent in numpy on the driver, from a bounded
sample of labelled texts. A part of the sample is held back to fit a
temperature, so that scores are probabilities, and the score under which a
prediction is marked as rejected. As mean and layer are both linear, scoring
adds up one row of (embeddings x layer) for each gram of the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .hashed_text import GRAMS, bag, dense, fold, gram_buckets, lowered, run_sums, sampled, softmax

BITS = 14
WIDTH = 16
TRAIN_PER_LANGUAGE = 400   # about; with whole texts
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray      # a row of language scores for each bucket
    bias: np.ndarray
    temperature: float
    reject_below: float


def text_bags(column: pa.Array, bits: int = BITS) -> list[tuple[bytes, bytes]]:
    out = []
    for i, j, data, offsets in lowered(column):
        grams = [gram_buckets(data, offsets, n, bits) for n in GRAMS]
        out += [bag(np.concatenate([b[at[t]:at[t + 1]] for b, at in grams])) for t in range(j - i)]
    return out


def train(bags: list[tuple[bytes, bytes]], labels: list[str], held: list[bool], bits: int = BITS, width: int = WIDTH,
          epochs: int = 12, rate: float = 40.0, batch: int = 32, wrong: float = 0.01, seed: int = 1) -> LanguageModel:
    """``held``: rows for calibration only. ``wrong``: most errors among predictions that aren't rejected."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    held = np.array(held, bool)
    if not (~held).any():
        held[:] = False
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (2 ** bits, width)).astype(np.float32)
    layer = rng.normal(0, 0.3, (width, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    fit = np.flatnonzero(~held)
    weight = 1 / np.maximum(np.bincount(y[fit], minlength=len(languages)), 1)
    weight = weight / weight[y[fit]].mean() if len(fit) else weight
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(fit)
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            x = dense([bags[r] for r in rows], bits)
            mean = x @ emb
            off = softmax(mean @ layer + bias)
            off[np.arange(len(rows)), y[rows]] -= 1
            off = (off * weight[y[rows], None] / len(rows)).astype(np.float32)
            back = off @ layer.T
            layer -= 0.1 * step * (mean.T @ off)
            bias -= 0.002 * step * off.sum(axis=0)
            emb -= step * (x.T @ back)
    logits = (emb @ layer).astype(np.float32)
    cal = np.flatnonzero(held) if held.any() else fit
    z = np.concatenate([dense([bags[r] for r in cal[a:a + 64]], bits) @ logits for a in range(0, len(cal), 64)]) + bias
    losses = {t: -np.log(softmax(z / t)[np.arange(len(cal)), y[cal]] + 1e-12).mean() for t in (0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0)}
    temperature = min(losses, key=losses.get)
    p = softmax(z / temperature)
    good = p.argmax(axis=1) == y[cal]
    order = np.argsort(-p.max(axis=1), kind="stable")
    errors = np.cumsum(~good[order]) / np.arange(1, len(order) + 1)
    ok = np.flatnonzero(errors <= wrong)
    reject = 0.0 if not len(ok) or ok[-1] == len(order) - 1 else float(p.max(axis=1)[order[ok[-1]]])
    return LanguageModel(languages, logits, bias, float(temperature), reject)


def predict(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probabilities of the languages, a row for each text."""
    bits = int(np.log2(len(model.logits)))
    total, count = 0, 0
    for n in GRAMS:
        found, at = gram_buckets(data, offsets, n, bits)
        total = total + run_sums(model.logits[found], at).astype(np.float64)
        count = count + np.diff(at)
    return softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any alphabet."""
    out = run_sums(((data >= 97) & (data <= 122) | (data >= 65) & (data <= 90)).astype(np.int64), offsets) > 0
    for t in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[t] = any(c.isalpha() for c in data[offsets[t]:offsets[t + 1]].tobytes().decode("utf-8", "replace"))
    return out


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  per_language: int = TRAIN_PER_LANGUAGE) -> LanguageModel | None:
    """A model from about ``per_language`` rows a language (those with text, language and id); None without any."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = rows.where("id is not null and text <> '' and lang is not null")
    return fit_sample(sampled(known, "lang", per_language, name="language-sample"))


def fit_sample(rows: DataFrame) -> LanguageModel | None:
    """A model from a small table of id, text and lang."""
    def run(batches):
        for batch in batches:
            bags = text_bags(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array([b for b, _ in bags], pa.binary()),
                                              pa.array([n for _, n in bags], pa.binary())], ["h", "lang", "held", "b", "n"])

    got = (rows.select(F.xxhash64("id", "text").alias("h"), "text", "lang", (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(5)) == 0).alias("held"))
           .mapInArrow(run, "h long, lang string, held boolean, b binary, n binary").collect())
    got.sort(key=lambda r: (r.h, r.lang, r.b))
    return train([(r.b, r.n) for r in got], [r.lang for r in got], [r.held for r in got]) if got else None


def identify_language(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (0 to 1) and rejected (the score is under the calibrated one).

    lang_pred is "und", score 0 and rejected true for a null text, a text
    without a letter, and without a model. Every gram of the whole text counts. Null and
    repeated ids pass through; other columns of ``docs`` are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches):
        m = LanguageModel(**held.value) if held.value else None
        for batch in batches:
            for i, j, data, offsets in lowered(batch.column(1)):
                letters = has_letter(data, offsets) if m else np.zeros(j - i, bool)
                p = predict(m, data, offsets) if m else np.zeros((j - i, 1))
                best = p.argmax(axis=1)
                score = np.where(letters, p.max(axis=1), 0.0)
                names = np.array([*(m.languages if m else []), UNKNOWN], object)[np.where(letters, best, -1)]
                reject = (score < m.reject_below) | ~letters if m else ~letters
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score),
                                                  pa.array(reject)], ["id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def learn_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_fold: int = 2) -> DataFrame:
    """``identify_language`` with a model from the rows whose id is not in the held-out fold, and held_out."""
    model = fit_languages(docs.where(fold(id_col, folds) != held_fold), id_col, text_col, lang_col)
    out = identify_language(docs, model, id_col, text_col)
    return out.select(id_col, F.coalesce(fold(id_col, folds) == held_fold, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
