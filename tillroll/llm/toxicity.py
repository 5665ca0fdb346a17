"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word (letters and digits, A-Z lower-cased) has two hashed embedding rows side
by side, its own and its stem's (its first STEM bytes), so that forms of a word that training
didn't see count too. Filters of several widths slide over the words; each keeps its largest
response in the whole text, and a logistic layer weighs these maxima. Training
uses every labelled whole text: tasks each take a part of the rows (numpy, Adam)
from the same start, Spark averages what they learned, and all go on from there once more; the
gradient runs through the winning windows only. A text's language is
predicted from the text, by counts of the grams of all these texts, and
the decision threshold is calibrated for each predicted language on all rows held
back from training (a quarter), drawn towards the common one where they are few: the score is the probability shifted so that 0.5 is that threshold.

Scoring looks up each word's response to each filter position in one table, so
a window's response is a sum of as many rows as the filter is wide.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir
from . import textvec as tv
from .hashed_text import GRAMS, buckets, fold, gram_buckets, lowered, sigmoid
from .language_id import UNKNOWN, LanguageModel, has_letter
from .language_id import predict as predict_language
from .util import id_filter, rows_in_filter, staged

_U = np.uint64
BITS = 16
DIM = 8                 # of each of the two embeddings
STEM = 6
WIDTHS = (1, 2, 3)
FILTERS = 8             # of each width
ROWS_PER_PART = 8_000   # about, that one task trains on in a round
PASSES = (4, 14)        # over all rows, least and most; few rows are seen oftener
ROUNDS = 2              # after each of which the parts' parameters are averaged
STEPS = 42_000          # rows, counted in each pass, beyond which the passes get fewer
BINS = 1000             # of a logit's unit, for the thresholds
LANGUAGE_BITS = 14
PULL = 20               # rows as which the common threshold counts in a language's own


@dataclass
class ToxicityModel:
    tables: list[np.ndarray]      # by width and place in the filter: (2, buckets, filters)
    bias: np.ndarray
    weights: np.ndarray
    out_bias: float
    thresholds: dict[str, float]  # by language, of the logit
    threshold: float              # of all languages together
    language: dict | None


def word_buckets(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, of its stem, offsets of each text's words)."""
    start, end, of = tv.word_spans(data, offsets, tv.PUNCTUATION)
    low = tv.LOWER[data]
    words, stems = tv.hash_spans(low, start, end), tv.hash_spans(low, start, np.minimum(end, start + STEM))
    return buckets(words, bits), buckets(tv.mix(stems + _U(99)), bits), tv.per_text(of, len(offsets) - 1)


def _text_max(response: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(largest response of each text's windows, -inf without one; windows of text t are at[t] to at[t + 1] - width)."""
    out = np.full((len(at) - 1, response.shape[1]), -np.inf, np.float32)
    size = np.diff(at) - width + 1
    full = np.flatnonzero(size > 0)
    if len(full):
        # Windows that run on into the next text are left out by reducing only [start, end) pairs.
        edges = np.empty(2 * len(full), np.int64)
        edges[0::2] = at[:-1][full]
        edges[1::2] = at[:-1][full] + size[full]
        padded = np.concatenate([response, np.full((1, response.shape[1]), -np.inf, np.float32)])
        out[full] = np.maximum.reduceat(padded, edges, axis=0)[0::2]
    return out, full


def start(bits: int = BITS, seed: int = 1) -> tuple[list[np.ndarray], float]:
    """Embeddings, filters, their biases and the output layer before training, and its bias."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.05, (2, 2 ** bits, DIM)).astype(np.float32)
    filters = {w: rng.normal(0, 0.3, (w, 2 * DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
    bias = {w: np.full(FILTERS, 0.05, np.float32) for w in WIDTHS}
    out = rng.normal(0.5, 0.2, len(WIDTHS) * FILTERS).astype(np.float32)
    out[1::2] *= -1
    return [emb, *filters.values(), *bias.values(), out], -1.0


def train(params: list[np.ndarray], out_bias: float, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float,
          epochs: int = 1, batch: int = 24, rate: float = 0.01, seed: int = 1) -> float:
    """Train ``params`` in place on (first buckets, second buckets) sequences and 0/1 labels, of which ``share``
    are 1 among all rows; the new bias."""
    rng = np.random.default_rng(seed)
    emb, out = params[0], params[-1]
    filters, bias = dict(zip(WIDTHS, params[1:], strict=False)), dict(zip(WIDTHS, params[1 + len(WIDTHS):], strict=False))
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    out_bias = np.float32(out_bias)
    weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)

    def adam(i: int, grad: np.ndarray, rows=None) -> None:
        p, m, v = (params[i], first[i], second[i]) if rows is None else (params[i][rows], first[i][rows], second[i][rows])
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        p = p - rate * m / (np.sqrt(v) + 1e-6)
        if rows is None:
            params[i][...], first[i][...], second[i][...] = p, m, v
        else:
            params[i][rows], first[i][rows], second[i][rows] = p, m, v

    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), batch):
            rows = order[a:a + batch]
            one = np.concatenate([docs[r][0] for r in rows])
            two = np.concatenate([docs[r][1] for r in rows])
            at = np.r_[0, np.cumsum([len(docs[r][0]) for r in rows])]
            x = np.concatenate([emb[0][one], emb[1][two]], axis=1)
            pooled, places = [], []
            for w in WIDTHS:
                n = len(x) - w + 1
                top = np.zeros((len(rows), FILTERS), np.float32)
                place = np.full((len(rows), FILTERS), -1)
                if n > 0:
                    r = sum(x[j:j + n] @ filters[w][j] for j in range(w)) + bias[w]
                    for d in range(len(rows)):
                        s = r[at[d]:at[d + 1] - w + 1]
                        if len(s):
                            k = s.argmax(axis=0)
                            top[d] = s[k, np.arange(FILTERS)]
                            place[d] = np.where(top[d] > 0, at[d] + k, -1)
                pooled.append(np.maximum(top, 0))
                places.append(place)
            h = np.concatenate(pooled, axis=1)
            p = sigmoid(h @ out + out_bias)
            off = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            back = off[:, None] * out
            out_bias -= rate * off.sum()
            adam(len(params) - 1, h.T @ off)
            grads: dict = {}
            for k, w in enumerate(WIDTHS):
                place, g = places[k], back[:, k * FILTERS:(k + 1) * FILTERS]
                d, f = np.nonzero(place >= 0)
                at_word, g = place[d, f], g[d, f]
                gf, gb = np.zeros_like(filters[w]), np.zeros(FILTERS, np.float32)
                np.add.at(gb, f, g)
                for j in range(w):
                    np.add.at(gf[j].T, f, g[:, None] * x[at_word + j])
                    gx = g[:, None] * filters[w][j].T[f]
                    for q, ids in ((0, one), (1, two)):
                        grads.setdefault(q, []).append((ids[at_word + j], gx[:, q * DIM:(q + 1) * DIM]))
                adam(1 + k, gf)
                adam(1 + len(WIDTHS) + k, gb)
            for q, parts in grads.items():
                ids, inverse = np.unique(np.concatenate([i for i, _ in parts]), return_inverse=True)
                total = np.zeros((len(ids), DIM), np.float32)
                np.add.at(total, inverse, np.concatenate([v for _, v in parts]))
                adam(0, total, (q, ids))
    return float(out_bias)


def network(params: list[np.ndarray], out_bias: float) -> tuple:
    """What ``logits`` needs of trained parameters."""
    emb, filters = params[0], params[1:1 + len(WIDTHS)]
    tables = [np.stack([emb[0] @ f[j][:DIM], emb[1] @ f[j][DIM:]]) for w, f in zip(WIDTHS, filters, strict=True) for j in range(w)]
    return tables, np.concatenate(params[1 + len(WIDTHS):-1]), params[-1], out_bias


def logits(tables: list[np.ndarray], bias: np.ndarray, weights: np.ndarray, out_bias: float,
           one: np.ndarray, two: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The network's output for texts of word buckets given by offsets."""
    pooled, k = [], 0
    for i, w in enumerate(WIDTHS):
        n = max(len(one) - w + 1, 0)
        response = np.zeros((n, FILTERS), np.float32)
        for j in range(w):
            response += tables[k][0][one[j:j + n]]
            response += tables[k][1][two[j:j + n]]
            k += 1
        top, _ = _text_max(response + bias[i * FILTERS:(i + 1) * FILTERS], at, w)
        pooled.append(np.maximum(top, 0))
    return (np.concatenate(pooled, axis=1) @ weights + out_bias).astype(np.float64)


def _threshold(z: np.ndarray, ones: np.ndarray, rows: np.ndarray) -> float:
    """The logit cut with the best F1, in the middle of its gap, from the toxic rows and all rows at each logit."""
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(ones[order])
    f1 = 2 * hits / (np.cumsum(rows[order]) + ones.sum())
    k = int(f1.argmax())
    low = z[order[k + 1]] if k + 1 < len(z) else z[order[k]] - 1
    return float((z[order[k]] + low) / 2)


def _vectors(params: list[np.ndarray], out_bias: float) -> np.ndarray:
    """The parameters but the embeddings, as rows of DIM numbers."""
    flat = np.concatenate([*(p.ravel() for p in params[1:]), [out_bias]])
    return np.concatenate([flat, np.zeros(-len(flat) % DIM)]).reshape(-1, DIM)


def _train_round(rows: DataFrame, params: list[np.ndarray], out_bias: float, share: float, epochs: int, seed: int) -> tuple[list[np.ndarray], float]:
    """Every part of the rows trains from the same parameters; the mean of what they come to, an embedding's over the parts that have its word."""
    held, size = rows.sparkSession.sparkContext.broadcast((params, out_bias)), params[0].shape[1]
    kind = ", ".join(["at int", *(f"v{i} float" for i in range(DIM))])

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("h", "ascending"), ("label", "ascending"), ("id", "ascending")])
        docs = []
        for chunk in part.column("text").chunks:
            for i, j, data, offsets in tv.text_slices(chunk):
                one, two, at = word_buckets(data, offsets)
                docs += [(one[at[t]:at[t + 1]].astype(np.uint32), two[at[t]:at[t + 1]].astype(np.uint32)) for t in range(j - i)]
        mine = [p.copy() for p in held.value[0]]
        end = train(mine, held.value[1], docs, part.column("label").to_numpy(), share, epochs, seed=seed)
        seen = [np.unique(np.concatenate([d[q] for d in docs])).astype(np.int64) for q in (0, 1)]
        rest = _vectors(mine, end)
        at = np.concatenate([seen[0], seen[1] + size, 2 * size + np.arange(len(rest))])
        values = np.concatenate([mine[0][0][seen[0]], mine[0][1][seen[1]], rest]).astype(np.float32)
        return pa.table([pa.array(at, pa.int32()), *(pa.array(values[:, i].copy()) for i in range(DIM))], ["at", *(f"v{i}" for i in range(DIM))])

    found = rows.groupBy("part").applyInArrow(run, kind).groupBy("at").agg(*[F.avg(f"v{i}").alias(f"v{i}") for i in range(DIM)]).toArrow()
    at = found.column("at").to_numpy()
    values = np.stack([found.column(f"v{i}").to_numpy() for i in range(DIM)], axis=1)
    emb = params[0].reshape(2 * size, DIM).copy()
    word = at < 2 * size
    emb[at[word]] = values[word]
    flat = np.zeros((len(_vectors(params, out_bias)), DIM))
    flat[at[~word] - 2 * size] = values[~word]
    new, k, flat = [emb.reshape(params[0].shape)], 0, flat.ravel()
    for p in params[1:]:
        new.append(flat[k:k + p.size].reshape(p.shape).astype(np.float32))
        k += p.size
    return new, float(np.float32(flat[k]))


def _count_languages(rows: DataFrame) -> LanguageModel | None:
    """Languages told by the grams of all texts that name theirs (naive Bayes); None without any."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for i, j, data, offsets in lowered(batch.column(0)):
                for n in GRAMS:
                    found, at = gram_buckets(data, offsets, n, LANGUAGE_BITS)
                    of = np.repeat(np.arange(j - i), np.diff(at))
                    own = np.array(names[i:j], object)
                    for name in set(names[i:j]):
                        here = np.bincount(found[(own == name)[of]], minlength=2 ** LANGUAGE_BITS)
                        counts[name] = counts.get(name, 0) + here
        for name, n in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(n), pa.string()), pa.array(np.arange(len(n)), pa.int32()), pa.array(n, pa.int64())], ["lang", "b", "n"])

    found = rows.where("lang is not null").select("text", "lang").mapInArrow(run, "lang string, b int, n long").groupBy("lang", "b").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    if not names:
        return None
    counts = np.zeros((2 ** LANGUAGE_BITS, len(names)))
    of = np.array([names.index(x) for x in found.column("lang").to_pylist()])
    counts[found.column("b").to_numpy(), of] = found.column("n").to_numpy()
    share = (counts + 0.5) / (counts + 0.5).sum(axis=0)
    return LanguageModel(names, np.log(share).astype(np.float32), np.zeros(len(names), np.float32), 0.1, 0.0)


def _guessed(language: LanguageModel | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of each text's language; the number of languages where there is no letter."""
    if not language:
        return np.zeros(len(offsets) - 1, np.int64)
    low = tv.LOWER[data]
    return np.where(has_letter(low, offsets), predict_language(language, low, offsets).argmax(axis=1), len(language.languages))


def _in_parts(texts: DataFrame, graded: DataFrame, parts: int, name: str) -> DataFrame:
    """The rows of ``texts`` with a label, as a table in buckets by part: texts move to their label and their part at once,
    and what is grouped by part later doesn't move them again."""
    buckets = 4 * parts  # so that few parts share one
    left = texts.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int"))
    right = graded.select("id", "label", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int").alias("part")).distinct()
    schema = left.withColumn("label", F.lit(0)).schema

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        ids, at = known.column("id").to_numpy(), rows.column("id").to_numpy()
        order = np.argsort(ids)
        if not len(order):
            return rows.slice(0, 0).append_column("label", pa.array([], pa.int32()))
        place = order[np.minimum(np.searchsorted(ids, at, sorter=order), len(order) - 1)]
        found = ids[place] == at
        return rows.filter(pa.array(found)).append_column("label", pa.array(known.column("label").to_numpy()[place[found]], pa.int32()))

    dealt = left.repartition(buckets, "part").groupBy("part").cogroup(right.repartition(buckets, "part").groupBy("part")).applyInArrow(run, schema)
    dealt.write.bucketBy(buckets, "part").format("parquet").option("path", fresh_dir(texts.sparkSession, "llm-toxicity-graded")).saveAsTable(name)
    return texts.sparkSession.table(name)


def fit_toxicity(texts: DataFrame, graded: DataFrame, rows_per_part: int = ROWS_PER_PART) -> ToxicityModel | None:
    """A model from all rows of a table of id, text and lang whose id is in ``graded`` (id, once each, and label, 0 or 1);
    None unless both labels occur.

    The driver gets the averaged parameters and counts, whose sizes are fixed, never rows.
    """
    texts = texts.where("id is not null").select("id", F.xxhash64("id", "text").alias("h"), "text", "lang", (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(4)) == 0).alias("held"))
    graded = staged(texts.select("id", "h", "held").join(graded.select("id", F.col("label").cast("int").alias("label")), "id"), "toxicity-labels")
    n = {(h, y): 0 for h in (False, True) for y in (0, 1)} | {tuple(r[:2]): r[2] for r in graded.groupBy("held", "label").count().collect()}
    if not (n[False, 0] + n[True, 0] and n[False, 1] + n[True, 1]):
        return None
    apart = all(n.values())
    if apart:
        n = {k: v for k, v in n.items() if not k[0]}
    size, toxic = sum(n.values()), sum(v for (_, y), v in n.items() if y)
    parts = -(-size // rows_per_part)
    passes = min(max(-(-STEPS // size), PASSES[0]), PASSES[1])
    name = f"tillroll_toxicity_{uuid.uuid4().hex[:12]}"
    try:
        rows = _in_parts(texts, graded, parts, name)
        return _fitted(rows, rows.where("not held") if apart else rows, rows.where("held") if apart else rows, parts, passes, toxic / size)
    finally:
        texts.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def _fitted(rows: DataFrame, fit: DataFrame, cal: DataFrame, parts: int, passes: int, share: float) -> ToxicityModel:
    """A model of rows to train on and to calibrate with; the languages are those of all rows."""
    fit = fit.drop("held", "lang")
    params, bias = start()
    rounds = 1 if parts == 1 else ROUNDS
    for k in range(rounds):
        params, bias = _train_round(fit, params, bias, share, passes // rounds, k + 1)
    net = network(params, bias)

    language = _count_languages(rows)
    tested = rows.sparkSession.sparkContext.broadcast((net, vars(language) if language else None))

    def run(batches):
        net, held = tested.value
        language = LanguageModel(**held) if held else None
        for batch in batches:
            for i, j, data, offsets in tv.text_slices(batch.column(0)):
                z = np.floor(np.clip(logits(*net, *word_buckets(data, offsets)), -40, 40) * BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(_guessed(language, data, offsets)), pa.array(z), batch.column(1).slice(i, j - i)], ["guess", "z", "label"])

    bins = (cal.select("text", "label").mapInArrow(run, "guess long, z long, label int").groupBy("guess", "z")
            .agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).orderBy("guess", "z").toArrow())
    guess, z, ones, count = (bins.column(c).to_numpy() for c in ("guess", "z", "ones", "n"))
    z = (z + 0.5) / BINS

    def threshold(own: np.ndarray) -> float:
        at, inverse = np.unique(z[own], return_inverse=True)
        return _threshold(at, np.bincount(inverse, ones[own]), np.bincount(inverse, count[own]))

    common, thresholds = threshold(guess >= 0), {}
    for i, name in enumerate([*language.languages, UNKNOWN] if language else []):
        # A language's own cut counts by its toxic rows, against that of all languages as PULL rows.
        toxic = int(ones[guess == i].sum())
        if toxic:
            thresholds[name] = (toxic * threshold(guess == i) + PULL * common) / (toxic + PULL)
    return ToxicityModel(*net, thresholds, common, vars(language) if language else None)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1, higher: likelier toxic) and predicted (1 if score >= 0.5).

    Only the text counts. Null and empty texts are scored as texts without a
    word; without a model every score is 0. Null and repeated ids pass through;
    other columns of ``docs`` are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def run(batches):
        m = ToxicityModel(**held.value) if held.value else None
        language = LanguageModel(**m.language) if m and m.language else None
        for batch in batches:
            for i, j, data, offsets in tv.text_slices(batch.column(1)):
                score = np.zeros(j - i)
                if m:
                    z = logits(m.tables, m.bias, m.weights, m.out_bias, *word_buckets(data, offsets))
                    cut = np.full(j - i, m.threshold)
                    if language and m.thresholds:
                        low = tv.LOWER[data]
                        cuts = np.array([m.thresholds.get(x, m.threshold) for x in language.languages])
                        cut = np.where(has_letter(low, offsets), cuts[predict_language(language, low, offsets).argmax(axis=1)], cut)
                    score = sigmoid(z - cut)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                                 ["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double, predicted int").withColumnRenamed("id", id_col)


def _shares(counts: dict[tuple[str, int], int], per_class: int) -> dict[str, int]:
    """How many rows to take of each kind (language and label), so that each label's come to ``per_class`` at most
    and no language gets less than another while it has more."""
    out = {}
    for label in {x for _, x in counts}:
        left, todo = per_class, sorted((n, kind) for (kind, x), n in counts.items() if x == label)
        for i, (n, kind) in enumerate(todo):
            out[kind] = min(n, max(left // (len(todo) - i), 1))
            left -= out[kind]
    return out


def learn_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    folds: int = 5, held_fold: int = 0, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``score_toxicity`` with a model from all labelled rows whose id is not in the held-out fold, and held_out.

    ``labels`` has ``id_col`` and toxic (0, 1 or null); of several labels of an id the highest counts.
    """
    graded = (labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("label")).where("id is not null and label in (0, 1)")
              .groupBy("id").agg(F.max("label").alias("label")).where(fold("id", folds) != held_fold))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # Only texts that may have a label are moved, by a bitmap of about 8 bits a label or more.
    graded = staged(graded, "toxicity-graded-ids")
    bits = min(max((8 * graded.count()).bit_length(), 23), 27)
    texts = rows_in_filter(texts, "id", id_filter(graded, "id", bits), bits)
    model = fit_toxicity(texts, graded, rows_per_part)
    out = score_toxicity(docs, model, id_col, text_col)
    return out.select(id_col, F.coalesce(fold(id_col, folds) == held_fold, F.lit(False)).alias("held_out"), "score", "predicted")
