"""URL filters: rules, and a character language-model ratio for what no rule decides.

Two variable-order Markov models over bytes (A-Z lower-cased), one of URLs
that the rules allow and one of those they block, give each byte a probability
from contexts of 0 to ORDER bytes, interpolated with Witten-Bell weights. The
difference of the log-likelihoods over the length is the score; the cut comes
from rule-judged URLs that the models haven't seen.

Counting is a Spark aggregation over all rule-judged URLs: tasks count the
grams of their batches, then the counts are added up by gram. A context of up
to 5 bytes and its next byte fit in 64 bits, so no two grams share a count. The
counts are a Spark table that grows with the URLs; nothing of it is collected or
made a fixed size. URLs are scored in chunks: each chunk's distinct grams are
joined to the table, and the task that scores the chunk gets their counts. A
gram has a row a chunk, however many URLs have it, so common ones need no salt.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from . import textvec as tv
from .hashed_text import run_sums
from .util import staged

ORDER = 5
GRAM = 1 << 60  # set in the key of a context with its next byte
CHUNK_BYTES = 1_000_000  # URLs scored at once; a longer one is a chunk of its own
FOLDS = 5      # one part of the rule-judged URLs calibrates the cut
MISS = 0.01    # most of the allowed URLs that the cut may block there
BINS = 1000    # score steps a unit, for the cut

# Host and path of each rule.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) columns: both empty for a null or one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    upper = "".join(chr(c) for c in range(65, 91))
    return F.translate(F.regexp_extract(text, pattern, 1), upper, upper.lower()), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) columns of the longest rule that fits; null if none does."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        own, _, rest = rule.partition("/")
        fit = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        fits.append((fit, verdict, rule))
    none = F.lit(None).cast("string")
    pick = lambda k: reduce(lambda acc, f: F.when(f[0], F.lit(f[k])).otherwise(acc), reversed(fits), none)
    return pick(2), pick(1)


def gram_keys(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context key, gram key) at every byte: the ``order`` bytes before it, fewer at the start of a text, without and with it. Different ones have different keys."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    code = np.zeros(len(data), np.int64)
    for k in range(order, 0, -1):
        before = np.zeros(len(data), np.int64)
        before[k:] = data[:-k].astype(np.int64) + 1
        before[place < k] = 0
        code = code * 257 + before
    code += order << 41
    return code, code << 8 | data | GRAM


@dataclass
class Counts:
    """Of grams and contexts; blocked, allowed."""
    keys: np.ndarray   # in order; those left out count 0
    seen: np.ndarray   # (2, keys): how often it occurs
    kinds: np.ndarray  # (2, keys): how many different bytes follow a context

    @staticmethod
    def of(rows: pa.Table) -> Counts:
        """From rows of a model's table, possibly repeated."""
        keys, first = np.unique(rows["key"].to_numpy(), return_index=True)
        column = {c: np.r_[rows[c].to_numpy()[first].astype(np.float64), 0.0] for c in ("blocked", "allowed", "blocked_kinds", "allowed_kinds")}
        return Counts(np.r_[keys, np.iinfo(np.int64).max], np.array([column["blocked"], column["allowed"]]), np.array([column["blocked_kinds"], column["allowed_kinds"]]))

    def at(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; the last one, of counts 0, for one left out."""
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, at, len(self.keys) - 1)


@dataclass
class UrlModel:
    table: DataFrame  # key, blocked, allowed, blocked_kinds, allowed_kinds: of all grams and contexts that occur
    cut: float

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> Counts:
        """Of a few texts, on the driver."""
        wanted = self.table.sparkSession.createDataFrame(pa.table({"key": _keys(data, offsets)}))
        return Counts.of(self.table.join(wanted, "key").toArrow())


def _keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All that ``score`` looks up, once each."""
    return np.concatenate([np.unique(x) for order in range(ORDER + 1) for x in gram_keys(data, offsets, order)])


def score(model: UrlModel | Counts, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean log-likelihood difference a byte, allowed over blocked; 0 for an empty text."""
    counts = model.counts(data, offsets) if isinstance(model, UrlModel) else model
    p = np.full((2, len(data)), 1 / 256)
    for order in range(ORDER + 1):
        context, gram = (counts.at(x) for x in gram_keys(data, offsets, order))
        for c in (0, 1):
            seen, kinds = counts.seen[c][context], counts.kinds[c][context]
            p[c] = (counts.seen[c][gram] + kinds * p[c] + (seen == 0) * p[c]) / (seen + kinds + (seen == 0))
    total = run_sums(np.log(np.maximum(p[1], 1e-12)) - np.log(np.maximum(p[0], 1e-12)), offsets)
    return total / np.maximum(np.diff(offsets), 1)


def _counted(batches):
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j, data, offsets in tv.text_slices(batch.column(0)):
            data = tv.LOWER[data]
            own = np.repeat(label[i:j], np.diff(offsets))
            for order in range(ORDER + 1):
                keys, n = np.unique(gram_keys(data, offsets, order)[1] << 1 | own, return_counts=True)
                n = n.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(n * (1 - (keys & 1))), pa.array(n * (keys & 1))], ["key", "blocked", "allowed"])


def _count_table(judged: DataFrame) -> DataFrame:
    """``UrlModel.table`` from rows (url, label)."""
    grams = staged(judged.mapInArrow(_counted, "key long, blocked long, allowed long").groupBy("key")
                   .agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")), "url-grams")
    contexts = grams.groupBy(F.shiftright(F.col("key").bitwiseAND(GRAM - 1), 8).alias("key")).agg(
        F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"),
        F.count_if(F.col("blocked") > 0).alias("blocked_kinds"), F.count_if(F.col("allowed") > 0).alias("allowed_kinds"))
    none = F.lit(0).cast("long")
    return staged(grams.select("*", none.alias("blocked_kinds"), none.alias("allowed_kinds")).unionByName(contexts), "url-counts")


def fit_urls(judged: DataFrame, miss: float = MISS) -> UrlModel | None:
    """Models and cut from rows (url, allowed boolean); None unless both verdicts occur."""
    judged = judged.where("url <> ''").select("url", F.col("allowed").cast("int").alias("label"), (F.crc32(F.col("url").cast("binary")) % FOLDS == 0).alias("held"))
    counts = _count_table(judged.where("not held").select("url", "label"))
    empty = counts.where("key = 0").first()  # the context of no bytes, before every byte
    if not (empty and empty.blocked and empty.allowed):
        return None
    model = UrlModel(counts, 0.0)
    held = judged.where("held").select("url", "label")
    scored = _with_scores(held, model).select("label", F.round(F.greatest(F.least("score", F.lit(20.0)), F.lit(-20.0)) * BINS).cast("int").alias("bin"))
    bins = scored.groupBy("label", "bin").count().collect()
    hist = np.zeros((2, 40 * BINS + 2))
    for r in bins:
        hist[r.label, r.bin + 20 * BINS] += r["count"]
    good, bad = hist[1], hist[0]
    below = np.cumsum(good) - good                       # allowed ones under each cut
    rate = (np.cumsum(bad) - bad) / max(bad.sum(), 1) - below / max(good.sum(), 1)
    rate[below > miss * good.sum()] = -np.inf
    best = np.flatnonzero(rate >= rate.max() - 1e-12)
    model.cut = float(best[len(best) // 2] - 20 * BINS) / BINS
    return model


def _chunked(batches):
    """The rows (the text first) and their chunk; a chunk's rows follow each other."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        of = np.zeros(batch.num_rows, np.int64)
        for i, j in tv.slices(tv.utf8(batch.column(0))[1], CHUNK_BYTES):
            of[i:j] = chunk
            chunk += 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of)], [*batch.schema.names, "chunk"])


def _wanted(batches):
    """(chunk, key) of rows (text, chunk): twice where a batch ends inside a chunk."""
    for batch in batches:
        of = batch.column(1).to_numpy()
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
        for a, b in zip(starts, [*starts[1:], len(of)], strict=False):
            for _, _, data, offsets in tv.text_slices(batch.column(0).slice(a, b - a)):
                keys = _keys(tv.LOWER[data], offsets)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), of[a])), pa.array(keys)], ["chunk", "key"])


def _scored(rows: pa.Table, found: pa.Table) -> pa.Table:
    """A chunk's rows and their score, from the counts of its grams."""
    counts = Counts.of(found)
    parts = [score(counts, tv.LOWER[data], offsets) for _, _, data, offsets in tv.text_slices(rows.column(0))]
    return rows.drop_columns(["chunk"]).append_column("score", pa.array(np.concatenate(parts)))


def _with_scores(rows: DataFrame, model: UrlModel | None) -> DataFrame:
    """``rows`` (the text first) and their score."""
    if not model:
        return rows.withColumn("score", F.lit(0.0))
    chunked = staged(rows.mapInArrow(_chunked, StructType([*rows.schema, StructField("chunk", LongType())])), "url-chunks")
    # Spark takes the grams for smaller than their URLs, and files for as large as what they hold: either side would be broadcast, whatever its size.
    found = chunked.select(rows.columns[0], "chunk").mapInArrow(_wanted, "chunk long, key long").join(model.table.hint("merge"), "key")
    return chunked.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_scored, StructType([*rows.schema, StructField("score", DoubleType())]))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict (allow or block) and score.

    The longest fitting rule decides; without one, the language models do:
    allow if the score is at the cut or more. A null URL is scored as an empty one
    (score 0). If the rules allow or block nothing, there are no models: every
    score is 0 and what no rule fits is allowed. Null and repeated ids pass through; other
    columns of ``pages`` are not read.
    """
    url = F.col(url_col).cast("string")
    host, path = url_parts(url)
    rows = pages.select(F.coalesce(url, F.lit("")).alias("url"), F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    model = fit_urls(rows.where("ruled is not null").select("url", (F.col("ruled") == "allow").alias("allowed")))
    cut = F.lit(model.cut if model else 0.0)
    return _with_scores(rows, model).select(F.col("id").alias(id_col), "host", "path", "rule",
                                            F.coalesce("ruled", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score")
