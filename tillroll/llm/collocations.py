"""Phrase collocations by counting quotient filters.

Texts are lower-cased (A-Z), split into pieces and words. All counts are per
language and exact:

1. words are counted by language. A word's id is a hash of both, of as few bits as
   keep all distinct (language, word) pairs apart, which Spark verifies over all of
   them (else more bits, at last another hash). So ids need no dictionary in tasks,
   and a first id tells the language.
2. each task counts the n-grams of 2 and 3 ids of its texts in counting quotient
   filters, cut into ranges of the permuted key, and sends them off; a range's
   filters from all tasks are merged in order. The permutation spreads keys
   evenly, and a frequent phrase is one entry of a task's filter, so no range is
   hot. n-grams with a word that is surely too rare for a candidate are left out
   by a bitmap of fixed size; it never drops a word that is frequent enough.
3. candidates meet the counts of their parts by joins on ids.

Memory: a task holds up to ENTRIES keys of each order; a range is sized to stay
within about that, whatever the input. The bitmap of 4 MB is all that is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import counting_filter as cf
from . import textvec as tv
from .util import staged

LEAST, TOP, SHARE = 10, 2000, 50
ENTRIES = 1 << 20
BITMAP_BITS = 25
PARTS = 32
PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
BREAKS = PIECE_ENDS | tv.SPACE
_U = np.uint64


def _bytes_order(seed: int) -> np.ndarray:
    """Lower-cased bytes, for another hash in another order."""
    return (np.random.RandomState(seed).permutation(256).astype(np.uint8) if seed else np.arange(256, dtype=np.uint8))[tv.LOWER]


def _slices(batch, seed: int, most: int = 4 * tv.SLICE_BYTES) -> Iterator[tuple]:
    """(bytes, start, end, id, text) of the words of each slice of a batch (lang, text)."""
    langs = batch.column(0).dictionary_encode()
    salts = np.array([int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in langs.dictionary.to_pylist()], _U)
    code = langs.indices.to_numpy(zero_copy_only=False)
    table = _bytes_order(seed)
    for i, j, data, offsets in tv.text_slices(batch.column(1), most):
        start, end, text = tv.word_spans(data, offsets, BREAKS)
        ids = tv.mix(tv.hash_spans(table[data], start, end) + salts[code[i:j]][text]) if len(start) else np.zeros(0, _U)
        yield data, start, end, ids, text, code[i:j][text] if len(start) else text, langs.dictionary


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """A string column of byte ranges."""
    size = end - start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    inside = np.arange(at[-1]) + np.repeat(start - at[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(tv.LOWER[data[inside]])))


def _agree(data: np.ndarray, start: np.ndarray, end: np.ndarray, code: np.ndarray, other: np.ndarray) -> bool:
    """Whether each word is, byte for byte and by language, the one numbered ``other``."""
    size = end - start
    if (size != size[other]).any() or (code != code[other]).any():
        return False
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    low = tv.LOWER[data]
    return bool((low[place + np.repeat(start, size)] == low[place + np.repeat(start[other], size)]).all())


def _word_counts(seed: int):
    def work(batches):
        for batch in batches:
            for data, start, end, ids, _, code, langs in _slices(batch, seed, tv.SLICE_BYTES):
                if len(ids):
                    one, first, of, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
                    if not _agree(data, start, end, code, first[of]):  # two words of one id: both must be seen
                        one, first, n = ids, np.arange(len(ids)), np.ones(len(ids), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pc.take(langs, pa.array(code[first])).cast(pa.string()), _spans(data, start[first], end[first]).cast(pa.string()),
                         pa.array(one.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "word", "id", "f"])
    return work


def count_words(texts: DataFrame) -> tuple[DataFrame, int, int]:
    """(lang, word, id, f) of ``texts`` (lang, text); the seed and the number of bits of the ids, no two of which agree."""
    for seed in range(8):
        rows = texts.mapInArrow(_word_counts(seed), "lang string, word string, id bigint, f bigint")
        words = staged(rows.groupBy("lang", "word").agg(F.max("id").alias("id"), F.sum("f").alias("f")), "phrase-words")
        least = 2 * max(words.count(), 1).bit_length()
        for bits in [b for b in (40, 48, 56, 64) if b >= least or b == 64]:
            cut = F.shiftrightunsigned("id", 64 - bits) if bits < 64 else F.col("id")
            if words.groupBy(cut.alias("id")).count().where("count > 1").isEmpty():
                return words.withColumn("id", cut), seed, bits
    raise RuntimeError("no hash keeps all words apart")


def _bitmap(words: DataFrame, bits: int) -> np.ndarray:
    """2 ** BITMAP_BITS bits: one is set for the first bits of each id."""
    at = F.shiftrightunsigned("id", bits - BITMAP_BITS) + 1
    rows = (words.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("n"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("b")).collect())
    out = np.zeros(2 ** BITMAP_BITS // 8 + 4096, np.uint8)
    for n, b in rows:
        out[(n - 1) * 4096:n * 4096] |= np.frombuffer(bytes(b), np.uint8)
    return out


def _piece(data: np.ndarray, start: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A number for each word that grows where a piece or a text ends before it."""
    ends = np.zeros(len(data) + 1, np.int64)
    np.cumsum(PIECE_ENDS[data], out=ends[1:])
    return ends[start] + text


def _gram_filters(seed: int, bits: int, ranged: int, frequent):
    def grams(batch) -> Iterator[tuple[int, list[np.ndarray]]]:
        held = frequent.value
        for data, start, _, ids, text, _, _ in _slices(batch, seed):
            piece = _piece(data, start, text)
            ids = ids >> _U(64 - bits)
            at = (ids >> _U(bits - BITMAP_BITS)).astype(np.int64)
            keep = ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
            pair = (piece[1:] == piece[:-1]) & keep[1:] & keep[:-1]
            i = np.flatnonzero(pair)
            yield 2, [ids[i], ids[i + 1]]
            i = np.flatnonzero(pair[1:] & pair[:-1])
            yield 3, [ids[i], ids[i + 1], ids[i + 2]]

    def rows(order: int, lanes: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        of, at = cf.ranges(lanes, bits, ranged)
        for k in range(0, len(of), 512):
            blobs = [cf.encode([x[a:b] for x in lanes], counts[a:b], bits, ranged) for a, b in zip(at[k:k + 512], at[k + 1:k + 513])]
            yield pa.RecordBatch.from_arrays([pa.array((of[k:k + 512] * 2 + order - 2).astype(np.int64)), pa.array(blobs, pa.binary())], names=["range", "filter"])

    def work(batches):
        held = {2: [], 3: []}
        for batch in batches:
            for order, lanes in grams(batch):
                if not len(lanes[0]):
                    continue
                parts = held[order]
                parts.append(cf.summed(cf.permute(lanes, bits), np.ones(len(lanes[0]), np.int64)))
                if sum(len(c) for _, c in parts) > 2 * ENTRIES:
                    parts[:] = [_merged(parts)]
                    if len(parts[0][1]) > ENTRIES:
                        yield from rows(order, *parts.pop())
        for order, parts in held.items():
            if parts:
                yield from rows(order, *_merged(parts))
    return work


def _merged(parts: list) -> tuple[list[np.ndarray], np.ndarray]:
    return cf.summed([np.concatenate(x) for x in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))


def _merge_ranges(bits: int, ranged: int, least: int):
    """Rows come sorted by range: each range's filters are merged, keys counted often enough go on."""
    def entries(key: int, parts: list) -> pa.RecordBatch:
        lanes, counts = _merged(parts)
        often = counts >= least
        ids = cf.restore([x[often] for x in lanes], bits)
        ids += [np.zeros(len(ids[0]), _U)] * (3 - len(ids))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids[0]), key % 2 + 2)), *[pa.array(x.view(np.int64)) for x in ids], pa.array(counts[often])],
                                          names=["words", "id1", "id2", "id3", "a"])

    def work(batches):
        key, parts, size = None, [], 0
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k != key:
                    if parts:
                        yield entries(key, parts)
                    key, parts, size = k, [], 0
                parts.append(cf.decode(blob.as_buffer(), k % 2 + 2, bits, ranged, k // 2))
                size += len(parts[-1][1])
                if size > 2 * ENTRIES:
                    parts = [_merged(parts)]
                    size = len(parts[0][1]) // 2  # the next merge comes after as much again
        if parts:
            yield entries(key, parts)
    return work


def count_phrases(texts: DataFrame, words: DataFrame, seed: int, bits: int, least: int = LEAST) -> DataFrame:
    """(words: 2 or 3, id1, id2, id3, a) of all phrases of ``texts`` (lang, text) that occur ``least`` times or more."""
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    ranged = min(max(12, (int(total) // ENTRIES).bit_length() + 1), 30)
    frequent = texts.sparkSession.sparkContext.broadcast(_bitmap(words.where(F.col("f") >= least), bits))
    filters = texts.mapInArrow(_gram_filters(seed, bits, ranged, frequent), "range bigint, filter binary")
    return filters.repartition("range").sortWithinPartitions("range").mapInArrow(
        _merge_ranges(bits, ranged, least), "words bigint, id1 bigint, id2 bigint, id3 bigint, a bigint")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    d = {x: f"CAST({x} AS DECIMAL(19,0))" for x in (a, left, right)}
    return F.expr(f"CAST((CAST(1000000 AS DECIMAL(7,0)) * ({d[a]} * {d[a]})) div ({d[left]} * {d[right]}) AS BIGINT)")


def mine_collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                      top: int = TOP, share: int = SHARE) -> DataFrame:
    """The first ``top`` phrases of 2 and 3 words of each language: lang, rank, phrase, a, l, r, n, score.

    a is how often the phrase occurs within pieces, l and r how often the two
    parts of its lowest-scoring cut do, n all words of the language. Phrases that
    occur fewer than ``least`` times are left out, and those inside a longer one
    that occurs at least ``share`` percent as often. Ranked by score and a, both
    falling, then phrase; ranks are unique, so ties have a fixed order. Null and
    empty texts count nothing; a null language is ``und``. Each row of ``docs``
    counts, repeated ones too; other columns don't matter. An empty table gives
    an empty one.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words, seed, bits = count_words(texts)
    grams = staged(count_phrases(texts, words, seed, bits, least), "phrase-counts")
    known = words.where(F.col("f") >= least)
    one = known.select(F.col("id").alias("id1"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    two = known.select(F.col("id").alias("id2"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    pairs = staged(grams.where("words = 2").drop("id3", "words").join(one, "id1").join(two, "id2"), "phrase-pairs")
    first = pairs.select("id1", "id2", "lang", "w1", "w2", "f1", F.col("a").alias("a12"))
    last = pairs.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("a").alias("a23"))
    triples = grams.where("words = 3").drop("words").join(first, ["id1", "id2"]).join(last, ["id2", "id3"])
    triples = triples.withColumns({"s1": score("a", "f1", "a23"), "s2": score("a", "a12", "f3")})
    triples = staged(triples, "phrase-triples")
    early = F.col("s1") <= F.col("s2")
    three = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"),
                           F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    inside = (triples.select("id1", "id2", "a").union(triples.select("id2", "id3", "a")).toDF("id1", "id2", "longer")
              .groupBy("id1", "id2").agg(F.max("longer").alias("longer")))
    two = pairs.join(inside, ["id1", "id2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("a", "f1", "f2").alias("score"))
    order = (F.col("score").desc(), F.col("a").desc(), "phrase")
    found = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    # The first of each part of a language, then of all: a task ranks PARTS * top phrases at most.
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
