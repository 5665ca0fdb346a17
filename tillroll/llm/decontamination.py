"""Benchmark decontamination: SimHash windows, then exact weighted shingles.

A benchmark item of n words is fingerprinted over windows of item size: w words at its
start and end (and, beyond the longest window, every w words), w the largest
size of a geometric ladder that n holds; and over short windows of its parts. Every
window of these sizes of every document gets the same 64-bit SimHash of its words, so
each document word starts one window per size that some item uses. Fingerprints are
cut into radius + 1 blocks; two that differ in at most radius bits agree in one block,
so block tables find all of them. The radius is ``radius`` bits, for windows of up to SHORT words
SHORT_RADIUS.

Shingles are runs of five words, weighted 1 + log of the item count over the
number of items with the shingle. An item's parts are windows of five words, on its
heaviest shingles, until the others weigh less than ``share`` of it: a region that holds ``share`` of
the item has one of these unedited, at distance 0, so no copy is missed, wherever
its edits are. Item-sized windows alone miss copies with many small edits.

Around the windows found the text is compared exactly: the largest share of
the item's weight within any region of the item's length plus a tenth at both ends.

Words are runs of letters and digits, A-Z lower-cased; characters outside ASCII belong to words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from . import textvec as tv
from .util import staged

_U = np.uint64
SHINGLE = 5
RADIUS = 5
SHORT, SHORT_RADIUS = 8, 1
LONGEST = 240  # words of a window: counts of set bits stay within a byte
MARK_BITS = 20
BLOCK_BYTES = 8_000_000  # benchmark text indexed at once
_ONES = _U(0x0101010101010101)
FOUND = ArrayType(StructType([StructField("item_id", LongType()), StructField("similarity", DoubleType())]))


def ladder() -> list[int]:
    out = [1]
    while out[-1] < LONGEST:
        out.append(min(max(out[-1] + 1, out[-1] * 6 // 5), LONGEST))
    return out


def bit_sums(words: np.ndarray) -> list[np.ndarray]:
    """Running sums of the words' bits, a byte for each; sums wrap, differences of up to 255 words don't."""
    out = []
    for k in range(8):
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum((words >> _U(k)) & _ONES, out=total[1:])
        out.append(total)
    return out


def simhash(sums: list[np.ndarray], w: int) -> np.ndarray:
    """The fingerprint of every window of w words: a bit is set if more than half of the words have it."""
    n = len(sums[0]) - 1
    out = np.zeros(max(n - w + 1, 0), np.uint64)
    if n >= w:
        more = _ONES * _U(127 - w // 2)
        for k, total in enumerate(sums):
            out |= (((total[w:] - total[:-w] + more) >> _U(7)) & _ONES) << _U(k)
    return out


@dataclass
class Index:
    """Of one block of benchmark items."""
    words: list[np.ndarray]
    shingles: list[tuple[np.ndarray, np.ndarray]]  # by item: its shingles in order, and their weights
    item_ids: np.ndarray
    windows: dict[int, tuple]         # by size: fingerprints, items, offsets, radius, tables of the blocks


def _cuts(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of the blocks."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def _parts(words: np.ndarray, shingles: np.ndarray, weights: np.ndarray, share: float) -> list[int]:
    """Where the item's heaviest shingles begin: so many that the others weigh less than ``share`` of all."""
    order = np.argsort(-weights, kind="stable")
    rest = weights.sum() - np.cumsum(weights[order])
    enough = np.flatnonzero(rest < share * weights.sum() * (1 - 1e-9))
    chosen = np.sort(shingles[order[:enough[0] + 1 if len(enough) else len(order)]])
    runs = tv.shingles(words, np.zeros(len(words), np.int64), SHINGLE)[0]
    at = np.minimum(np.searchsorted(chosen, runs), len(chosen) - 1)
    return np.flatnonzero(chosen[at] == runs).tolist()


def _own_shingles(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, distinct shingles) of every text."""
    data, offsets = tv.utf8(texts)
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    words, of = tv.word_hashes(data, offsets, breaks=tv.PUNCTUATION)
    at = tv.per_text(of, len(texts))
    for i in range(len(texts)):
        own = words[at[i]:at[i + 1]]
        yield own, np.unique(tv.shingles(own, np.zeros(len(own), np.int64), SHINGLE)[0])


def _shingle_rows(batches):
    """(part, shingle) of rows (text, part): the distinct shingles of each."""
    for batch in batches:
        sets = [x for _, x in _own_shingles(batch.column(0))]
        part = np.repeat(batch.column(1).to_numpy(), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], ["part", "shingle"])


def build_index(item_ids: list[int], texts: list[str], radius: int = RADIUS, share: float = 0.8, common: dict[int, int] | None = None, total: int = 0) -> Index:
    """Weights follow the counts of these items, or ``common``: of ``total`` items, how many have each shingle that more than one has."""
    parts = list(_own_shingles(pa.array(texts, pa.string())))
    own, sets = [w for w, _ in parts], [x for _, x in parts]
    if common is None:
        common, total = Counter(s for x in sets for s in x.tolist()), len(texts)
    weights = [1 + np.log(total / np.array([common.get(s, 1) for s in x.tolist()], float)) for x in sets]
    sizes: dict[int, list] = {}
    steps = ladder()
    for i, w in enumerate(own):
        n = len(w)
        if n:
            size = max(s for s in steps if s <= n)
            sums = bit_sums(w)
            for off in sorted({*range(0, n - size + 1, size), n - size}):
                sizes.setdefault(size, []).append((simhash([x[off:off + size + 1] for x in sums], size)[0], i, off))
            if n >= SHINGLE:
                prints = simhash(sums, SHINGLE)
                sizes.setdefault(SHINGLE, []).extend((prints[off], i, off) for off in _parts(w, sets[i], weights[i], share))
    windows = {}
    for size, rows in sizes.items():
        prints = np.array([r[0] for r in rows], np.uint64)
        near = radius if size > SHORT else min(radius, SHORT_RADIUS)
        tables = []
        for shift, mask in _cuts(near):
            block = (prints >> _U(shift)) & _U(mask)
            order = np.argsort(block, kind="stable")
            low = max(mask.bit_length() - MARK_BITS, 0)  # a mark for the upper bits of each block that occurs
            marks = np.zeros(2 ** min(mask.bit_length(), MARK_BITS), bool)
            marks[block >> _U(low)] = True
            tables.append((shift, mask, low, marks, order, block[order]))
        windows[size] = (prints, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), near, tables)
    return Index(own, list(zip(sets, weights, strict=True)), np.array(item_ids, np.int64), windows)


def _near_windows(index: Index, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, entry) of all pairs within the size's radius, possibly repeated."""
    entries, _, _, radius, tables = index.windows[size]
    windows, found = [], []
    for shift, mask, low, marks, order, blocks in tables:
        block = (prints >> _U(shift)) & _U(mask)
        hit = np.flatnonzero(marks[block >> _U(low)])
        first = np.searchsorted(blocks, block[hit], "left")
        count = np.searchsorted(blocks, block[hit], "right") - first
        total = np.r_[0, np.cumsum(count)]
        w = np.repeat(hit, count)
        e = order[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        near = np.bitwise_count(prints[w] ^ entries[e]) <= radius
        windows.append(w[near])
        found.append(e[near])
    return np.concatenate(windows), np.concatenate(found)


def _contained(index: Index, item: int, words: np.ndarray, shingles: np.ndarray, first: int, end: int, hits: np.ndarray, share: float) -> float:
    """The largest share of the item's weight within a region of words ``first`` to ``end`` that has one of
    ``hits`` (in order); 0 if it's under ``share``. A region is a tenth longer than the item at both ends."""
    mine, n = index.words[item], len(index.words[item])
    if n < SHINGLE:
        return float(any((words[x:x + n] == mine).all() for x in hits.tolist() if x + n <= end))
    own, weights = index.shingles[item]
    whole = math.fsum(weights)
    span = n + 2 * max(1, n // 10) - SHINGLE  # from the first shingle of a region to its last
    best = 0.0
    apart = np.flatnonzero(np.diff(hits) > 2 * span) + 1
    for near in np.split(hits, apart):
        a, b = max(int(near[0]) - span, first), min(int(near[-1]) + span, end - SHINGLE) + 1
        here = shingles[a:max(b, a)]
        at = np.minimum(np.searchsorted(own, here), len(own) - 1)
        place = np.flatnonzero(own[at] == here)
        at = at[place]
        if math.fsum(weights[np.unique(at)]) / whole < max(share, best):
            continue
        place, kind, weight = place.tolist(), at.tolist(), weights.tolist()
        times, held, most, i, region = Counter(), 0.0, -1.0, 0, (0, 0)
        for j, k in enumerate(kind):
            if not times[k]:
                held += weight[k]
            times[k] += 1
            while place[j] - place[i] > span:
                times[kind[i]] -= 1
                if not times[kind[i]]:
                    held -= weight[kind[i]]
                i += 1
            if held > most:
                most, region = held, (i, j + 1)
        best = max(best, math.fsum(weights[np.unique(at[slice(*region)])]) / whole)
    return best if best >= share else 0.0


def matches(index: Index, data: np.ndarray, offsets: np.ndarray, share: float) -> Iterator[tuple[int, int, float]]:
    """(text, item, similarity) for every item that a text holds to ``share`` or more."""
    words, of = tv.word_hashes(data, offsets, breaks=tv.PUNCTUATION)
    at = tv.per_text(of, len(offsets) - 1)
    # The shingle at each word; runs over the end of a text are never inside a region.
    shingles = tv.shingles(words, np.zeros(len(words), np.int64), SHINGLE)[0] if len(words) >= SHINGLE else words[:0]
    sums = bit_sums(words)
    places, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size, (_, items, *_) in index.windows.items():
        prints = simhash(sums, size)
        inside = np.flatnonzero(of[:len(prints)] == of[size - 1:size - 1 + len(prints)])
        w, e = _near_windows(index, size, prints[inside])
        places.append(inside[w])
        held.append(items[e])
    place, item = np.concatenate(places), np.concatenate(held)
    order = np.lexsort((place, item, of[place]))
    place, item = place[order], item[order]
    text = of[place]
    new = np.ones(len(place), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
    starts = np.flatnonzero(new)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(place)], strict=False):
        t, i = int(text[a]), int(item[a])
        sim = _contained(index, i, words, shingles, int(at[t]), int(at[t + 1]), place[a:b], share)
        if sim:
            yield t, i, sim


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", radius: int = RADIUS, share: float = 0.8) -> DataFrame:
    """``docs`` with ``__found``: by item_id, the benchmark items that each text holds, with their similarity (``share`` to 1).

    ``benchmark`` has item_id and text; rows with a null id, and texts without a
    word, match nothing; an item of fewer than five words matches its exact
    words. Items that share an id count once, at their highest similarity. Null
    and empty texts hold nothing. Every row of ``docs`` stays, with its columns
    (``__found`` replaces one of that name); empty tables give empty lists.

    The benchmark is indexed in blocks of at most BLOCK_BYTES of text (a longer
    item is a block of its own), one after the other; each block's index is
    broadcast, so its size is bounded whatever the benchmark's. Weights follow
    the whole benchmark: Spark counts the items with each shingle, and a block
    gets the counts of its own.
    """
    spark = docs.sparkSession
    out = docs.drop("__found").withColumn("__found", F.array().cast(FOUND))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text <> ''")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-2 * size // BLOCK_BYTES))
    numbered = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    numbered = staged(numbered.distinct(), "benchmark-items")
    total = numbered.count()
    common = staged(numbered.select("text", "part").mapInArrow(_shingle_rows, "part long, shingle long")
                    .groupBy("shingle").agg(F.count("*").alias("n"), F.collect_set("part").alias("parts"))
                    .where("n > 1").select(F.explode("parts").alias("part"), "shingle", "n"), "benchmark-shingles")
    fields = out.columns
    place = fields.index(text_col)
    for part in range(parts):
        rows = numbered.where(F.col("part") == part).orderBy("item_id", "text").collect()
        if not rows:
            continue
        counts = common.where(F.col("part") == part).toArrow()
        counts = dict(zip(counts["shingle"].to_numpy().view(np.uint64).tolist(), counts["n"].to_pylist(), strict=True))
        held = spark.sparkContext.broadcast(vars(build_index([r.item_id for r in rows], [r.text for r in rows], radius, share, counts, total)))

        def run(batches, held=held):
            index = Index(**held.value)
            for batch in batches:
                found = batch.column(batch.num_columns - 1).to_pylist()
                for i, _, data, offsets in tv.text_slices(batch.column(place).cast(pa.large_string())):
                    for text, item, sim in matches(index, data, offsets, share):
                        found[i + text].append({"item_id": int(index.item_ids[item]), "similarity": sim})
                for r, x in enumerate(found):
                    if len(x) > 1:
                        high: dict[int, float] = {}
                        for y in x:
                            high[y["item_id"]] = max(high.get(y["item_id"], 0.0), y["similarity"])
                        found[r] = [{"item_id": k, "similarity": high[k]} for k in sorted(high)]
                column = pa.array(found, batch.schema.field(batch.num_columns - 1).type)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], schema=batch.schema)

        out = out.mapInArrow(run, out.schema)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", radius: int = RADIUS, share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    return find_contamination(docs, benchmark, text_col, radius, share).where(F.size("__found") == 0).drop("__found")
