"""N-gram Jaccard join by parity sketches.

A document's set holds the distinct hashes of its k-word shingles. The set is
XOR-hashed into a sketch of m blocks: every shingle toggles its 64-bit hash in
one block. A shingle that only one of two sets has changes one block at most,
so the number of differing blocks bounds the symmetric difference from below.
Sets of at most u shingles with similarity p/100 or more differ in at most
D = 2u(100-p)/(100+p) shingles; with more than D blocks, one block is equal
(pigeonhole). Bands of sizes fix u, D and m; a set joins its own band and the
next, which holds its larger partners.

Blocks without a shingle say nothing, so m = D + 1 + spare. A document with
more empty blocks than ``spare`` at some level also emits its prefix (its
smallest shingles by hash, at least one of which a partner's prefix shares):
a pair that no filled block is sure to find has two such documents.

All of this works on classes, the documents of one set, named by their set's
signature; Spark verifies that no two sets share it (else the hashes are mixed anew).
Classes that meet in a block form a bucket. Each class is first verified
against one leader (its most frequent bucket minimum), which is linear in the
classes. Buckets whose members are then still in different components are
compared pair by pair, in bounded chunks, with a bitwise parity sketch whose
Hamming distance bounds the symmetric difference too; survivors are verified.
A long text has a longer sketch, as one whose bits are all as good as random rules
nothing out; of two sketches the longer is folded to the length of the other.
Verification computes both sets from the whole texts, so links are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .util import connected_components, id_filter, rows_in_filter, staged

_U = np.uint64
SKETCH_BITS = 2048  # of a set of up to twice as many shingles, and a power of 2
SKETCH_MOST = 16384
CHUNK = 4096  # members of a bucket compared at once


def _shingle_sets(batch_texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, hashes, text, offsets of each text's hashes), distinct within each text."""
    for i, j, data, offsets in tv.text_slices(batch_texts):
        words, of = tv.word_hashes(data, offsets)
        values, text = tv.distinct(*tv.shingles(words, of, k), j - i)
        yield i, j, values, text, tv.per_text(text, j - i)


def size_levels(largest: int, percent: int) -> np.ndarray:
    """Upper sizes of the bands: a partner of a set is in its band or the next."""
    levels = [1]
    while levels[-1] < largest * 100 // percent + 1:
        levels.append(max(levels[-1] + 1, levels[-1] * 100 // percent))
    return np.array(levels + [levels[-1] + 1], np.int64)


def _differ(total: np.ndarray, percent: int) -> np.ndarray:
    """Most shingles in which two linked sets of ``total`` shingles together differ."""
    return total * (100 - percent) // (100 + percent)


def block_keys(values: np.ndarray, text: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, text): the filled sketch blocks of every set at its two levels, and prefixes where needed."""
    size = np.diff(at)
    levels = size_levels(int(size.max(initial=1)), percent)
    own = np.searchsorted(levels, size)
    keys, of, needy = [], [], np.zeros(len(size), bool)
    for step in (0, 1):
        level = own + step
        differ = _differ(2 * levels[level], percent)
        spare = np.maximum(2, (15 * differ + 99) // 100)
        blocks = np.where((differ > 0) & (size > 0), differ + 1 + spare, 0)
        base = np.zeros(len(size) + 1, np.int64)
        np.cumsum(blocks, out=base[1:])
        use = blocks[text] > 0
        v, t = values[use], text[use]
        block = base[t] + ((v >> _U(11)) % np.maximum(blocks[t], 1).astype(np.uint64)).astype(np.int64)
        parity = np.zeros(base[-1], np.uint64)
        np.bitwise_xor.at(parity, block, v)
        filled = np.zeros(base[-1], bool)
        filled[block] = True
        owner = np.repeat(np.arange(len(size)), blocks)
        needy |= (blocks - np.bincount(owner[filled], minlength=len(size)) > spare) & (blocks > 0)
        place = np.arange(base[-1]) - base[owner]
        salt = tv.mix((levels[level][owner] << 24).astype(np.uint64) + place.astype(np.uint64) + _U(1))
        keys.append(tv.mix(parity ^ salt)[filled])
        of.append(owner[filled])
    # A set's values are in the order of their hashes, so its prefix comes first.
    rank = np.arange(len(values)) - at[text]
    prefix = needy[text] & (rank < (size - -(-size * percent // 100) + 1)[text])
    keys.append(tv.mix(values[prefix] + _U(0x5851F42D4C957F2D)))
    of.append(text[prefix])
    return np.concatenate(keys), np.concatenate(of)


def _signatures(values: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    return tv.sums(tv.mix(values ^ _U(seed)) if seed else values, at).view(np.int64)


def _sketches(values: np.ndarray, at: np.ndarray, most: int) -> list[bytes]:
    """Of each set the parity of its values in bits, value v in bit v % bits: a power of 2, half the set's size or more if that is within ``most``."""
    size = np.diff(at)
    bits = np.clip(2 ** np.ceil(np.log2(np.maximum(size, 2) / 2)).astype(np.int64), SKETCH_BITS, most)
    start = np.zeros(len(size) + 1, np.int64)
    np.cumsum(bits // 64, out=start[1:])
    out = np.zeros(start[-1], np.uint64)
    bit = values & (np.repeat(bits, size) - 1).astype(np.uint64)
    np.bitwise_xor.at(out, np.repeat(start[:-1], size) + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
    return [out[i:j].tobytes() for i, j in zip(start, start[1:], strict=False)]


def _by_width(sketches: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length in bytes: (the sketches of this length or more, folded to it; each sketch's row there)."""
    size, out = np.array([len(s) for s in sketches], np.int64), {}
    for width in np.unique(size):
        own = np.flatnonzero(size >= width)
        folded = np.empty((len(own), width // 8), np.uint64)
        for longer in np.unique(size[own]):
            rows = np.flatnonzero(size[own] == longer)
            bits = np.frombuffer(b"".join(sketches[i] for i in own[rows]), np.uint64)
            folded[rows] = np.bitwise_xor.reduce(bits.reshape(len(rows), longer // width, width // 8), axis=1)
        place = np.zeros(len(size), np.int64)
        place[own] = np.arange(len(own))
        out[int(width)] = folded, place
    return out


def _distances(sketches: dict[int, tuple[np.ndarray, np.ndarray]], width: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distances of the pairs x, y of ``_by_width``'s sketches, of the lengths ``width``, at the shorter's length."""
    out, both = np.zeros(len(x), np.int64), np.minimum(width[x], width[y])
    for w in np.unique(both):
        folded, place = sketches[int(w)]
        own = np.flatnonzero(both == w)
        for i in range(0, len(own), 20_000 * 256 // int(w)):
            part = own[i:i + 20_000 * 256 // int(w)]
            out[part] = np.bitwise_count(folded[place[x[part]]] ^ folded[place[y[part]]]).sum(axis=1, dtype=np.int64)
    return out


def _described(k: int, seed: int, most: int = SKETCH_BITS):
    def run(batches):
        for batch in batches:
            for i, j, values, text, at in _shingle_sets(batch.column(1), k):
                again = tv.mix(values ^ _U(0x2545F4914F6CDD1D))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.diff(at)),
                    pa.array(_signatures(values, at, seed)), pa.array(tv.sums(again, at).view(np.int64)),
                    pa.array(_sketches(values, at, most), pa.binary())],
                    ["id", "n_shingles", "sig", "sig2", "sketch"])
    return run


def _signed(k: int, seed: int, place: int, names: list[str]):
    """Rows of any columns, the text at ``place``, with the text's signature and size added."""
    def run(batches):
        for batch in batches:
            sig, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, values, _, at in _shingle_sets(batch.column(place), k):
                sig.append(_signatures(values, at, seed))
                n.append(np.diff(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(sig)), pa.array(np.concatenate(n))], names)
    return run


def _keyed(k: int, percent: int, seed: int):
    def run(batches):
        seen: set[int] = set()  # signatures of this task's texts: a copy has the same keys
        for batch in batches:
            for i, j, values, text, at in _shingle_sets(batch.column(1), k):
                fresh = np.zeros(j - i, bool)
                sig = _signatures(values, at, seed)
                for d, s in enumerate(sig.tolist()):
                    if s not in seen:
                        seen.add(s)
                        fresh[d] = True
                keep = fresh[text]
                values, text = values[keep], text[keep]
                keys, of = block_keys(values, text, tv.per_text(text, j - i), percent)
                doc = batch.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(doc[of].astype(np.int64)), pa.array(sig[of])], ["key", "doc", "id"])
    return run


def _whole_keys(batches, columns: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by their first ``columns`` columns, cut where those change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = [batch.column(c).to_numpy() for c in range(columns)]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
        new = held[:-1] and any(held[-2].column(c)[-1].as_py() != keys[c][0] for c in range(columns))
        if len(change):
            cut = int(change[-1]) + 1
            out = held[:-1] + [batch.slice(0, cut)]
            held = [batch.slice(cut)]
        elif new:
            out, held = held[:-1], [batch]
        else:
            continue
        yield pa.Table.from_batches(out).combine_chunks()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _buckets(batches):
    """(key, leader, id) for every bucket of two classes or more; rows (key, doc, id) come sorted, so the class
    of the smallest document leads: the same one in the buckets of a text and its later variants."""
    last_key = last_leader = last_id = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        first = np.r_[True, key[1:] != key[:-1]]
        start = np.flatnonzero(first)
        leader = np.repeat(ids[start], np.diff(np.r_[start, len(key)]))
        if last_key is not None and key[0] == last_key:
            leader[:start[1] if len(start) > 1 else len(key)] = last_leader
        last_key, last_leader = key[-1], leader[-1]
        keep = ids != leader
        keep[1:] &= (ids[1:] != ids[:-1]) | first[1:]
        keep[0] &= last_id != ids[0] or bool(leader[0] != last_leader)
        last_id = ids[-1]
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(leader[keep]), pa.array(ids[keep])], ["key", "leader", "id"])


def _verified(k: int, percent: int, seed: int):
    """Of rows (a, b, text of a, text of b), the pairs that link. A text of another class (its id has several) is passed over."""
    def run(batches):
        for batch in batches:
            def sets(column: int):
                for _, _, v, _, at in _shingle_sets(batch.column(column), k):
                    for d, sig in enumerate(_signatures(v, at, seed).tolist()):
                        yield sig, v[at[d]:at[d + 1]]
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left = list(sets(2))
            ok = np.zeros(batch.num_rows, bool)
            for r, ((p, x), (q, y)) in enumerate(zip(left, sets(3), strict=True)):
                if p == a[r] and q == b[r]:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok[r] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    return run


def _possible(percent: int):
    """Of rows (a, b, sizes, sketches), the pairs that the sketches' Hamming distance doesn't rule out."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            sketches, at = [*batch.column(4).to_pylist(), *batch.column(5).to_pylist()], np.arange(len(n))
            far = _distances(_by_width(sketches), np.array([len(s) for s in sketches]), at, at + len(n))
            yield batch.select(["a", "b"]).filter(pa.array(far <= _differ(n, percent)))
    return run


def _near(percent: int):
    """Pairs of a chunk's members, in different components, that the sketches' Hamming distance doesn't rule out."""
    def run(batches):
        for t in _whole_keys(batches, 2):
            key, block = t["key"].to_numpy(), t["block"].to_numpy()
            ids, comp, n, chunk = (t[c].to_numpy() for c in ("id", "component", "n_shingles", "chunk"))
            sketches = t["sketch"].to_pylist()
            width, sketches = np.array([len(s) for s in sketches]), _by_width(sketches)
            lo, hi = block // 2 ** 20, block % 2 ** 20
            step, left = 1, np.arange(len(ids) - 1)
            while len(left):
                left = left[left + step < len(ids)]
                left = left[(key[left] == key[left + step]) & (block[left] == block[left + step])]
                x, y = left, left + step
                ok = (comp[x] != comp[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent)
                ok &= (np.minimum(chunk[x], chunk[y]) == lo[x]) & (np.maximum(chunk[x], chunk[y]) == hi[x])
                x, y = x[ok], y[ok]
                for at in range(0, len(x), 20_000):
                    u, v = x[at:at + 20_000], y[at:at + 20_000]
                    far = _distances(sketches, width, u, v)
                    ok = far <= _differ(n[u] + n[v], percent)
                    if ok.any():
                        yield pa.RecordBatch.from_arrays([pa.array(ids[u[ok]]), pa.array(ids[v[ok]])], ["a", "b"])
                step += 1
    return run


def _classes(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """(a row per row: id, n_shingles, sig; the links of classes: a, b; the seed of the signatures).

    Links are enough of them for the components: each class's with a leader, and
    between the components these leave.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    for seed in range(8):
        info = staged(rows.mapInArrow(_described(k, seed, SKETCH_MOST), "id long, n_shingles long, sig long, sig2 long, sketch binary"), "jaccard-sets")
        known = info.where("id is not null and n_shingles > 0")
        sets = known.select("sig", "n_shingles", "sig2").distinct()
        if sets.groupBy("sig").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("no signature tells all sets apart")
    texts = rows.where("id is not null")
    if not known.groupBy("id", "sig").count().where("count > 1").isEmpty():
        texts = texts.dropDuplicates(["id", "text"])  # equal rows
    keys = texts.mapInArrow(_keyed(k, percent, seed), "key long, doc long, id long")
    members = staged(keys.repartition("key").sortWithinPartitions("key", "doc", "id")
                     .mapInArrow(_buckets, "key long, leader long, id long"), "jaccard-buckets")
    # The document whose text stands for the class.
    shown = staged(known.groupBy("sig").agg(F.min("id").alias("doc")), "jaccard-classes")

    def possible(pairs: DataFrame) -> DataFrame:
        """Those of the candidate pairs (a, b) that their sketches leave, so that no text moves for the others."""
        bitmap = id_filter(pairs.select(F.explode(F.array("a", "b")).alias("sig")), "sig")
        sketches = (rows_in_filter(known.select("sig", "n_shingles", "sketch"), "sig", bitmap)
                    .groupBy("sig").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
        sides = (pairs.join(sketches.toDF("a", "n_a", "sketch_a"), "a").join(sketches.toDF("b", "n_b", "sketch_b"), "b")
                 .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"))
        return staged(sides.mapInArrow(_possible(percent), "a long, b long"), "jaccard-possible")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the candidate pairs (a, b) that link, verified on whole texts."""
        pairs = staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"jaccard-{name}")
        pairs = staged(pairs.join(shown.toDF("a", "doc_a"), "a").join(shown.toDF("b", "doc_b"), "b"), f"jaccard-{name}-docs")
        bitmap = id_filter(pairs.select(F.explode(F.array("doc_a", "doc_b")).alias("id")), "id")
        found = rows_in_filter(texts, "id", bitmap)
        sides = (pairs.join(found.toDF("doc_a", "text_a"), "doc_a").join(found.toDF("doc_b", "text_b"), "doc_b")
                 .select("a", "b", "text_a", "text_b"))
        return staged(sides.mapInArrow(_verified(k, percent, seed), "a long, b long"), f"jaccard-links-{name}")

    # Each class is verified against one leader.
    pairs = staged(members.groupBy("id", "leader").agg(F.count("*").alias("n")), "jaccard-pairs")
    best = pairs.groupBy("id").agg(F.max_by("leader", F.struct("n", -F.col("leader"))).alias("leader"))
    best = staged(best.toDF("a", "b"), "jaccard-best")
    found = links(possible(best), "leaders")
    part = connected_components(found)

    # Buckets that still span components have a member in another one than their leader's. Pairs of member and
    # leader are far fewer than the rows of buckets, so they tell which buckets these are; only their rows move.
    open_pairs = staged(pairs.join(part.toDF("id", "own"), "id", "left").join(part.toDF("leader", "led"), "leader", "left")
                        .where(F.coalesce("own", "id") != F.coalesce("led", "leader"))
                        .select("id", "leader", F.xxhash64("id", "leader").alias("pair")), "jaccard-open-pairs")
    across = rows_in_filter(members.withColumn("pair", F.xxhash64("id", "leader")), "pair", id_filter(open_pairs, "pair"))
    open_keys = staged(across.join(open_pairs, ["id", "leader"], "left_semi").select("key").distinct(), "jaccard-open-keys")
    opened = rows_in_filter(members, "key", id_filter(open_keys, "key")).join(open_keys, "key", "left_semi")
    bucket = opened.select("key", "id").union(opened.select("key", F.col("leader").alias("id"))).distinct()
    bucket = staged(bucket.join(part, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "jaccard-members")

    # These are compared member by member; of buckets with the same members (by number and 128 bits of hash) one is.
    groups = bucket.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    one = groups.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / CHUNK).cast("long").alias("chunks"))
    left = staged(bucket.join(one, "key").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))), "jaccard-compared")
    sketches = (known.join(left.select(F.col("id").alias("sig")).distinct(), "sig", "left_semi")
                .groupBy(F.col("sig").alias("id")).agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
                         lambda o: F.least("chunk", o) * 2 ** 20 + F.greatest("chunk", o))
    spread = (left.join(sketches, "id")
              .select("key", F.explode(blocks).alias("block"), "id", "component", "n_shingles", "chunk", "sketch"))
    near = spread.repartition("key", "block").sortWithinPartitions("key", "block", "id").mapInArrow(_near(percent), "a long, b long")
    return info.select("id", "n_shingles", "sig"), staged(found.union(links(near, "rest")), "jaccard-links"), seed


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles and component_id.

    Two documents link when 100 * intersection >= percent * union of their sets
    of distinct k-word shingles (A-Z lower-cased; fewer words than k: the whole
    sequence is one shingle). component_id is the smallest id reachable by
    links, the row's own included.

    Null or empty texts, or texts without a word, have n_shingles 0 and link
    with nothing. A row with a null id takes part in no link; its component_id is null. Rows
    that share an id are one document, whatever their texts: a link of any joins its component.
    Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    info, links, _ = _classes(docs, id_col, text_col, k, percent)
    known = info.where("id is not null and n_shingles > 0")
    # An id with several sets joins their classes.
    several = known.groupBy("id").agg(F.min("sig").alias("a"), F.max("sig").alias("low")).where("a < low").select("id", "a")
    same = several.join(known.select("id", F.col("sig").alias("b")), "id").where("a <> b").select("a", "b").distinct()
    part = connected_components(links.union(same)).toDF("sig", "part")
    least = known.groupBy("sig").agg(F.min("id").alias("least")).join(part, "sig", "left").withColumn("part", F.coalesce("part", "sig"))
    parts = least.groupBy("part").agg(F.min("least").alias("component"))
    component = staged(least.join(parts, "part").select("sig", "component"), "jaccard-components")
    # Nothing but the join in this stage, so Spark can split a large class's partition.
    out = info.join(component, "sig", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles",
                      F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked texts, with all its columns.

    Groups are the components of texts by links (here an id doesn't join its
    texts: rows that share one but not a text are no copies). The row with the
    smallest id stays, of several texts of that id the one with the smallest
    signature, of equal rows the first by their columns. Rows with a null id or
    without a word stay, all of them.
    """
    info, links, seed = _classes(docs, id_col, text_col, k, percent)
    known = info.where("id is not null and n_shingles > 0")
    part = connected_components(links).toDF("sig", "part")
    least = known.groupBy("sig").agg(F.min("id").alias("id")).join(part, "sig", "left")
    first = least.groupBy(F.coalesce("part", "sig").alias("part")).agg(F.min(F.struct("id", "sig")).alias("x"))
    first = staged(first.select("x.id", "x.sig"), "jaccard-first")
    more = ["sig", "n_shingles", "id"]
    while set(more) & {c.lower() for c in docs.columns}:
        more = [f"_{c}" for c in more]
    sig, size, key = more
    schema = docs.withColumns({sig: F.lit(0).cast("long"), size: F.lit(0).cast("long")}).schema
    rows = docs.mapInArrow(_signed(k, seed, docs.columns.index(text_col), schema.names), schema).withColumn(key, F.col(id_col).cast("long"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    free = rows.where(F.col(key).isNull() | (F.col(size) == 0)).select(*columns)
    held = rows_in_filter(rows.where(F.col(key).isNotNull() & (F.col(size) > 0)), sig, id_filter(first, "sig"))
    kept = held.join(first.toDF(key, sig), [key, sig], "left_semi")
    if not known.groupBy("id", "sig").count().where("count > 1").isEmpty():
        copies = Window.partitionBy(key, sig).orderBy(*columns)
        kept = kept.withColumn(size, F.row_number().over(copies)).where(F.col(size) == 1)
    return kept.select(*columns).unionByName(free)
