import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillroll.llm import jaccard_join as jj
from tillroll.llm import textvec as tv

from .cases import SCHEMA, docs, empty, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        for g in s if i is not None else ():
            where[g].append(n)
    shared = Counter(p for own in where.values() for p in itertools.combinations(own, 2))
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = root(sets[a][0]), root(sets[b][0])
            up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=str)


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.ngram_jaccard_join(df).collect()), key=str)


def check(df):
    assert joined(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_awkward_rows(spark):
    check(docs(spark))


def test_documents(spark):
    check(table(spark, "documents"))


def test_chains_near_copies_and_shared_passages(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    passage = rnd.choices(vocab, k=60)
    rows, base = [], rnd.choices(vocab, k=150)
    for i in range(60):  # a chain: each differs a little from the one before it
        base = list(base)
        base[rnd.randrange(150)] = rnd.choice(vocab)
        rows.append((1000 - i, " ".join(base)))
    for i in range(80):  # unrelated texts around one passage
        rows.append((2000 + i, " ".join(rnd.choices(vocab, k=rnd.randrange(0, 60)) + passage + rnd.choices(vocab, k=rnd.randrange(0, 30)))))
    for i in range(40):  # many variants of one text
        t = list(passage) * 2
        t[rnd.randrange(120)] = rnd.choice(vocab)
        rows.append((3000 + i, " ".join(t)))
    for i in range(200):  # short texts
        rows.append((4000 + i, " ".join(rnd.choices(vocab[:6], k=rnd.randrange(1, 12)))))
    check(spark.createDataFrame([(*r, "en", "x", 1, True, "") for r in rows], SCHEMA).repartition(5))


def test_linked_sets_always_share_a_key():
    rng = np.random.default_rng(3)
    for _ in range(400):
        size = int(rng.integers(4, 400))
        a = rng.integers(0, 2 ** 63, size).astype(np.uint64)
        drop = int(rng.integers(0, size // 5 + 1))
        b = np.concatenate([a[drop:], rng.integers(0, 2 ** 63, int(rng.integers(0, size // 8 + 1))).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * len(np.union1d(a, b)):
            continue
        values, text = tv.distinct(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
        keys, of = jj.block_keys(values, text, tv.per_text(text, 2), 80)
        assert np.array_equal(np.unique(a), np.unique(b)) or len(np.intersect1d(keys[of == 0], keys[of == 1]))


def test_hamming_distance_bounds_the_symmetric_difference(spark):
    df = docs(spark).select("doc_id", "text").where("doc_id is not null")
    got = df.mapInArrow(jj._described(5, 0), "id long, n_shingles long, sig long, sig2 long, sketch binary").collect()
    text = {r.doc_id: shingles(r.text) for r in df.collect()}
    for x, y in itertools.combinations(got, 2):
        far = sum((a ^ b).bit_count() for a, b in zip(x.sketch, y.sketch, strict=True))
        assert far <= len(text[x.id] ^ text[y.id])


def test_buckets_across_batches():
    import pyarrow as pa

    key, ids = [1, 1, 1, 2, 3, 3, 3, 3, 4, 4], [5, 6, 6, 9, 1, 2, 3, 3, 7, 7]
    for cut in range(1, 10):
        parts = [pa.RecordBatch.from_arrays([pa.array(key[a:b]), pa.array(ids[a:b]), pa.array(ids[a:b])], ["key", "doc", "id"]) for a, b in ((0, cut), (cut, 10))]
        got = sorted({tuple(r.values()) for b in jj._buckets(iter(parts)) for r in b.to_pylist()})
        assert got == [(1, 5, 6), (3, 1, 2), (3, 1, 3)]


@pytest.mark.parametrize("percent", [60, 90])
def test_other_thresholds(spark, percent):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    got = {r.doc_id: r.component_id for r in jj.ngram_jaccard_join(docs(spark), percent=percent).collect()}
    sets = {i: shingles(t) for i, t in rows if i is not None}
    linked = 100 * len(sets[1] & sets[14]) >= percent * len(sets[1] | sets[14])
    assert (got[14] == got[1]) == linked


def test_empty_table(spark):
    assert joined(empty(spark)) == []


def some_texts(rnd, n, ids):
    """Texts of which many are near copies of another, under few ids."""
    vocab = [f"w{i}" for i in range(400)]
    base = [rnd.choices(vocab, k=rnd.randrange(30, 90)) for _ in range(n // 4)]
    rows = []
    for _ in range(n):
        w = list(rnd.choice(base)) if rnd.random() < 0.7 else rnd.choices(vocab, k=rnd.randrange(1, 60))
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        rows.append((rnd.randrange(ids) if rnd.random() < 0.95 else None, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,ids", [(1, 40), (2, 200), (3, 20), (4, 100_000)])
def test_ids_with_several_texts(spark, seed, ids):
    rows = some_texts(random.Random(seed), 90, ids)
    check(spark.createDataFrame([(*r, "en", "x", 1, True, "") for r in rows], SCHEMA).repartition(4))


@pytest.mark.parametrize("seed,ids", [(1, 40), (5, 12), (6, 100_000)])
def test_one_row_of_each_group_of_texts_stays(spark, seed, ids):
    rows = some_texts(random.Random(seed), 90, ids)
    rows += rows[:20] + [(3, ""), (3, ""), (None, "a b c"), (None, "a b c")]
    df = spark.createDataFrame([(*r, "en", "x", i, True, "") for i, r in enumerate(rows)], SCHEMA).repartition(4)
    # By text: every row an id of its own, and the first id of a group decides.
    alone = brute([(n, t) for n, (i, t) in enumerate(rows) if i is not None])
    part = {n: c for n, _, c in alone}
    want, groups = Counter(r for r in rows if r[0] is None or not shingles(r[1])), defaultdict(list)
    for n, (i, t) in enumerate(rows):
        if i is not None and shingles(t):
            groups[part[n]].append((i, t))
    kept = jj.drop_near_copies(df).collect()
    got = [(r.doc_id, r.text) for r in kept]
    assert jj.drop_near_copies(df).columns == df.columns
    rest = Counter(got) - want
    assert sum(rest.values()) == len(groups) and sum(Counter(got).values()) == len(groups) + sum(want.values())
    for g in groups.values():
        mine = [r for r in rest.elements() if r in g]
        assert len(mine) == 1 and mine[0][0] == min(i for i, _ in g)


def test_signatures_that_clash_are_mixed_anew(spark, monkeypatch):
    real = jj._signatures
    monkeypatch.setattr(jj, "_signatures", lambda values, at, seed: real(values, at, seed) if seed else np.minimum(np.diff(at), 1).astype(np.int64))
    rows = some_texts(random.Random(9), 60, 100)
    check(spark.createDataFrame([(*r, "en", "x", 1, True, "") for r in rows], SCHEMA).repartition(3))


def test_sketches_tell_long_texts_apart_that_share_passages():
    """Sets as large as these fill 2,048 bits to half, so that such sketches leave every pair to be verified on its texts."""
    rng = np.random.default_rng(8)
    common = rng.integers(0, 2 ** 63, 600)
    sets = [np.concatenate([common, rng.integers(0, 2 ** 63, int(rng.integers(5000, 9000)))]) for _ in range(12)]
    near = [np.concatenate([s[300:], rng.integers(0, 2 ** 63, 200)]) for s in sets[:4]]
    short = [s[:int(rng.integers(1, 4000))] for s in sets]
    both = [np.unique(s).astype(np.uint64) for s in (*sets, *near, *short)]
    at = np.r_[0, np.cumsum([len(s) for s in both])]
    sketches = jj._sketches(np.concatenate(both), at, jj.SKETCH_MOST)
    assert {len(s) for s in sketches} == {256, 512, 1024}
    pairs = np.array(list(itertools.combinations(range(len(both)), 2)))
    far = jj._distances(jj._by_width(sketches), np.array([len(s) for s in sketches]), *pairs.T)
    size, apart = np.diff(at), np.array([len(np.setxor1d(both[x], both[y])) for x, y in pairs])
    assert (far <= apart).all()
    left = far <= jj._differ(size[pairs[:, 0]] + size[pairs[:, 1]], 80)
    links = apart <= jj._differ(size[pairs[:, 0]] + size[pairs[:, 1]], 80)
    assert links.sum() == 4 and (left | ~links).all()
    alike = np.minimum(*size[pairs].T) * 100 >= np.maximum(*size[pairs].T) * 80
    assert (left & alike).sum() == 4


def test_pairs_of_long_texts_that_sketches_leave(spark):
    """No text moves for two long texts around one passage."""
    rnd = random.Random(4)
    passage = rnd.choices(range(10 ** 6), k=300)
    texts = [" ".join(f"w{x}" for x in passage + rnd.choices(range(10 ** 6), k=6000)) for _ in range(6)]
    rows = [(n, t) for n, t in enumerate([*texts, texts[0] + " end", texts[1].replace(" ", "  ", 5) + " a b"])]
    info = spark.createDataFrame(rows, "id long, text string").mapInArrow(jj._described(5, 0, jj.SKETCH_MOST), "id long, n_shingles long, sig long, sig2 long, sketch binary")
    a, b = info.toDF("a", "n_a", "x", "y", "sketch_a"), info.toDF("b", "n_b", "x", "y", "sketch_b")
    pairs = a.crossJoin(b).where("a < b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    assert sorted(map(tuple, pairs.mapInArrow(jj._possible(80), "a long, b long").collect())) == [(0, 6), (1, 7)]
