import re

import numpy as np

from tillroll.llm import decontamination as dc
from tillroll.llm import textvec as tv

from .cases import LONG, PROSE, SCHEMA, docs, empty, table

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    """Items of which 0.8 or more of the shingles, all weighted alike, are in the text."""
    out = {}
    for d, t in docs:
        w = words(t)
        own = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for i, x in items:
            v = words(x)
            s = {tuple(v[k:k + 5]) for k in range(len(v) - 4)}
            if s and len(s & own) >= 0.8 * len(s):
                out[d, i] = len(s & own) / len(s)
    return out


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long")


def found(df, items, **kw):
    return {(r.doc_id, f.item_id): f.similarity for r in dc.find_contamination(df, items, **kw).collect() for f in r["__found"]}


def test_documents_against_brute_force(spark):
    df, items = table(spark, "documents", "sf0.01"), table(spark, "benchmark", "sf0.01")
    got = found(df, items)
    assert set(got) == set(brute([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in items.collect()])) and got


def test_awkward_rows_and_items(spark):
    rows = [(1, PROSE, 1), (2, None, 1), (3, "", 1), (None, PROSE, 1), (4, "evening bell", 1), (5, " ".join(LONG.split()[100:900]), 1), (6, "no such words here at all", 1), (6, PROSE.upper(), 1)]
    got = found(docs(spark), bench(spark, rows))
    assert {d for d, i in got if i == 1} == {1, 2, 14, None}
    assert got[8, 5] == 1.0 and (1, 4) in got and (1, 6) in got and not {i for _, i in got} & {2, 3}
    kept = dc.drop_contaminated(docs(spark), bench(spark, rows))
    assert kept.columns == docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 5, 6, 7, 9, 10, 12, 13]


def test_punctuation_case_and_a_changed_word_are_seen_through(spark):
    item = " ".join(f"term{i}" for i in range(40))
    near = item.replace("term20", "other").replace("term3 ", "Term3, ")
    df = spark.createDataFrame([(1, "before it. " + near + "; after it", "en", "x", 1, True, ""), (2, " ".join(f"term{i}" for i in range(12)), "en", "x", 1, True, "")], SCHEMA)
    got = found(df, bench(spark, [(7, item, 0)]))
    assert set(got) == {(1, 7)} and 0.8 <= got[1, 7] < 1


def test_blocks_of_the_benchmark(spark, monkeypatch):
    items = table(spark, "benchmark", "sf0.01")
    df = table(spark, "documents", "sf0.01")
    whole = found(df, items)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 4000)
    assert found(df, items).keys() == whole.keys()


def test_empty_tables(spark):
    assert found(empty(spark), bench(spark, [(1, PROSE, 0)])) == {} and found(docs(spark), bench(spark, [])) == {}


def test_window_fingerprints_and_blocks():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 2 ** 63, 300).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    sums = dc.bit_sums(w)
    for size in (1, 2, 15, 57, 240):
        got = dc.simhash(sums, size)
        assert len(got) == 300 - size + 1
        for at in (0, len(got) // 2, len(got) - 1):
            bits = (w[at:at + size, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
            assert int(got[at]) == sum(1 << k for k in range(64) if 2 * int(bits[:, k].sum()) > size)


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{rng.integers(500)}" for _ in range(20)) for _ in range(30)]
    index = dc.build_index(list(range(30)), texts)
    size = max(index.windows)
    prints = index.windows[size][0]
    assert index.windows[size][3] == 5 and index.windows[dc.SHINGLE][3] == dc.SHORT_RADIUS
    near = prints[rng.integers(0, len(prints), 2000)]
    for k in range(6):
        near = near ^ np.where(rng.random(2000) < 0.8, np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64), np.uint64(0))
    got = set(zip(*(x.tolist() for x in dc._near_windows(index, size, near)), strict=True))
    want = {(i, e) for i in range(2000) for e in range(len(prints)) if int(near[i] ^ prints[e]).bit_count() <= 5}
    assert got == want and want


def test_words_match_the_definition():
    import pyarrow as pa

    texts = ["Ab-c9 é日本 x", None, "", "..!"]
    data, offsets = tv.utf8(pa.array(texts))
    start, end, of = tv.word_spans(data, offsets, tv.PUNCTUATION)
    assert [data[a:b].tobytes().decode().lower() for a, b in zip(start, end, strict=True)] == words(texts[0]) and set(of.tolist()) == {0}


def edited(rng, w):
    """A copy of the words: some changed, left out or put in, or an end cut off."""
    w = list(w)
    kind = rng.integers(5)
    if kind == 4:
        cut = 1 + int(rng.integers(max(len(w) // 6, 1)))
        return w[cut:] if rng.random() < 0.5 else w[:-cut]
    for _ in range(int(rng.integers(1, 2 + len(w) // 25))):
        k = int(rng.integers(len(w)))
        w[k:k + (kind != 2)] = [] if kind == 1 else [f"new{rng.integers(10 ** 9)}"]
    return w


def test_every_edited_copy_that_brute_force_finds_is_found():
    """Copies in longer texts, of ladder lengths and others; the only region is the copy's, so whole texts compare alike."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lengths = [5, 6, 9, 16, 19, 22, 26, 30, 31, 37, 44, 52, 74, 77, 105, 126, 240, 300]
    items = [(i, " ".join(f"w{rng.integers(10 ** 9)}" for _ in range(n))) for i, n in enumerate(lengths * 2)]
    texts = [" ".join([*(f"a{rng.integers(10 ** 9)}" for _ in range(rng.integers(60))), *edited(rng, x.split()), *(f"b{rng.integers(10 ** 9)}" for _ in range(rng.integers(60)))])
             for _, x in items for _ in range(30)]
    index = dc.build_index([i for i, _ in items], [x for _, x in items])
    got = {(t, i): sim for t, i, sim in dc.matches(index, *tv.utf8(pa.array(texts)), 0.8)}
    want = brute(list(enumerate(texts)), items)
    assert got.keys() == want.keys() and len(want) > 500 and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    # The fingerprints decide: nothing is found without them, and item-sized windows alone miss copies.
    for sizes, least, most in (([], 0, 0), ([s for s in index.windows if s > dc.SHORT], 1, len(want) - 1)):
        some = dc.Index(index.words, index.shingles, index.item_ids, {s: index.windows[s] for s in sizes})
        assert least <= len(list(dc.matches(some, *tv.utf8(pa.array(texts)), 0.8))) <= most


def test_weights_and_regions_against_brute_force():
    """Items that share passages, so weights differ; any region of an item's length and a tenth at both ends counts."""
    import math
    from collections import Counter

    import pyarrow as pa

    rng = np.random.default_rng(6)
    parts = [[f"p{k}x{i}" for i in range(12)] for k in range(8)]
    items = [(i, " ".join(sum((parts[k] for k in rng.integers(0, 8, 3)), []))) for i in range(25)]
    texts = [" ".join(sum((edited(rng, parts[k]) if rng.random() < 0.3 else parts[k] for k in rng.integers(0, 8, 12)), [])) for _ in range(60)]
    texts += [x.replace("x5 ", "x5 put in here ") for _, x in items] + [" ".join(x.split()[:-7]) for _, x in items]
    own = [words(x) for _, x in items]
    sets = [{tuple(v[k:k + 5]) for k in range(len(v) - 4)} for v in own]
    df = Counter(s for x in sets for s in x)
    want = {}
    for t, text in enumerate(texts):
        w = words(text)
        runs = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        for i, x in enumerate(sets):
            weight = {s: 1 + math.log(len(items) / df[s]) for s in x}
            size = len(own[i]) + 2 * (len(own[i]) // 10) - 4
            best = max(sum(weight[s] for s in set(runs[k:k + size]) & x) for k in range(max(len(runs) - size, 0) + 1)) / sum(weight.values())
            if abs(best - 0.8) > 1e-9 and best >= 0.8:
                want[t, i] = best
    index = dc.build_index([i for i, _ in items], [x for _, x in items])
    got = {(t, i): sim for t, i, sim in dc.matches(index, *tv.utf8(pa.array(texts)), 0.8) if abs(sim - 0.8) > 1e-9}
    assert got.keys() == want.keys() and want and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_weights_follow_the_whole_benchmark_in_any_block(spark, monkeypatch):
    rng = np.random.default_rng(7)
    parts = [[f"p{k}x{i}" for i in range(12)] for k in range(8)]
    rows = [(i, " ".join(sum((parts[k] for k in rng.integers(0, 8, 2)), [f"own{i}x{j}" for j in range(int(rng.integers(8, 30)))])), 0) for i in range(40)]
    rows = bench(spark, rows)
    df = spark.createDataFrame([(r.item_id, " ".join(r.text.split()[:-6]), "en", "x", 1, True, "") for r in rows.collect()], SCHEMA)
    whole = found(df, rows)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 3000)
    got = found(df, rows)
    assert got.keys() == whole.keys() and whole and all(abs(got[k] - whole[k]) < 1e-9 for k in whole)
