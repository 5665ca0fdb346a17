import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import collocations, counting_filter as cf
from tillroll.llm.collocations import count_words, mine_collocations
from tillroll.llm.phrases_query import SQL, op13_phrase_collocations

from . import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, top, share=50):
    grams, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                grams.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    often = {g: a for g, a in grams.items() if len(g) > 2 and a >= least}
    inside = {s for g, a in often.items() if len(g) == 4 for s in (g[:3], (g[0], *g[2:])) if 100 * a >= share * grams[s]}
    out = []
    for g, a in often.items():
        if g not in inside:
            cuts = [(grams[g[:k]], grams[(g[0], *g[k:])]) for k in range(2, len(g))]
            score, _, (left, right) = min((1_000_000 * a * a // (x * y), i, (x, y)) for i, (x, y) in enumerate(cuts))
            out.append((g[0], " ".join(g[1:]), a, left, right, n[g[0]], score))
    ranked = []
    for lang in n:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(best, 1)]
    return sorted(ranked)


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([(40, 12), (48, 12), (56, 20), (64, 12)]), st.sampled_from([2, 3]), st.integers(0, 2 ** 32), st.integers(0, 400))
def test_filters_lose_nothing(sizes, order, seed, n):
    bits, ranged = sizes
    rnd = np.random.RandomState(seed % 2 ** 32)
    keys = [rnd.randint(0, 2 ** 63, n, np.int64).astype(np.uint64) * np.uint64(2) % np.uint64(50 if seed % 2 else 2 ** 63) & cf.mask(bits) for _ in range(order)]
    counts = rnd.choice([1, 2, 254, 255, 256, 10 ** 12], n).astype(np.int64)
    want = Counter()
    for *key, c in zip(*[k.tolist() for k in keys], counts.tolist()):
        want[tuple(key)] += c
    lanes, summed = cf.summed(cf.permute(keys, bits), counts)
    got = {}
    of, at = cf.ranges(lanes, bits, ranged)
    for r, a, b in zip(of.tolist(), at[:-1], at[1:]):
        back, c = cf.decode(cf.encode([x[a:b] for x in lanes], summed[a:b], bits, ranged), order, bits, ranged, r)
        got.update(zip(zip(*[x.tolist() for x in cf.restore(back, bits)]), c.tolist()))
    assert got == want


def test_keys_with_one_first_lane_stay_apart():
    lanes = [np.array([7, 7, 7, 7], np.uint64), np.array([2, 1, 2, 1], np.uint64)]
    keys, counts = cf.summed(lanes, np.array([1, 10, 100, 1000]))
    assert [k.tolist() for k in keys] == [[7, 7], [1, 2]] and counts.tolist() == [1010, 101]


@pytest.mark.parametrize("small", [False, True])
def test_matches_a_plain_version(spark, small, monkeypatch):
    if small:  # many flushes and merges
        monkeypatch.setattr(collocations, "ENTRIES", 50)
    rnd = random.Random(4)
    vocabulary = ["Der", "der", "New", "York", "CITY", "été", "мир", "a", "b", "c", "rare"]
    rows = [(rnd.choice(["en", "fr", None, "und"]), "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\t", ", ", "\n", "\xa0", ". "]) for _ in range(rnd.randint(0, 60))))
            for _ in range(300)] + [("en", "unique words only here"), ("de", "zu selten")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(7)
    for least, top in ((10, 2000), (3, 5)):
        got = sorted(tuple(r) for r in mine_collocations(docs, least=least, top=top).collect())
        assert got and got == by_hand(rows, least, top)


def test_products_over_64_bits(spark):
    df = spark.createDataFrame([(10 ** 13, 10 ** 13, 10 ** 13 + 1), (3_000_000_019, 3_000_000_020, 3_000_000_021)], "a long, l long, r long")
    got = [x[0] for x in df.select(collocations.score("a", "l", "r")).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in [(10 ** 13, 10 ** 13, 10 ** 13 + 1), (3_000_000_019, 3_000_000_020, 3_000_000_021)]]


def test_ids_of_words_that_agree_are_lengthened(spark, monkeypatch):
    """Where short ids clash, longer ones or another hash are taken."""
    texts = spark.createDataFrame([("en", "one two three four five two"), ("fr", "one")], "lang string, text string")
    real = collocations._bytes_order
    monkeypatch.setattr(collocations, "_bytes_order", lambda seed: real(seed) if seed else np.zeros(256, np.uint8))
    words, seed, bits = count_words(texts)
    assert words.count() == 6 and words.select("id").distinct().count() == 6 and (seed, bits) == (1, 40)
    assert {(r.lang, r.word): r.f for r in words.collect()}["en", "two"] == 2


def test_awkward_rows_and_empty_tables(spark):
    docs = cases.docs(spark).selectExpr("*", "1 AS a", "'x' AS phrase", "2 AS n")
    rows = [(r[2], r[1]) for r in cases.TEXTS]
    assert sorted(tuple(r) for r in mine_collocations(docs, least=2).collect()) == by_hand(rows, 2, 2000)
    assert mine_collocations(cases.empty(spark)).count() == 0


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = sorted(tuple(r) for r in op13_phrase_collocations(spark, "/root/testdata/sf0.001").collect())
    assert got and got == sorted(con.execute(SQL).fetchall())
    docs = cases.table(spark, "documents").select("lang", "text").collect()
    assert got == by_hand(docs, 10, 2000)
