import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.llm import quality_rules as q

from .cases import docs, empty, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, kept string")


@pytest.mark.parametrize("source", ["cases", "sf0.001"])
def test_base_counts(spark, source):
    df = docs(spark) if source == "cases" else table(spark, "documents")
    text = {(r.doc_id, r.text) for r in df.collect()}
    want = sorted([(i, *brute(t)) for i, t in ((r.doc_id, r.text) for r in df.collect())], key=str)
    got = q.quality_rules(df, labels(spark, [(1, 1, "a"), (1, None, None), (None, 0, None)]))
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect()], key=str)
    assert text and got == want


def test_binomial_bound(spark):
    cases = [(k, n, p) for n in (1, 10, 300, 5000) for p in (0.004, 0.1) for k in range(0, min(n, 40), 3)]
    for p in (0.004, 0.1):
        rows = [(k, n) for k, n, x in cases if x == p]
        got = spark.createDataFrame(rows, "k long, n long").select("k", "n", q.binomial_cdf(F.col("k"), F.col("n"), p).alias("p")).collect()
        for r in got:
            exact = sum(math.comb(r.n, i) * p ** i * (1 - p) ** (r.n - i) for i in range(r.k + 1))
            if r.k < r.n * p:
                assert exact <= r.p <= min(1.0, exact * (1 + 1e-6) + 1e-15)
            else:
                assert r.p == 1.0


def test_cutoffs_are_certified_and_gain(spark):
    good = [("en", True, 0, 0, 0, 30, 0)] * 20_000 + [("en", True, 60, 0, 0, 30, 0)] * 10
    bad = [("en", False, 400, 0, 0, 30, 0)] * 500 + [("en", False, 0, 0, 600, 30, 0)] * 300
    few = [("fr", True, 0, 0, 0, 30, 0)] * 50 + [("fr", False, 900, 0, 0, 30, 0)] * 50
    df = spark.createDataFrame(good + bad + few, "stratum string, good boolean, symbols long, dup_lines long, repeats long, capitals long, shouts long")
    cuts = {r.stratum: r.cutoff for r in q.certified_cutoffs(df).collect()}
    assert cuts == {"en": 300, "fr": None}  # few labels: no certificate
    enough = df.where("stratum = 'en' and good").limit(220).union(df.where("stratum = 'en' and not good"))
    assert q.certified_cutoffs(enough).first().cutoff == 300


def test_no_more_than_the_risk_is_lost(spark):
    """Rules that reject a share of good texts at the risk itself are certified in hardly any stratum."""
    import numpy as np

    rng = np.random.default_rng(3)
    strata, n = 200, 600
    hit = rng.random((strata, n)) < q.RISK
    rows = [(f"s{i}", True, 450 * int(h), 0, 0, 0, 0) for i in range(strata) for h in hit[i]] + [(f"s{i}", False, 450, 0, 0, 0, 0) for i in range(strata) for _ in range(60)]
    df = spark.createDataFrame(rows, "stratum string, good boolean, symbols long, dup_lines long, repeats long, capitals long, shouts long")
    found = q.certified_cutoffs(df, delta=0.05 * strata, price=0).where("cutoff is not null").count()  # each stratum at 0.05
    assert found <= 0.05 * strata + 3 * (0.05 * strata) ** 0.5


def test_a_rule_that_would_lose_good_texts_is_not_certified(spark):
    rows = [("en", True, 500 * (i % 20 == 0), 0, 0, 0, 0) for i in range(5000)] + [("en", False, 500, 0, 0, 0, 0)] * 5000
    df = spark.createDataFrame(rows, "stratum string, good boolean, symbols long, dup_lines long, repeats long, capitals long, shouts long")
    assert q.certified_cutoffs(df).first().cutoff is None


def test_filter_keeps_what_the_rules_keep_with_all_columns(spark):
    df = docs(spark).selectExpr("*", "1 AS __w", "2 AS __q", "3 AS cutoff", "4 AS stratum")
    lab = labels(spark, [(1, 1, "a"), (13, 0, "b")])
    kept = q.keep_good(df, lab)
    assert kept.columns == df.columns
    want = sorted(r.doc_id or -1 for r in q.quality_rules(df, lab).where("kept").collect())
    assert sorted(r.doc_id or -1 for r in kept.collect()) == want and 8 in want


def test_labels_of_the_given_tables_certify_cutoffs(spark):
    sf = "sf0.1"
    rows = q.quality_rules(table(spark, "documents", sf), table(spark, "labels", sf))
    assert rows.where("size(rejected_by) > 0 and not base_failed").count() > 100


def test_empty_tables(spark):
    none = labels(spark, [])
    assert q.quality_rules(empty(spark), none).collect() == []
    assert all(r.kept == (not r.base_failed) for r in q.quality_rules(docs(spark), none).collect())
