"""The trained operators: held-out accuracy, folds, awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import language_id as lid
from tillroll.llm import quality_classifier as qc
from tillroll.llm import toxicity as tox
from tillroll.llm import url_filter as uf
from tillroll.llm.hashed_text import fold, gram_buckets

from .cases import docs, empty, table

SF = "sf0.1"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_folds(spark):
    got = spark.createDataFrame([(i,) for i in (0, 1, 77, 12345, None)], "doc_id long").select("doc_id", fold("doc_id", 4).alias("f")).collect()
    assert all(r.f == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4) for r in got)


def test_grams_stay_inside_their_text():
    data, offsets = np.frombuffer(b"abcdabcxyabcd", np.uint8), np.array([0, 4, 4, 7, 9, 13])
    found, at = gram_buckets(data, offsets, 3, 20)
    assert at.tolist() == [0, 2, 2, 3, 3, 5] and found[0] == found[2] == found[3] and found[1] == found[4]


def test_language_is_found_on_held_out_documents(spark):
    df = table(spark, "documents", SF)
    got, want = by_id(lid.learn_and_identify(df)), by_id(df)
    held = [i for i, r in got.items() if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    sure = [i for i in held if want[i].n_chars >= 100]
    assert np.mean([got[i].lang_pred == want[i].lang for i in sure]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_awkward_rows(spark):
    rows = lid.learn_and_identify(docs(spark)).collect()
    assert len(rows) == docs(spark).count()
    for r in rows:
        if r.doc_id in (3, 4, 5, 13):
            assert r.lang_pred == "und" and r.score == 0 and r.rejected
    assert {r.lang_pred for r in rows} <= {"und", "en", "fr", "de", "es"}
    assert lid.learn_and_identify(empty(spark)).collect() == []
    assert {r.lang_pred for r in lid.identify_language(docs(spark), None).collect()} == {"und"}


def auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    pos = rank[np.array(label) == 1]
    return (pos.mean() - (len(pos) - 1) / 2) / (len(score) - len(pos))


@pytest.fixture(scope="module")
def toxic(spark):
    df, labels = table(spark, "documents", SF), table(spark, "labels", SF)
    return by_id(tox.learn_and_score(df, labels)), {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}


def test_toxicity_on_held_out_documents(toxic):
    got, label = toxic
    held = [i for i, r in got.items() if r.held_out and i in label]
    assert auc([got[i].score for i in held], [label[i] for i in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_toxicity_by_language(spark, toxic):
    """Every language with some held-out toxic documents is told better than by chance, and its clean ones are left alone."""
    got, label = toxic
    lang = {r.doc_id: r.lang for r in table(spark, "documents", SF).select("doc_id", "lang").collect()}
    for name in set(lang.values()):
        rows = [(r.score, label[i], r.predicted) for i, r in got.items() if r.held_out and lang[i] == name and i in label]
        y = [x for _, x, _ in rows]
        if sum(y) >= 5:
            assert auc([x for x, _, _ in rows], y) > 0.9, name
            assert sum(p for _, x, p in rows if x) >= 0.75 * sum(y), name
        if len(y) > 50:
            assert sum(p for _, x, p in rows if not x) <= 0.1 * len(y), name


def test_toxicity_scores_like_the_definition():
    """A plain forward pass over words, filters and the largest response of each, with given weights."""
    import pyarrow as pa

    from tillroll.llm import textvec as tv

    rng = np.random.default_rng(2)
    tables = [rng.normal(size=(2, 2 ** tox.BITS, tox.FILTERS)).astype(np.float32) for w in tox.WIDTHS for _ in range(w)]
    bias, weights = rng.normal(size=len(tox.WIDTHS) * tox.FILTERS).astype(np.float32), rng.normal(size=len(tox.WIDTHS) * tox.FILTERS).astype(np.float32)
    texts = ["one", "", None, "You, sir, are a fool! " * 5, "zwei Wörter"]
    data, offsets = tv.utf8(pa.array(texts))
    got = tox.logits(tables, bias, weights, 0.25, *tox.word_buckets(data, offsets))
    for t, text in enumerate(texts):
        one, two, _ = tox.word_buckets(*tv.utf8(pa.array([text])))
        want, k = 0.25, 0
        for i, w in enumerate(tox.WIDTHS):
            for f in range(tox.FILTERS):
                responses = [float(bias[i * tox.FILTERS + f]) + sum(float(tables[k + j][0][one[s + j], f]) + float(tables[k + j][1][two[s + j], f]) for j in range(w))
                             for s in range(len(one) - w + 1)]
                want += max([0.0, *responses]) * float(weights[i * tox.FILTERS + f])
            k += w
        assert abs(got[t] - want) < 1e-3


def test_toxicity_sample_shares():
    got = tox._shares({("a/1", 1): 900, ("b/1", 1): 30, ("c/1", 1): 5000, ("a/0", 0): 10}, 1000)
    assert got == {"b/1": 30, "a/1": 485, "c/1": 485, "a/0": 10}


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, t, 1) for i, t in ((1, 0), (2, 1), (2, 0), (8, 1), (9, 0), (12, 0), (None, 1), (3, None))], "doc_id long, toxic int, kept int")
    rows = tox.learn_and_score(docs(spark), labels).collect()
    assert len(rows) == docs(spark).count() and all(r.score is not None for r in rows)
    none = labels.where("false")
    assert {r.score for r in tox.learn_and_score(docs(spark), none).collect()} == {0.0}
    assert tox.learn_and_score(empty(spark), labels).collect() == []


def test_windows_never_cross_texts():
    rng = np.random.default_rng(1)
    one, two = rng.integers(0, 50, 40), rng.integers(0, 50, 40)
    at = np.array([0, 0, 1, 3, 20, 40])
    tables = [rng.normal(size=(2, 50, tox.FILTERS)).astype(np.float32) for w in tox.WIDTHS for _ in range(w)]
    net = (tables, rng.normal(size=len(tox.WIDTHS) * tox.FILTERS).astype(np.float32), rng.normal(size=len(tox.WIDTHS) * tox.FILTERS).astype(np.float32), 0.1)
    whole = tox.logits(*net, one, two, at)
    alone = [tox.logits(*net, one[a:b], two[a:b], np.array([0, b - a]))[0] for a, b in zip(at, at[1:], strict=False)]
    assert np.allclose(whole, alone, atol=1e-5)


def test_quality_grades_on_documents_not_trained_on(spark):
    df, labels = table(spark, "documents", SF), table(spark, "labels", SF).where("quality is not null")
    ratings = labels.select("doc_id", F.col("quality").alias("grade"))
    train = ratings.where(F.col("doc_id") % 3 != 0)
    got = by_id(qc.learn_and_grade(df, train))
    test = {r.doc_id: r.grade for r in ratings.where(F.col("doc_id") % 3 == 0).collect()}
    assert auc([got[i].tail for i in test], [test[i] for i in test]) > 0.85
    good = [i for i in test if test[i] == 1]
    assert np.mean([got[i].kept for i in good]) > 0.95


def test_ordinal_thresholds_are_ordered_and_grades_expected(spark):
    labels = table(spark, "labels", SF)
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 3).otherwise(5)
    few = labels.where("quality is not null and toxic is not null").select(F.col("doc_id").alias("id"), grade.alias("grade"))
    texts = table(spark, "documents", SF).select(F.col("doc_id").alias("id"), "text").join(few, "id").where("id < 3000")
    model = qc.fit_quality(texts, wanted_from=3)
    assert model.grades == [0, 3, 5] and (np.diff(model.thresholds) > 0).all() and model.wanted == 1
    rows = qc.grade_quality(docs(spark), model).collect()
    assert all(0 <= r.expected_grade <= 5 and 0 <= r.tail <= 1 for r in rows) and len(rows) == docs(spark).count()


def test_quality_of_awkward_rows(spark):
    ratings = spark.createDataFrame([(1, 2, "x"), (2, 0, "x"), (2, 1, "x"), (8, 0, "x"), (12, 0, "x"), (None, 1, "x"), (3, None, "x"), (9, 2, "x")], "doc_id long, grade int, kept string")
    rows = qc.learn_and_grade(docs(spark), ratings).collect()
    assert len(rows) == docs(spark).count() and all(r.tail is not None for r in rows)
    assert {(r.tail, r.kept) for r in qc.learn_and_grade(docs(spark), ratings.where("false")).collect()} == {(None, True)}
    assert qc.learn_and_grade(empty(spark), ratings).collect() == []


URLS = [(1, "http://a.org/x", 1), (2, "https://EXAMPLE.org/es/7?q", 1), (3, "https://sub.example.org/en/12", 1), (4, "http://example.org/en/2", 1), (5, "http://b.com/fr/1", 1),
        (6, "http://b.com/de/1#x", 1), (7, "http://b.com/xx", 1), (8, None, 1), (9, "no scheme/path", 1), (10, "http://x.org", 1), (11, "ftp://x.org?q=://y.com/de/", 1),
        (None, "http://notorg/x", 1), (12, "http://b.com/fr/1" + "z" * 50_000, 1), (12, "", 1), (13, "http://xexample.org/es/", 1)]


def test_url_rules_and_parts(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string, score int")
    rows = uf.filter_urls(pages).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows if r.page_id != 12}
    assert len(rows) == len(URLS) and all(r.verdict in ("allow", "block") for r in rows)
    assert got[1] == ("a.org", "/x", "org/", "allow") and got[2] == ("example.org", "/es/7", "example.org/es/", "block")
    assert got[3] == ("sub.example.org", "/en/12", "example.org/en/1", "block") and got[4][2] == "org/"
    assert got[5][2:] == ("com/fr/", "allow") and got[6][2:] == ("com/de/", "block") and got[7][2] is None
    assert got[8][:3] == ("", "", None) and got[9][:3] == ("", "", None) and got[10][:3] == ("x.org", "", None)
    assert got[11][:3] == ("x.org", "", None) and got[None][:3] == ("notorg", "/x", None) and got[13][2] == "org/"
    assert uf.filter_urls(pages.where("false")).collect() == []
    assert {r.verdict for r in uf.filter_urls(pages, rules=()).collect()} == {"allow"}


def test_url_models_count_and_smooth_like_the_definition(spark):
    import math
    from collections import Counter

    pages = table(spark, "pages", "sf0.01")
    host, path = uf.url_parts(F.col("url"))
    judged = pages.select("url", uf.rule_of(host, path)[1].alias("v")).where("v is not null").select("url", (F.col("v") == "allow").alias("allowed"))
    model = uf.fit_urls(judged)
    counts = [Counter(), Counter()]
    for r in judged.collect():
        if zlib.crc32(r.url.encode()) % uf.FOLDS:
            u = r.url.encode().lower()
            for i in range(len(u)):
                for k in range(uf.ORDER + 1):
                    counts[r.allowed][k, u[max(i - k, 0):i], i < k, u[i]] += 1
    seen, kinds = ([Counter(), Counter()] for _ in "12")
    for c in (0, 1):
        for (k, ctx, edge, _), n in counts[c].items():
            seen[c][k, ctx, edge] += n
            kinds[c][k, ctx, edge] += 1

    def p(c, u, i):
        out = 1 / 256
        for k in range(uf.ORDER + 1):
            key = (k, u[max(i - k, 0):i], i < k)
            if seen[c][key]:
                out = (counts[c][*key, u[i]] + kinds[c][key] * out) / (seen[c][key] + kinds[c][key])
        return out

    # Real URLs, judged by a rule or not: few of their grams are new, and only those can take another's bucket.
    texts = ["https://blog.example.com/de/1", "http://x.example.org/en/77"] + [r.url.lower() for r in pages.orderBy("page_id").limit(40).collect()]
    for t in texts:
        u = t.encode()
        want = sum(math.log(p(1, u, i)) - math.log(p(0, u, i)) for i in range(len(u))) / len(u)
        got = uf.score(model, np.frombuffer(u, np.uint8), np.array([0, len(u)]))[0]
        assert abs(got - want) < 0.05


def test_url_verdicts_follow_the_rules_on_urls_not_counted(spark):
    pages = table(spark, "pages", SF)
    rows = uf.filter_urls(pages).join(pages.select("page_id", "url"), "page_id").collect()
    held = [r for r in rows if r.rule and zlib.crc32(r.url.encode()) % uf.FOLDS == 0]
    model = [(r.score, r.verdict == "allow") for r in held]
    assert auc([s for s, _ in model], [int(a) for _, a in model]) > 0.95


def test_url_counts_are_exact_and_grow_with_the_urls(spark, monkeypatch):
    """No two grams share a count, also with far more grams than any fixed table; chunks don't change scores."""
    import math
    from collections import Counter

    rng = np.random.default_rng(8)
    urls = [("http://" + bytes(rng.integers(33, 127, 300).astype(np.uint8)).decode().lower(), bool(k % 2)) for k in range(3000)]
    model = uf.fit_urls(spark.createDataFrame(urls, "url string, allowed boolean").repartition(4))
    counts = [Counter(), Counter()]
    for u, allowed in urls:
        if zlib.crc32(u.encode()) % uf.FOLDS:
            b = u.encode()
            counts[allowed].update((k, b[max(i - k, 0):i], i < k, b[i]) for i in range(len(b)) for k in range(uf.ORDER + 1))
    grams = counts[0].keys() | counts[1].keys()
    assert len(grams) > 2 ** 20 and model.table.where(F.col("key") >= uf.GRAM).count() == len(grams)
    seen, kinds = ([Counter(), Counter()] for _ in "12")
    for c in (0, 1):
        for (*key, _), n in counts[c].items():
            seen[c][tuple(key)] += n
            kinds[c][tuple(key)] += 1

    def want(u):
        total = 0.0
        for i in range(len(u)):
            p = [1 / 256, 1 / 256]
            for k in range(uf.ORDER + 1):
                key = (k, u[max(i - k, 0):i], i < k)
                for c in (0, 1):
                    if seen[c][key]:
                        p[c] = (counts[c][*key, u[i]] + kinds[c][key] * p[c]) / (seen[c][key] + kinds[c][key])
            total += math.log(max(p[1], 1e-12)) - math.log(max(p[0], 1e-12))
        return total / max(len(u), 1)

    rows = spark.createDataFrame([(u, i) for i, (u, _) in enumerate(urls[:60])] + [("", 60), (None, 61), ("é日new", 62)], "url string, id long")
    monkeypatch.setattr(uf, "CHUNK_BYTES", 1000)
    got = uf._with_scores(rows.repartition(2), model).collect()
    assert len(got) == 63 and all(abs(r.score - want((r.url or "").lower().encode())) < 1e-9 for r in got)


def test_url_grams_are_not_broadcast(spark):
    """Neither the grams of the URLs nor the model's table, both of which grow with the input, pass through the driver."""
    urls = [(f"http://{'good' if k % 2 else 'bad'}.example/{k}", bool(k % 2)) for k in range(200)]
    model = uf.fit_urls(spark.createDataFrame(urls, "url string, allowed boolean"))
    scored = uf._with_scores(spark.createDataFrame(urls, "url string, allowed boolean"), model)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    assert "Broadcast" not in scored._jdf.queryExecution().executedPlan().toString() and scored.count() == 200


def test_toxicity_trained_in_parts_sees_every_row(spark, monkeypatch):
    """Five parts, averaged, tell held-out documents; the thresholds count every row held back from training."""
    df, labels = table(spark, "documents", SF), table(spark, "labels", SF)
    seen = {}

    def train_round(rows, params, out_bias, share, epochs, seed, inner=tox._train_round):
        seen.setdefault("rows", rows.count())
        seen["parts"] = rows.select("part").distinct().count()
        return inner(rows, params, out_bias, share, epochs, seed)
    monkeypatch.setattr(tox, "_train_round", train_round)
    got, label = by_id(tox.learn_and_score(df, labels, rows_per_part=500)), {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    used = labels.join(df.select("doc_id"), "doc_id").where("toxic is not null").where(fold("doc_id", 5) != 0)
    back = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0
    assert seen == {"rows": used.where(~back).count(), "parts": 5}
    held = [i for i, r in got.items() if r.held_out and i in label]
    assert auc([got[i].score for i in held], [label[i] for i in held]) > 0.9


def test_toxicity_threshold_of_counts_is_that_of_the_rows():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    z = np.round(rng.normal(size=400) + y, 1)
    at, inverse = np.unique(z, return_inverse=True)
    cut = tox._threshold(at, np.bincount(inverse, y), np.bincount(inverse))

    def f1(c):
        return 2 * (y[z >= c].sum()) / ((z >= c).sum() + y.sum())
    assert f1(cut) == max(f1(c) for c in at)


def test_toxicity_languages_count_every_text(spark):
    rows = [("the cat and the dog " * 3, "en"), ("der Hund und die Katze", "de")] * 40 + [("le chat", None)]
    few = tox._count_languages(spark.createDataFrame(rows, "text string, lang string").repartition(7))
    once = tox._count_languages(spark.createDataFrame(rows[:2], "text string, lang string"))
    assert few.languages == once.languages == ["de", "en"]
    counts = [np.exp(m.logits.astype(float)) / np.exp(m.logits.astype(float)).min(axis=0) * 0.5 - 0.5 for m in (few, once)]
    assert np.allclose(counts[0], 40 * counts[1], rtol=1e-3, atol=1e-2)


def test_toxicity_texts_move_once(spark, monkeypatch):
    """Rows to train on lie by part, so no round shuffles them; each has its id's label, and no other row is there."""
    rows = [(i % 90 if i % 7 else None, f"text {i % 110} of {i}" * 3, "en" if i % 3 else None) for i in range(400)] + [(5, None, "en"), (2 ** 60 + 1, "a b", "en"), (2 ** 60, "c", "en")]
    labels = [(i, i % 2) for i in (*range(0, 60, 1), 2 ** 60 + 1)]
    texts, graded = spark.createDataFrame(rows, "id long, text string, lang string"), spark.createDataFrame(labels, "id long, label int")
    want = sorted(((i, t, g, dict(labels)[i]) for i, t, g in rows if i in dict(labels)), key=str)
    seen = []

    def fitted(rows, fit, cal, *more, inner=tox._fitted):
        seen.append(sorted(map(tuple, rows.select("id", "text", "lang", "label").collect()), key=str))
        seen.append(sorted(map(tuple, fit.select("id", "text", "lang", "label").union(cal.select("id", "text", "lang", "label")).collect()), key=str))
        return inner(rows, fit, cal, *more)

    def train_round(rows, *more, inner=tox._train_round):
        plan = rows.groupBy("part").applyInArrow(lambda t: t.select(["part"]), "part int")._jdf.queryExecution().executedPlan().toString()
        seen.append("Exchange" in plan)
        return inner(rows, *more)
    monkeypatch.setattr(tox, "_fitted", fitted)
    monkeypatch.setattr(tox, "_train_round", train_round)
    assert tox.fit_toxicity(texts, graded, rows_per_part=50)
    assert seen == [want, want] + [False] * tox.ROUNDS
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tillroll_toxicity")]
