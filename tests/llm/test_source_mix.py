import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll.llm.mix_query import SQL, cycling_schedule, op11_source_mix
from tillroll.llm.source_mix import mix_sources, plan_mix

from . import cases

SCHEDULE = "source string, weights array<double>"


def by_hand(rows, weights, repeats=3):
    """Targets by sharing again and again; (doc_id, text) -> words taken, in the fixed order."""
    size = defaultdict(int)
    for _, s, t in rows:
        size[s] += len((t or "").split())
    share = {s: sum(w) / len(w) for s, w in weights.items() if s in size}
    free, left, target = set(share), float(sum(size.values())), {s: 0.0 for s in size}
    while True:
        total = sum(share[s] for s in free)
        over = {s for s in free if total and left * share[s] / total > repeats * size[s]}
        if not over:
            break
        free -= over
        left -= repeats * sum(size[s] for s in over)
        target.update({s: float(repeats * size[s]) for s in over})
    target.update({s: left * share[s] / total if total else 0.0 for s in free})
    taken = {}
    for s in size:
        mine = sorted((hashlib.md5(f"{'' if d is None else d}|{t or ''}".encode()).hexdigest(), d, t) for d, x, t in rows if x == s)
        give = int(target[s] + 1e-6)
        for _ in range(repeats):
            for _, d, t in mine:
                n = min(len((t or "").split()), give)
                taken[d] = taken.get(d, 0) + n
                give -= n
    return target, taken


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_words_taken_match_a_plain_version(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c", None, "ü"] + ["a"] * 5), rnd.choice([None, ""] + ["w " * rnd.randint(1, 60)] * 8)) for i in range(200)]
    weights = {s: [float(rnd.randint(1, 9))] * 2 for s in ["a", "b", "c", None, "unused"]}
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = plan_mix(docs, spark.createDataFrame(list(weights.items()), SCHEDULE)).collect()
    target, taken = by_hand(rows, weights)
    assert {r.doc_id: r.taken for r in out} == taken
    for r in out:
        assert r.target == pytest.approx(target[r.source], rel=1e-9) and r.taken <= 3 * r.size
        assert [c.epoch for c in r.copies] == list(range(len(r.copies))) and sum(c.words for c in r.copies) == r.taken
    assert any(t == 3 * sum(r.size for r in out if r.source == s) > 0 for s, t in target.items())  # some source stops


def test_positions_follow_the_schedule(spark):
    """The words given up to each time, by source, are the integral of its share."""
    rows = [(i, "ab"[i % 2], "w " * 10) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    schedule = spark.createDataFrame([("a", [3.0, 1.0, 0.0]), ("b", [1.0, 1.0, 2.0])], SCHEDULE)
    out = mix_sources(docs, schedule)
    got = out.collect()
    assert [r.position for r in got] == sorted(r.position for r in got) and sum(r.words for r in got) in (19999, 20000)

    def share(u):  # a's share runs 3/4, 1/2, 0
        return 0.75 - 0.5 * u if u < 0.5 else 0.5 - (u - 0.5)

    for u in (0.1, 0.3, 0.5, 0.8, 1.0):
        given = sum(r.words for r in got if r.source == "a" and r.position < u * 20000)
        assert abs(given - 20000 * sum(share((i + 0.5) / 1000 * u) for i in range(1000)) / 1000 * u) <= 20


def test_the_same_whatever_the_partitions(spark):
    docs = cases.table(spark, "documents")
    schedule = cycling_schedule(docs)
    a = plan_mix(docs, schedule, keep=["doc_id"]).orderBy("doc_id").collect()
    spread = docs.repartition(13, F.rand(1))
    assert plan_mix(spread, cycling_schedule(spread), keep=["doc_id"]).orderBy("doc_id").collect() == a
    total = sum(r.size for r in a)
    assert abs(sum(r.taken for r in a) - total) <= 20


def test_awkward_rows_and_empty_tables(spark):
    docs = cases.docs(spark).withColumn("source", F.col("lang")).withColumn("target", F.lit("mine"))
    out = plan_mix(docs, cycling_schedule(docs)).collect()
    assert len(out) == len(cases.TEXTS) and all(r.taken == 0 for r in out if r.text is None or not r.text.split())
    assert {r.size for r in out if r.doc_id == 8} == {40_000} and {r.key for r in out} == {1} and isinstance(out[0].target, float)
    none = cases.empty(spark).withColumn("source", F.col("lang"))
    assert plan_mix(none, cycling_schedule(none)).count() == 0 and mix_sources(none, cycling_schedule(none)).count() == 0
    # Sources that the schedule leaves out, negative, null and no weights: nothing is taken.
    odd = spark.createDataFrame([("en", [-1.0, None]), ("de", [])], SCHEDULE)
    assert {r.taken for r in plan_mix(docs, odd).collect()} == {0}


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    want = con.execute(f"SELECT doc_id, size, source_size, target, taken, first_position, n_copies FROM ({SQL})").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in op11_source_mix(spark, "/root/testdata/sf0.001").collect())
