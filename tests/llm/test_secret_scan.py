import hashlib
import re

from pyspark.sql import functions as F

from tillroll.llm import secret_scan as ss
from tillroll.llm.queries import op6_secret_scan

from .cases import SCHEMA, docs, empty, table

KEY = "AKIA" + "ABCDEFGH12345678"
TEXTS = [
    (1, f"password: hunter22 then {KEY} and {'0af' * 9}\né token = 'abc' token:token:abcdef"), (2, "PassWord='longenough' API_KEY: zzzzzz apikey=yyyyyy"),
    (3, "-----BEGIN RSA PRIVATE KEY-----\nxx"), (4, "ghp_" + "a1" * 20 + " xoxb-1234567890-abc"), (5, KEY[:19]), (6, None), (7, ""), (None, "secret=abcdefg"),
    (8, "key " * 3000 + "token=abcdef " * 200), (8, "nothing"), (9, "日本語 passwd=日本 passwd=abcdefg"), (10, f"token={KEY}"), (11, "pass word secre t toke n"),
    (12, "eyJhbGciOi12.eyJzdWIiOi12.abcdefgh12 AIza" + "x" * 35), (13, "é" * 50 + "a" * 23 + "g" + "b" * 24),
]


def frame(spark):
    return spark.createDataFrame([(*r, "en", "x", 1, True, "") for r in TEXTS], SCHEMA).repartition(3)


def brute(text):
    return sorted((m.start(), n, m.end()) for n, r in enumerate(ss.RULES) for m in re.finditer(r.pattern, text or "", re.ASCII) if len(m.group(r.group)) >= r.least)


def test_spans_equal_a_full_scan(spark):
    for df in (frame(spark), docs(spark), table(spark, "documents")):
        rows = ss.find_secrets(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert [tuple(x) for x in r["__secrets"]] == brute(r.text), r.doc_id


def test_queries_of_the_rules():
    by = {r.kind: ss.clauses(r.pattern) for r in ss.RULES}
    assert by["hex"] == [] and by["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in by["assign"] and len(by["assign"]) == 6
    assert ss.clauses("ab") == [] and ss.clauses("(abc|x)y") == [] and ss.clauses("(abc)?def") == [frozenset({"def"})]
    assert ss.clauses("abc+d") == [frozenset({"abc"})]


def test_index_finds_every_text_that_matches(spark):
    trigrams, terms = ss._plan(ss.RULES)
    found = {r.id: r.rules for r in ss.candidates(ss.postings(frame(spark), trigrams, "doc_id", "text"), trigrams, terms).collect()}
    for i, t in TEXTS:
        for _, n, _ in brute(t):
            assert n == 2 or found[i] & 1 << n
    assert 5 in found and 7 not in found and 11 not in found


def test_redaction(spark):
    got = {r.doc_id: r.text for r in ss.redact_secrets(frame(spark)).where("doc_id in (1, 6, 7, 10)").collect()}
    assert got[1] == "[SECRET] then [SECRET] and [SECRET]\né token = 'abc' token:token:abcdef"
    assert got[6] is None and got[7] == "" and got[10] == "[SECRET]"
    assert ss.redact_secrets(frame(spark)).columns == frame(spark).columns


def test_digest(spark, tmp_path):
    frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for r in op6_secret_scan(spark, str(tmp_path)).collect():
        options = [t for i, t in TEXTS if i == r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(r.spans.count(k) for k in ("assign:", "access:", "hex:"))
        assert any(r.spans == ",".join(f"{ss.RULES[n].kind}:{a}:{b}" for a, n, b in brute(t))
                   and r.base_sha256 == hashlib.sha256(",".join(f"{ss.RULES[n].kind}:{a}:{b}" for a, n, b in brute(t) if n < 3).encode()).hexdigest() for t in options)


def test_empty_table(spark):
    assert ss.find_secrets(empty(spark)).collect() == []


def test_columns_named_like_the_helpers_stay(spark):
    rows = [(1, "token = abcdefg", "x", 7), (2, "nothing", "y", 8), (None, "password: hunter22", "z", 9), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __rules string, __id int").withColumn("__may", F.lit("m")).withColumn("__map", F.lit(1))
    got = ss.find_secrets(df)
    assert got.columns == [*df.columns, "__secrets"]
    assert sorted(map(repr, got.drop("__secrets").collect())) == sorted(map(repr, df.collect()))
    assert all([tuple(x) for x in r["__secrets"]] == brute(r.text) for r in got.collect())


def test_rows_that_are_no_candidates_are_not_shuffled(spark):
    ids = spark.range(0, 50, 7).toDF("key")
    marked = ss._may_hold(spark.range(1000).toDF("doc_id"), ids, "doc_id", "may")
    may = {r.doc_id for r in marked.where("may").collect()}
    assert {r.key for r in ids.collect()} <= may and len(may) < 20
