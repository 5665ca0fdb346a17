"""DuckDB SQL of the operators that SQL can express, built from the same rules and constants."""

from __future__ import annotations

from .quality_rules import CUTOFFS, DELTA, PRICE, RISK, RULES, SYMBOLS
from .secret_scan import BASE
from .secret_scan import RULES as SECRETS

WORD = r"[^\x20\x09-\x0D]"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def quality_rules_sql() -> str:
    grid = ", ".join(f"({c})" for c in CUTOFFS)
    value = f"greatest({', '.join(f'v.{r}' for r in RULES)})"
    hits = ", ".join(f"CASE WHEN v.{r} > b.cutoff THEN {_text(r)} END" for r in RULES)
    columns = ("doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, " + ", ".join(RULES))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '{WORD}+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
win AS (
  SELECT rid, i, ws[i:i+2] AS x FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
twice AS (
  SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
rep AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, unnest([0, 1, 2]) AS u(k) GROUP BY rid),
c AS (
  SELECT w.rid, doc_id, stratum, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
    len(regexp_extract_all(t, '\p{{Lu}}'))::BIGINT AS n_capitals, len(regexp_extract_all(t, '!'))::BIGINT AS n_shouts
  FROM w LEFT JOIN rep USING (rid)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats,
    CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capitals,
    CASE WHEN n_words > 0 THEN n_shouts * 1000 // n_words ELSE 0 END AS shouts
  FROM c),
g AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
x AS (SELECT * FROM (VALUES {grid}) AS t(cutoff)),
cell AS (
  SELECT stratum, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND {value} > cutoff) AS k,
    count(*) FILTER (NOT good AND {value} > cutoff) AS bad
  FROM v JOIN g USING (doc_id), x WHERE NOT base_failed GROUP BY stratum, cutoff),
sure AS (
  SELECT stratum, cutoff, bad - {PRICE} * k AS gain, CASE WHEN k < n * {RISK} THEN
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
      + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) ELSE 1 END AS p
  FROM cell),
sequence AS (
  SELECT *, bool_and(p <= {DELTA} / (SELECT count(DISTINCT stratum) FROM cell)) OVER (PARTITION BY stratum ORDER BY cutoff DESC) AS certified FROM sure),
best AS (
  SELECT stratum, arg_max(cutoff, gain * 100000 + cutoff) AS cutoff FROM sequence WHERE certified AND gain > 0 GROUP BY stratum),
judged AS (
  SELECT v.rid, concat_ws(',', {hits}) AS rejected_by FROM v LEFT JOIN best b ON v.stratum = b.stratum)
SELECT {columns}, rejected_by, NOT base_failed AND rejected_by = '' AS kept FROM v JOIN judged USING (rid)
"""


def secret_scan_sql() -> str:
    parts = []
    for n, r in enumerate(SECRETS):
        p = _text(r.pattern)
        keep = f"length({f'regexp_extract(m, {p}, {r.group})' if r.group else 'm'}) >= {r.least}"
        parts.append(f"""SELECT rid, {n} AS no, '{r.kind}' AS kind, s, s + length(m) AS e FROM (
  SELECT rid, f[i] AS m, coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(f[1:i-1], lambda x: length(x))), 0) AS s
  FROM (SELECT rid, regexp_extract_all(t, {p}) AS f, string_split_regex(t, {p}) AS b FROM d), unnest(range(1, len(f) + 1)) AS u(i))
WHERE {keep}""")
    counts = ", ".join(f"count(*) FILTER (no = {n})::BIGINT AS n_{r.kind}" for n, r in enumerate(BASE))
    joined = "string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, no)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
a AS (SELECT rid, {counts}, {joined} AS spans, {joined} FILTER (no < {len(BASE)}) AS base FROM m GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)
"""


SQL = {"op1_quality_rules": quality_rules_sql(), "op6_secret_scan": secret_scan_sql()}
