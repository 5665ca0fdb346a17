"""Collocations of ``documents``: query and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .collocations import LEAST, SHARE, TOP, mine_collocations
from .util import table


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"))


_SCORE = "(1000000::HUGEINT * {0} * {0}) // ({1}::HUGEINT * {2})"
_UPPER = "".join(map(chr, range(65, 91)))
#: Counts by grouping every word, pair and triple.
SQL = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
t AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM pieces, unnest(range(1, len(w) + 1)) AS u(i)),
f1 AS (SELECT lang, w1, count(*) AS f FROM t GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM t WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM t WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
inside AS (
  SELECT lang, w1, w2, max(f) AS longer FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
c2 AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r, {_SCORE.format('f2.f', 'x.f', 'y.f')} AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN inside i ON i.lang = f2.lang AND i.w1 = f2.w1 AND i.w2 = f2.w2
  WHERE i.longer IS NULL OR 100 * i.longer < {SHARE} * f2.f),
c3 AS (
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, x.f AS x, yz.f AS yz, xy.f AS xy, z.f AS z,
    {_SCORE.format('f3.f', 'x.f', 'yz.f')} AS s1, {_SCORE.format('f3.f', 'xy.f', 'z.f')} AS s2
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f1 z ON z.lang = f3.lang AND z.w1 = f3.w3
  JOIN f2 xy ON xy.lang = f3.lang AND xy.w1 = f3.w1 AND xy.w2 = f3.w2 JOIN f2 yz ON yz.lang = f3.lang AND yz.w1 = f3.w2 AND yz.w2 = f3.w3),
c AS (
  SELECT * FROM c2 UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN x ELSE xy END, CASE WHEN s1 <= s2 THEN yz ELSE z END, least(s1, s2) FROM c3)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM c JOIN n USING (lang) QUALIFY rank <= {TOP}
"""
