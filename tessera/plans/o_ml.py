"""Oracles of the fitted-model queries whose answer SQL can state: naive Bayes and
ridge-free linear algebra over few sums.  The feature rows are restated from the
manifest; class moments, scores and predictions follow from them."""

from __future__ import annotations

from tessera.functions.fixed import RARE_TITLES, TITLE_CODES
from tessera.plans.oracle import sql

_TITLE = "regexp_extract(name, ' ([A-Za-z]+)\\.', 1)"
_CODES = " ".join(f"WHEN '{t}' THEN {c}" for t, c in TITLE_CODES.items())
_RARE = ", ".join(f"'{t}'" for t in RARE_TITLES)
#: One row per manifest row with its features in order (x), filled from the train part.
FEATURE_ROWS = f"""
tr AS (SELECT * FROM manifest WHERE split = 'train'),
ages AS (SELECT sex, cls, quantile_cont(age, 0.5) AS fill FROM tr GROUP BY sex, cls),
fares AS (SELECT quantile_cont(fare, 0.5) AS fill FROM tr),
top_port AS (SELECT port AS fill FROM tr WHERE port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1),
ports AS (SELECT port, row_number() OVER (ORDER BY port) - 1 AS code FROM (SELECT DISTINCT port FROM tr WHERE port IS NOT NULL)),
titled AS (SELECT *, {_TITLE} AS raw FROM manifest),
feat AS (
  SELECT m.row_id, m.split, CAST(m.label AS DOUBLE) AS label,
         [CAST(m.cls AS DOUBLE), CAST(m.sex = 'male' AS DOUBLE), coalesce(m.age, a.fill), CAST(m.sibs AS DOUBLE), CAST(m.parch AS DOUBLE),
          coalesce(m.fare, f.fill) / 1000.0, CAST(coalesce(p.code, (SELECT count(*) FROM ports)) AS DOUBLE),
          CAST(CASE CASE WHEN raw IN ({_RARE}) THEN 'Rare' WHEN raw IN ('Mlle', 'Ms') THEN 'Miss' WHEN raw = 'Mme' THEN 'Mrs' ELSE raw END
               {_CODES} ELSE 0 END AS DOUBLE),
          CAST(m.sibs + m.parch + 1 AS DOUBLE), CAST(m.sibs + m.parch = 0 AS DOUBLE)] AS x
  FROM titled m JOIN ages a ON a.sex = m.sex AND a.cls = m.cls CROSS JOIN fares f CROSS JOIN top_port t
  LEFT JOIN ports p ON p.port = coalesce(m.port, t.fill))"""

#: Gaussian and Bernoulli naive Bayes of the rows of ``fit``, for the rows of ``ask``.
BAYES = """
long AS (SELECT row_id, label, i, x[i] AS v FROM fit, range(1, 11) r(i)),
least AS (SELECT i, min(v) AS least FROM long GROUP BY i),
extra AS (SELECT 1e-9 * max(s) AS extra FROM (SELECT var_pop(v) AS s FROM long GROUP BY i)),
cm AS (SELECT label AS c, i, count(*) AS n, avg(v) AS mu, var_pop(v) + any_value(extra) AS var, count(*) FILTER (v > least) AS above
       FROM long JOIN least USING (i) CROSS JOIN extra GROUP BY ALL),
total AS (SELECT count(*) AS total FROM fit),
scored AS (
  SELECT a.row_id, c, any_value(ln(n / total)) AS prior,
         sum(-0.5 * ln(2 * pi() * var) - 0.5 * (x[i] - mu) * (x[i] - mu) / var) AS g,
         sum(CASE WHEN x[i] > least THEN ln((above + 1) / (n + 2)) ELSE ln(1 - (above + 1) / (n + 2)) END) AS b
  FROM ask a, cm JOIN least USING (i) CROSS JOIN total GROUP BY a.row_id, c),
bayes AS (SELECT row_id, CAST(max_by(c, struct_pack(s := prior + g, o := -c)) AS INTEGER) AS gaussian_nb,
                 CAST(max_by(c, struct_pack(s := prior + b, o := -c)) AS INTEGER) AS bernoulli_nb FROM scored GROUP BY row_id)"""

sql("clf_nb", f"""{FEATURE_ROWS},
fit AS (SELECT * FROM feat WHERE label IS NOT NULL), ask AS (SELECT * FROM feat WHERE label IS NULL), {BAYES}
SELECT row_id, gaussian_nb AS prediction, bernoulli_nb FROM bayes""")

sql("accuracy", f"""{FEATURE_ROWS},
parts AS (SELECT *, CAST(('0x' || substr(md5('7:' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.2 AS held
          FROM feat WHERE label IS NOT NULL),
fit AS (SELECT * FROM parts WHERE NOT held), ask AS (SELECT * FROM parts WHERE held), {BAYES}
SELECT 'gaussian_nb' AS model, round(avg(CAST(gaussian_nb = label AS DOUBLE)), 6) AS accuracy, count(*) AS n_test
FROM bayes JOIN ask USING (row_id)""")

#: Discriminant analysis: a covariance matrix per class (kind: its label) and the
#: pooled one (kind -1) are inverted by elimination, a pivot per step.
sql("clf_lda_qda", f"""{FEATURE_ROWS},
fit AS (SELECT * FROM feat WHERE label IS NOT NULL),
cls_n AS (SELECT label AS c, count(*) AS n, (SELECT count(*) FROM fit) AS total FROM fit GROUP BY label),
mu AS (SELECT c, list(m ORDER BY i) AS mu FROM (SELECT label AS c, i, avg(x[i]) AS m FROM fit, range(1, 11) r(i) GROUP BY ALL) GROUP BY c),
pairs AS (SELECT label AS c, i, j, count(*) * covar_pop(x[i], x[j]) AS s FROM fit, range(1, 11) r(i), range(1, 11) q(j) GROUP BY ALL),
cov AS (
  SELECT c AS kind, i, j, s / (n - 1) + CASE WHEN i = j THEN 1e-6 ELSE 0 END AS v FROM pairs JOIN cls_n USING (c)
  UNION ALL
  SELECT -1.0, i, j, sum(s) / (any_value(total) - count(*)) + CASE WHEN i = j THEN 1e-6 ELSE 0 END FROM pairs JOIN cls_n USING (c) GROUP BY i, j),
start AS (
  SELECT kind, list(list_concat(r, list_transform(range(1, 11), lambda k: CAST(k = i AS DOUBLE))) ORDER BY i) AS m
  FROM (SELECT kind, i, list(v ORDER BY j) AS r FROM cov GROUP BY kind, i) GROUP BY kind),
steps AS (
  SELECT kind, 0 AS k, m, 0.0::DOUBLE AS logdet FROM start
  UNION ALL
  SELECT kind, k + 1,
         list_transform(m, lambda r, i: list_transform(r, lambda v, j:
           CASE WHEN i = k + 1 THEN v / m[k + 1][k + 1] ELSE v - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1] END)),
         logdet + ln(m[k + 1][k + 1])
  FROM steps WHERE k < 10),
inv AS (SELECT kind, logdet, list_transform(m, lambda r: r[11:20]) AS a FROM steps WHERE k = 10),
scored AS (
  SELECT f.row_id, n.c, i.kind, ln(n / total) - CASE WHEN i.kind < 0 THEN 0 ELSE 0.5 * logdet END
         - 0.5 * list_sum(list_transform(range(1, 11), lambda p: list_sum(list_transform(range(1, 11), lambda q:
             (x[p] - mu[p]) * a[p][q] * (x[q] - mu[q]))))) AS s
  FROM feat f, cls_n n JOIN mu USING (c) JOIN inv i ON i.kind IN (-1.0, n.c) WHERE f.label IS NULL)
SELECT row_id, CAST(max_by(c, struct_pack(s := s, o := -c)) FILTER (kind >= 0) AS INTEGER) AS prediction,
       CAST(max_by(c, struct_pack(s := s, o := -c)) FILTER (kind < 0) AS INTEGER) AS lda
FROM scored GROUP BY row_id""")
