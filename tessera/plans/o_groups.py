"""Oracle SQL for q_groups."""

from tessera.plans.oracle import sql

_RATE = "CAST(sum(label) AS DOUBLE) / nullif(count(label), 0) * 100"
_NUM = r"COALESCE(TRY_CAST(NULLIF(regexp_extract(ticket, '(\d+)$', 1), '') AS BIGINT), -1)"
_PREFIX = r"COALESCE(NULLIF(regexp_extract(ticket, '(.*) \d+$', 1), ''), 'M')"
_DECADE = """CASE WHEN age > 0 AND age <= 10 THEN 0 WHEN age > 10 AND age <= 20 THEN 1
  WHEN age > 20 AND age <= 30 THEN 2 WHEN age > 30 AND age <= 40 THEN 3 WHEN age > 40 AND age <= 50 THEN 4
  WHEN age > 50 AND age <= 60 THEN 5 WHEN age > 60 AND age <= 70 THEN 6 END"""

# ---- 2.7 ------------------------------------------------------------------------------
sql("agg_mean_by", """
SELECT cls, sex, round(avg(fare), 6) AS mean_fare, round(avg(age), 6) AS mean_age FROM manifest GROUP BY cls, sex
""")
sql("agg_rate_nullaware", f"SELECT ticket, round({_RATE}, 6) AS rate FROM manifest GROUP BY ticket")
sql("agg_size_vs_count", """
g AS (SELECT ticket, count(*) AS team_size, count(label) AS n_labelled FROM manifest GROUP BY ticket)
SELECT ticket, team_size, n_labelled, team_size > 5 AS big_by_size, n_labelled > 5 AS big_by_count
FROM g WHERE team_size > 5 OR n_labelled > 5
""")
sql("agg_mean_of_means", f"""
g AS (SELECT ticket, count(*) AS team_size, {_RATE} AS rate FROM manifest GROUP BY ticket)
SELECT team_size, round(avg(rate), 6) AS mean_rate FROM g GROUP BY team_size
""")
sql("agg_median_by", """
SELECT cls, parch, sibs, round(median(fare), 6) AS median_fare FROM manifest
GROUP BY cls, parch, sibs HAVING count(fare) > 0
""")
sql("agg_first_by", """
f AS (SELECT ticket, cabin, row_number() OVER (PARTITION BY ticket ORDER BY row_id) AS rn
      FROM manifest WHERE cabin IS NOT NULL)
SELECT t.ticket, f.cabin AS first_cabin FROM (SELECT DISTINCT ticket FROM manifest) t
LEFT JOIN f ON f.ticket = t.ticket AND f.rn = 1
""")
sql("agg_nunique_by", """
g AS (SELECT ticket, count(DISTINCT sibs) AS n_distinct FROM manifest WHERE age <= 15 AND sibs > 0 GROUP BY ticket)
SELECT n_distinct, count(*) AS n_groups FROM g GROUP BY n_distinct
""")
sql("agg_any_by", """
g AS (SELECT ticket, bool_or(COALESCE(age <= 15 AND label = 1, false)) AS child_survived
      FROM manifest GROUP BY ticket)
SELECT child_survived, count(*) AS n_groups FROM g GROUP BY child_survived
""")
sql("agg_multi_by", "SELECT ticket, max(parch) AS max_parch, min(sibs) AS min_sibs FROM manifest GROUP BY ticket")

_GRID = f"""
b AS (SELECT *, {_DECADE} AS age_bin FROM manifest),
grid AS (SELECT * FROM (SELECT DISTINCT cls FROM manifest) CROSS JOIN (SELECT DISTINCT sex FROM manifest)
         CROSS JOIN (SELECT unnest(range(0, 7)) AS age_bin))"""
sql("agg_by_bin", _GRID.strip() + """,
s AS (SELECT cls, sex, age_bin, CAST(sum(label) AS BIGINT) AS survivors FROM b WHERE age_bin IS NOT NULL
      GROUP BY ALL)
SELECT g.cls, g.sex, CAST(g.age_bin AS INTEGER) AS age_bin, CAST(COALESCE(s.survivors, 0) AS BIGINT) AS survivors
FROM grid g LEFT JOIN s USING (cls, sex, age_bin)
""")
sql("agg_label_counts", """
SELECT cls, sex, CAST(sum(label) AS BIGINT) AS survivors, count(label) AS n_labelled FROM manifest GROUP BY cls, sex
""")
sql("agg_parent_total", "SELECT cls, count(label) AS n_labelled FROM manifest GROUP BY cls")
sql("agg_ratio_child", """
SELECT cls, sex, round(CAST(sum(label) AS DOUBLE) / nullif(count(label), 0), 6) AS rate FROM manifest GROUP BY cls, sex
""")
sql("agg_ratio_parent", """
c AS (SELECT cls, sex, sum(label) AS c FROM manifest GROUP BY cls, sex),
d AS (SELECT cls, count(label) AS d FROM manifest GROUP BY cls)
SELECT cls, sex, round(CAST(c AS DOUBLE) / nullif(d, 0), 6) AS share FROM c JOIN d USING (cls)
""")
sql("agg_global_scalars", """
SELECT round(avg(age), 6) AS mean_age, round(stddev_samp(age), 6) AS std_age,
       CAST(count(*) - count(age) AS BIGINT) AS null_age, round(median(age), 6) AS median_age
FROM manifest WHERE split = 'train'
""")
sql("agg_mode", " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS col_name, {c} AS mode_value, count(*) AS freq FROM manifest
               WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
                                   for c in ["port", "cabin", "sex"]))
sql("topn_value_counts_by", """
b AS (SELECT cls, CASE WHEN fare > 0 AND fare <= 100000 THEN 0 WHEN fare > 100000 AND fare <= 200000 THEN 1
                       WHEN fare > 200000 AND fare <= 300000 THEN 2 WHEN fare > 300000 AND fare <= 400000 THEN 3
                       WHEN fare > 400000 AND fare <= 500000 THEN 4 WHEN fare > 500000 AND fare <= 600000 THEN 5
                  END AS fare_bin, port FROM manifest),
c AS (SELECT cls, fare_bin, port, count(*) AS cnt FROM b WHERE port IS NOT NULL AND fare_bin IS NOT NULL GROUP BY ALL)
SELECT cls, fare_bin, port, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY cls, fare_bin ORDER BY cnt DESC, port) AS rn FROM c) WHERE rn <= 3
""")

# ---- 2.8 --------------------------------------------------------------------------------
sql("win_group_size", "SELECT row_id, count(*) OVER (PARTITION BY ticket) AS team_size FROM manifest")
sql("win_group_count", "SELECT row_id, count(label) OVER (PARTITION BY ticket) AS n_labelled FROM manifest")
sql("win_group_max", """
SELECT row_id, max(CASE WHEN age <= 15 THEN sibs ELSE 0 END) OVER (PARTITION BY ticket) AS child_sibs FROM manifest
""")
sql("win_nunique_gt1", f"""
t AS (SELECT row_id, {_NUM} AS ticket_num, {_PREFIX} AS ticket_prefix FROM manifest),
w AS (SELECT *, count(DISTINCT ticket_prefix) OVER (PARTITION BY ticket_num) AS k FROM t)
SELECT row_id, ticket_num, ticket_prefix FROM w WHERE k > 1
""")
sql("win_count_if", """
SELECT row_id, count(*) FILTER (WHERE age <= 15) OVER (PARTITION BY ticket) AS n_child FROM manifest
""")
sql("win_any", """
SELECT row_id, bool_or(COALESCE(age <= 15, false)) OVER (PARTITION BY ticket) AS has_child FROM manifest
""")
sql("win_first_nonnull", f"""
t AS (SELECT row_id, cabin, {_NUM} AS ticket_num FROM manifest),
f AS (SELECT ticket_num, cabin, row_number() OVER (PARTITION BY ticket_num ORDER BY row_id) AS rn
      FROM t WHERE cabin IS NOT NULL)
SELECT t.row_id, COALESCE(f.cabin, 'Not Applicable') AS first_cabin FROM t LEFT JOIN f
  ON f.ticket_num = t.ticket_num AND f.rn = 1
""")
sql("win_credibility", """
SELECT row_id, round(CAST(count(label) OVER (PARTITION BY ticket) AS DOUBLE) / count(*) OVER (PARTITION BY ticket), 6)
  AS credibility FROM manifest
""")
sql("win_weighted_rate", f"""
g AS (SELECT ticket, CAST(count(label) AS DOUBLE) / count(*) AS credibility, {_RATE} AS rate
      FROM manifest GROUP BY ticket)
SELECT row_id, round(credibility * rate, 6) AS weighted_rate FROM manifest JOIN g USING (ticket)
""")
sql("topn_per_group", f"""
t AS (SELECT ticket, round({_RATE}, 6) AS rate, count(*) AS team_size FROM manifest GROUP BY ticket),
p AS (SELECT DISTINCT cls, ticket FROM manifest)
SELECT cls, ticket, rate, team_size FROM (
  SELECT p.cls, t.*, row_number() OVER (PARTITION BY p.cls ORDER BY t.rate DESC NULLS LAST, t.team_size DESC,
                                        t.ticket) AS rn
  FROM p JOIN t USING (ticket)) WHERE rn <= 3
""")

# ---- 2.9 ----------------------------------------------------------------------------------
sql("join_agg_back_inner", f"""
g AS (SELECT ticket, {_RATE} AS rate FROM manifest GROUP BY ticket)
SELECT row_id, ticket, round(rate, 6) AS rate FROM manifest JOIN g USING (ticket)
""")
sql("join_agg_back_left", """
g AS (SELECT ticket, max(parch) AS max_parch, min(sibs) AS min_sibs FROM manifest GROUP BY ticket)
SELECT row_id, max_parch, min_sibs FROM manifest LEFT JOIN g USING (ticket)
""")
sql("join_lookup_default", """
t AS (SELECT * FROM manifest WHERE split = 'train'),
r AS (SELECT ticket, avg(label) AS r FROM t GROUP BY ticket HAVING count(label) >= 2)
SELECT row_id, round(COALESCE(r.r, (SELECT avg(label) FROM t)), 6) AS ticket_rate,
       CASE WHEN r.r IS NOT NULL THEN 1 ELSE 0 END AS ticket_hit
FROM manifest m LEFT JOIN r USING (ticket)
""")
sql("join_semi", """
SELECT row_id FROM manifest WHERE split = 'train'
  AND ticket IN (SELECT ticket FROM manifest WHERE split = 'test')
""")

# ---- 2.10 ---------------------------------------------------------------------------------
sql("sort_multi", "SELECT row_id, cls, fare FROM manifest ORDER BY cls, fare DESC NULLS LAST, row_id")
sql("sort_head", "SELECT row_id, fare FROM manifest ORDER BY fare DESC NULLS LAST, row_id LIMIT 10")

# ---- 2.11 ---------------------------------------------------------------------------------
sql("melt", """
SELECT row_id, 'age' AS variable, age AS value FROM manifest
UNION ALL SELECT row_id, 'fare' AS variable, fare AS value FROM manifest
""")
_SURV = f"""
b AS (SELECT *, {_DECADE} AS age_bin FROM manifest),
s AS (SELECT cls, age_bin, CAST(sum(label) FILTER (WHERE sex = 'female') AS BIGINT) AS female,
             CAST(sum(label) FILTER (WHERE sex = 'male') AS BIGINT) AS male
      FROM b WHERE age_bin IS NOT NULL GROUP BY cls, age_bin)"""
sql("pivot_sum", _SURV.strip() + "\nSELECT cls, CAST(age_bin AS INTEGER) AS age_bin, female, male FROM s")
sql("stack_long", _SURV.strip() + """
SELECT cls, CAST(age_bin AS INTEGER) AS age_bin, 'female' AS sex, female AS survivors FROM s
UNION ALL SELECT cls, CAST(age_bin AS INTEGER) AS age_bin, 'male' AS sex, male AS survivors FROM s
""")
sql("grid_complete", _GRID.strip() + """,
s AS (SELECT cls, sex, age_bin, count(*) AS n FROM b WHERE age_bin IS NOT NULL GROUP BY ALL)
SELECT g.cls, g.sex, CAST(g.age_bin AS INTEGER) AS age_bin, CAST(COALESCE(s.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN s USING (cls, sex, age_bin)
""")
sql("stacked_total", _GRID.strip() + """,
s AS (SELECT cls, sex, age_bin, CAST(sum(label) AS BIGINT) AS survivors FROM b WHERE age_bin IS NOT NULL GROUP BY ALL),
f AS (SELECT g.cls, g.sex, g.age_bin, COALESCE(s.survivors, 0) AS v FROM grid g LEFT JOIN s USING (cls, sex, age_bin)),
w AS (SELECT cls, age_bin, sum(v) FILTER (WHERE sex = 'female') AS female, sum(v) FILTER (WHERE sex = 'male') AS male
      FROM f GROUP BY cls, age_bin)
SELECT cls, CAST(age_bin AS INTEGER) AS age_bin, 'female' AS sex, CAST(female + male AS BIGINT) AS survivors FROM w
UNION ALL SELECT cls, CAST(age_bin AS INTEGER) AS age_bin, 'male' AS sex, CAST(male AS BIGINT) AS survivors FROM w
""")
sql("param_sweep_rate", """
c AS (SELECT unnest(range(1, 30)) AS cutoff),
r AS (SELECT CAST(c.cutoff AS INTEGER) AS cutoff,
             CASE WHEN m.age <= c.cutoff THEN 'Child' WHEN m.sex = 'female' THEN 'Woman' ELSE 'Man' END AS role,
             m.label FROM manifest m CROSS JOIN c)
SELECT cutoff, role, round(CAST(sum(label) AS DOUBLE) / nullif(count(label), 0), 6) AS rate FROM r GROUP BY ALL
""")

# ---- 2.12 -------------------------------------------------------------------------------------
sql("impute_constant", "SELECT row_id, COALESCE(port, 'S') AS port FROM manifest")
sql("impute_global_median", """
SELECT row_id, COALESCE(age, (SELECT median(age) FROM manifest WHERE split = 'train')) AS age FROM manifest
""")
sql("impute_mode", """
pm AS (SELECT port AS v FROM manifest WHERE split = 'train' AND port IS NOT NULL
       GROUP BY port ORDER BY count(*) DESC, port LIMIT 1),
cm AS (SELECT cabin AS v FROM manifest WHERE split = 'train' AND cabin IS NOT NULL
       GROUP BY cabin ORDER BY count(*) DESC, cabin LIMIT 1)
SELECT row_id, COALESCE(port, (SELECT v FROM pm)) AS port, COALESCE(cabin, (SELECT v FROM cm)) AS cabin FROM manifest
""")
sql("impute_group_median", """
SELECT row_id, COALESCE(age, median(age) OVER (PARTITION BY sex, cls)) AS age FROM manifest
""")
sql("impute_cell_median", """
SELECT row_id, round(COALESCE(fare, (SELECT median(fare) FROM manifest WHERE cls = 3 AND parch = 0 AND sibs = 0)), 6)
  AS fare FROM manifest
""")
sql("impute_random_range", """
s AS (SELECT CAST(trunc(avg(age) - stddev_samp(age)) AS BIGINT) AS lo,
             CAST(trunc(avg(age) + stddev_samp(age)) AS BIGINT) AS hi FROM manifest WHERE split = 'train')
SELECT row_id, CAST(COALESCE(CAST(trunc(age) AS BIGINT),
    lo + CAST(('0x' || substr(md5('42:' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) % (hi - lo)) AS INTEGER) AS age
FROM manifest, s
""")
