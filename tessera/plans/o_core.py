"""Oracle SQL for the queries in q_core."""

from tessera.plans.oracle import sql
from tessera.sources.manifest import MANIFEST_COLUMNS

sql("group_rate_by_size", """
tick AS (SELECT ticket, count(*) AS team_size,
                CAST(sum(label) AS DOUBLE) / nullif(count(label), 0) * 100 AS rate
         FROM manifest GROUP BY ticket),
by_size AS (SELECT m.cls, t.team_size, round(avg(t.rate), 6) AS mean_rate
            FROM manifest m JOIN tick t USING (ticket) GROUP BY m.cls, t.team_size)
SELECT cls, team_size, mean_rate FROM (
  SELECT *, row_number() OVER (PARTITION BY cls ORDER BY mean_rate DESC NULLS LAST, team_size DESC) AS rn
  FROM by_size) WHERE rn <= 3
""")

# ---- 2.1 / 2.2 -------------------------------------------------------------------
sql("read_csv_typed", "SELECT * FROM manifest")
sql("write_csv", "SELECT row_id, label, name FROM manifest WHERE split = 'train'")
sql("union_outer", """
SELECT *, 'labelled' AS dataset FROM manifest WHERE split = 'train'
UNION ALL BY NAME
SELECT * EXCLUDE (label), 'unlabelled' AS dataset FROM manifest WHERE split = 'test'
""")
sql("union_same", """
SELECT row_id, sex, cls FROM manifest WHERE split = 'train'
UNION ALL SELECT row_id, sex, cls FROM manifest WHERE split = 'test'
""")
sql("split_labelled", "SELECT * EXCLUDE (label) FROM manifest WHERE split = 'test'")
sql("keys_in_both", """
SELECT ticket FROM manifest WHERE split = 'train'
INTERSECT SELECT ticket FROM manifest WHERE split = 'test'
""")
sql("distinct_values", "SELECT DISTINCT port FROM manifest")
sql("concat_columns", """
a AS (SELECT row_number() OVER (ORDER BY row_id) AS place, row_id, age, fare FROM manifest),
p AS (SELECT port, row_number() OVER (ORDER BY port) AS code FROM (SELECT DISTINCT port FROM manifest WHERE port IS NOT NULL)),
b AS (SELECT row_number() OVER (ORDER BY m.row_id) AS place, sex, sibs + parch + 1 AS family_size,
             coalesce(CAST(code = 1 AS INTEGER), 0) AS port_1, coalesce(CAST(code = 2 AS INTEGER), 0) AS port_2,
             coalesce(CAST(code = 3 AS INTEGER), 0) AS port_3, coalesce(CAST(code = 4 AS INTEGER), 0) AS port_4,
             coalesce(CAST(code = 5 AS INTEGER), 0) AS port_5
      FROM manifest m LEFT JOIN p USING (port))
SELECT a.* EXCLUDE (place), b.* EXCLUDE (place) FROM a JOIN b USING (place)
""")

# ---- 2.3 profiling ------------------------------------------------------------------
sql("profile_shape", """
SELECT split, count(*) AS n_rows, CASE WHEN split = 'train' THEN 13 ELSE 12 END AS n_cols
FROM manifest GROUP BY split
""")

_DTYPES = {"row_id": "bigint", "split": "string", "label": "int", "cls": "int", "sex": "string",
           "age": "double", "sibs": "bigint", "parch": "bigint", "fare": "double", "port": "string",
           "cabin": "string", "ticket": "string", "name": "string"}
sql("profile_info", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count({c}) AS non_null, '{_DTYPES[c]}' AS dtype FROM manifest"
    for c in MANIFEST_COLUMNS))
sql("profile_missing", " UNION ALL ".join(
    f"SELECT split, '{c}' AS col_name, CAST(count(*) - count({c}) AS BIGINT) AS missing "
    f"FROM manifest GROUP BY split" for c in MANIFEST_COLUMNS if c != "split"))

_NUMERIC = ["row_id", "label", "cls", "age", "sibs", "parch", "fare"]
sql("describe_numeric", " UNION ALL ".join(f"""
SELECT '{c}' AS col_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, round(min(CAST({c} AS DOUBLE)), 6) AS min,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
       round(max(CAST({c} AS DOUBLE)), 6) AS max
FROM manifest WHERE split = 'train'""" for c in _NUMERIC))

_CATEGORICAL = ["split", "sex", "port", "cabin", "ticket", "name"]
sql("describe_categorical", " UNION ALL ".join(f"""
SELECT * FROM (
  SELECT '{c}' AS col_name,
         (SELECT count({c}) FROM manifest WHERE split = 'train') AS count,
         (SELECT count(DISTINCT {c}) FROM manifest WHERE split = 'train') AS "unique",
         {c} AS top, count(*) AS freq
  FROM manifest WHERE split = 'train' AND {c} IS NOT NULL
  GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1)""" for c in _CATEGORICAL))

sql("value_counts", "SELECT port, count(*) AS n FROM manifest WHERE port IS NOT NULL GROUP BY port")
sql("value_share", """
sizes AS (SELECT ticket, count(*) AS team_size FROM manifest GROUP BY ticket),
dist AS (SELECT team_size, count(*) AS n_groups FROM sizes GROUP BY team_size)
SELECT team_size, n_groups, round(CAST(n_groups AS DOUBLE) / (SELECT sum(n_groups) FROM dist) * 100, 6) AS pct
FROM dist
""")
sql("nunique", """
SELECT count(DISTINCT ticket) AS n_ticket, count(DISTINCT port) AS n_port, count(DISTINCT cabin) AS n_cabin
FROM manifest
""")
sql("head_rows", "SELECT * FROM manifest ORDER BY row_id LIMIT 10")
sql("sample_groups", """
keys AS (SELECT ticket, count(*) AS n,
                CAST(('0x' || substr(md5('7:' || ticket), 1, 8)) AS BIGINT) AS h
         FROM manifest GROUP BY ticket),
sampled AS (SELECT * FROM keys ORDER BY h, ticket LIMIT 100),
chosen AS (SELECT ticket FROM sampled WHERE n > 1 ORDER BY h, ticket LIMIT 1)
SELECT row_id, ticket, name FROM manifest WHERE ticket IN (SELECT ticket FROM chosen)
""")
sql("first_multi_group", """
first AS (SELECT ticket FROM manifest GROUP BY ticket HAVING count(*) > 1 ORDER BY ticket LIMIT 1)
SELECT row_id, ticket, name FROM manifest WHERE ticket IN (SELECT ticket FROM first)
""")
sql("get_group", "SELECT row_id, name FROM manifest WHERE cls = 1 AND sex = 'female'")
sql("five_number_summary", """
SELECT cls, round(min(fare), 6) AS lo, round(quantile_cont(fare, 0.25), 6) AS q1,
       round(quantile_cont(fare, 0.5), 6) AS median, round(quantile_cont(fare, 0.75), 6) AS q3,
       round(max(fare), 6) AS hi
FROM manifest GROUP BY cls
""")

# ---- 2.4 projection ----------------------------------------------------------------
sql("select_columns", "SELECT row_id, name, sex FROM manifest")
sql("drop_columns", "SELECT * EXCLUDE (cabin, name, ticket) FROM manifest")
sql("rename_columns", "SELECT * RENAME (sibs AS sib_sp, parch AS par_ch, port AS embarked) FROM manifest")
sql("filter_compare", """
SELECT row_id FROM manifest
WHERE (sex = 'female' AND cls <= 2) OR (NOT (age > 7) AND label <> 0)
""")
sql("filter_in", """
SELECT row_id FROM manifest WHERE port IN ('AUTOMOBILE', 'BUILDING') AND cls IN (1, 2)
""")
sql("filter_between", """
SELECT port, count(*) AS n FROM manifest
WHERE fare BETWEEN 100000 AND 125000 AND port IS NOT NULL GROUP BY port
""")
sql("filter_null", "SELECT row_id, fare FROM manifest WHERE age IS NULL AND split = 'train'")
sql("derive_arith", """
SELECT row_id, sibs + parch + 1 AS family_size, round(fare / (sibs + parch + 1), 6) AS fare_pp,
       round((age + fare) / 2, 6) AS age_fare_mean
FROM manifest
""")
sql("derive_constant", "SELECT row_id, 'manifest' AS dataset, 1 AS one FROM manifest")
sql("cond_assign", """
SELECT row_id,
       CASE WHEN split_part(split_part(name, ', ', 2), '.', 1) = 'Mrs' THEN 1 ELSE 0 END AS is_married,
       CASE WHEN fare > 400000 THEN 400000.0 ELSE fare END AS fare_capped
FROM manifest
""")
sql("cond_select", """
r AS (SELECT *, CASE WHEN age <= 15 THEN 'Child' WHEN sex = 'female' THEN 'Woman' ELSE 'Man' END AS role
      FROM manifest)
SELECT row_id, CASE WHEN role <> 'Woman' THEN 'Not applicable' WHEN label IS NULL THEN 'Unknown'
                    WHEN label = 1 THEN 'Yes' WHEN label = 0 THEN 'No' ELSE '0' END AS outcome
FROM r
""")
sql("cond_mask", "SELECT row_id, CASE WHEN cls = 1 THEN fare END AS fare_first FROM manifest")
sql("patch_rows", """
SELECT row_id, CASE WHEN name LIKE '%(nee%' AND age IS NULL THEN 14.5 ELSE age END AS age FROM manifest
""")

_TITLE_RX = r"regexp_extract(name, ' ([A-Za-z]+)\.', 1)"
_TITLE_COLLAPSED = f"""CASE WHEN t IN ('Lady', 'Countess', 'Capt', 'Col', 'Don', 'Dr', 'Major', 'Rev', 'Sir',
                               'Jonkheer', 'Dona') THEN 'Rare'
            WHEN t IN ('Mlle', 'Ms') THEN 'Miss' WHEN t = 'Mme' THEN 'Mrs' ELSE t END"""
sql("value_map", f"""
t AS (SELECT row_id, sibs + parch + 1 AS family_size, {_TITLE_RX} AS t FROM manifest),
c AS (SELECT row_id, family_size, {_TITLE_COLLAPSED} AS title FROM t)
SELECT row_id, family_size,
       CASE family_size WHEN 1 THEN 'Alone' WHEN 2 THEN 'Small' WHEN 3 THEN 'Small' WHEN 4 THEN 'Small'
                        WHEN 5 THEN 'Medium' WHEN 6 THEN 'Medium' WHEN 7 THEN 'Large' WHEN 8 THEN 'Large'
                        WHEN 11 THEN 'Large' END AS size_group,
       COALESCE(CASE title WHEN 'Mr' THEN 1 WHEN 'Miss' THEN 2 WHEN 'Mrs' THEN 3 WHEN 'Master' THEN 4
                           WHEN 'Rare' THEN 5 END, 0) AS title_code
FROM c
""")
sql("value_collapse", f"""
t AS (SELECT row_id, COALESCE(substr(cabin, 1, 1), 'M') AS d, {_TITLE_RX} AS t FROM manifest)
SELECT row_id,
       CASE WHEN d IN ('A', 'B', 'C', 'T') THEN 'ABC' WHEN d IN ('D', 'E') THEN 'DE'
            WHEN d IN ('F', 'G') THEN 'FG' ELSE d END AS deck,
       {_TITLE_COLLAPSED} AS title
FROM t
""")
sql("cast_types", """
SELECT row_id, CAST(trunc(fare) AS INTEGER) AS fare_int, TRY_CAST(ticket AS BIGINT) AS ticket_no,
       CAST(cls AS VARCHAR) AS cls_str
FROM manifest
""")

# ---- 2.5 strings --------------------------------------------------------------------
sql("str_trailing_number", r"""
SELECT row_id, COALESCE(TRY_CAST(NULLIF(regexp_extract(ticket, '(\d+)$', 1), '') AS BIGINT), -1) AS ticket_num
FROM manifest
""")
sql("str_prefix", r"""
SELECT row_id, COALESCE(NULLIF(regexp_extract(ticket, '(.*) \d+$', 1), ''), 'M') AS ticket_prefix FROM manifest
""")
sql("str_first_char", "SELECT row_id, COALESCE(substr(cabin, 1, 1), 'M') AS deck FROM manifest")
sql("str_last_name", "SELECT row_id, NULLIF(regexp_extract(name, '^(.+?),', 1), '') AS last_name FROM manifest")
sql("str_title_split", "SELECT row_id, split_part(split_part(name, ', ', 2), '.', 1) AS title FROM manifest")
sql("str_title_regex", f"SELECT row_id, {_TITLE_RX} AS title FROM manifest")
sql("str_surname_clean", r"""
SELECT row_id, trim(regexp_replace(split_part(split_part(name, '(', 1), ',', 1), '[!-/:-@\[-`{-~]', '', 'g'))
       AS family
FROM manifest
""")

# ---- 2.6 bins -------------------------------------------------------------------------
sql("bin_explicit", """
b AS (SELECT row_id, CASE WHEN age > 0 AND age <= 16 THEN 0 WHEN age > 16 AND age <= 32 THEN 1
                          WHEN age > 32 AND age <= 48 THEN 2 WHEN age > 48 AND age <= 64 THEN 3
                          WHEN age > 64 AND age <= 80 THEN 4 END AS age_bin FROM manifest)
SELECT row_id, age_bin, CAST(([0, 16, 32, 48, 64])[age_bin + 1] AS DOUBLE) AS age_bin_lo,
       CAST(([16, 32, 48, 64, 80])[age_bin + 1] AS DOUBLE) AS age_bin_hi
FROM b
""")
sql("bin_equal_width", """
r AS (SELECT min(fare) AS lo, max(fare) AS hi FROM manifest)
SELECT row_id, CASE WHEN fare IS NOT NULL THEN
         CAST(least(greatest(ceil((fare - lo) / ((hi - lo) / 5)), 1), 5) - 1 AS INTEGER) END AS fare_bin
FROM manifest, r
""")
sql("bin_quantile", """
e AS (SELECT quantile_cont(fare, [0.0, 1/13, 2/13, 3/13, 4/13, 5/13, 6/13, 7/13, 8/13, 9/13, 10/13, 11/13,
                                  12/13, 1.0]) AS q FROM manifest)
SELECT row_id, CASE WHEN fare IS NOT NULL THEN
         CAST(len(list_filter(q[2:13], lambda x: fare > x)) AS INTEGER) END AS fare_bin
FROM manifest, e
""")
sql("bin_floor", "SELECT row_id, CAST(floor(age / 15) * 15 AS DOUBLE) AS age_bucket FROM manifest")
sql("bin_threshold", """
SELECT row_id,
  CASE WHEN age IS NULL THEN NULL WHEN age <= 16 THEN 0 WHEN age <= 32 THEN 1 WHEN age <= 48 THEN 2
       WHEN age <= 64 THEN 3 ELSE 4 END AS age_code,
  CASE WHEN fare IS NULL THEN NULL WHEN fare / 10000 <= 7.91 THEN 0 WHEN fare / 10000 <= 14.454 THEN 1
       WHEN fare / 10000 <= 31 THEN 2 ELSE 3 END AS fare_code
FROM manifest
""")
sql("histogram_facet", """
h AS (SELECT cls, sex, CAST(least(floor(age / 5), 14) * 5 AS INTEGER) AS bin_lo FROM manifest
      WHERE age >= 0 AND age <= 75),
c AS (SELECT cls, sex, bin_lo, count(*) AS cnt FROM h GROUP BY ALL),
t AS (SELECT cls, sex, count(*) AS n FROM h GROUP BY ALL)
SELECT cls, sex, bin_lo, cnt, round(CAST(cnt AS DOUBLE) / (n * 5), 6) AS density FROM c JOIN t USING (cls, sex)
""")
