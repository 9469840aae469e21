"""Oracle SQL for q_features."""

from tessera.plans.oracle import sql

_NUM = r"COALESCE(TRY_CAST(NULLIF(regexp_extract(ticket, '(\d+)$', 1), '') AS BIGINT), -1)"
_DECK = "COALESCE(substr(cabin, 1, 1), 'M')"
_SURNAME = r"trim(regexp_replace(split_part(split_part(name, '(', 1), ',', 1), '[!-/:-@\[-`{-~]', '', 'g'))"


def _codes(col, src="manifest", expr=None, where="TRUE"):
    e = expr or col
    return (f"c_{col} AS (SELECT v AS {col}, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS {col}_code "
            f"FROM (SELECT DISTINCT {e} AS v FROM {src} WHERE {where} AND {e} IS NOT NULL))")


# ---- 2.13 ------------------------------------------------------------------------------
sql("label_encode", ",\n".join([_codes("port"), _codes("sex"), _codes("cabin")]) + """
SELECT row_id, port_code, sex_code, cabin_code FROM manifest
LEFT JOIN c_port USING (port) LEFT JOIN c_sex USING (sex) LEFT JOIN c_cabin USING (cabin)
""")
sql("minmax_scale", """
s AS (SELECT min(fare) AS lo, max(fare) AS hi FROM manifest)
SELECT row_id, round((fare - lo) / nullif(hi - lo, 0), 6) AS fare_scaled FROM manifest, s
""")
sql("standard_scale", """
s AS (SELECT avg(fare) AS mu, stddev_pop(fare) AS sd FROM manifest WHERE split = 'train')
SELECT row_id, round((fare - mu) / nullif(sd, 0), 6) AS fare_std FROM manifest, s
""")
sql("encode_ordinal", f"""
b AS (SELECT *, {_DECK} AS deck FROM manifest),
""" + ",\n".join([_codes("sex", "b", where="split = 'train'"), _codes("deck", "b", where="split = 'train'"),
                  _codes("cls", "b", where="split = 'train'")]) + """
SELECT row_id, sex_code, deck_code, cls_code FROM b
LEFT JOIN c_sex USING (sex) LEFT JOIN c_deck USING (deck) LEFT JOIN c_cls USING (cls)
""")
sql("encode_onehot_sparse", f"""
b AS (SELECT *, {_DECK} AS deck FROM manifest),
""" + ",\n".join([_codes("cls", "b"), _codes("sex", "b"), _codes("deck", "b")]) + """,
n AS (SELECT (SELECT count(*) FROM c_cls) AS n_cls, (SELECT count(*) FROM c_sex) AS n_sex,
             (SELECT count(*) FROM c_deck) AS n_deck)
SELECT row_id, CAST(n_cls + n_sex + n_deck AS INTEGER) AS vec_size,
       [cls_code, CAST(n_cls + sex_code AS INTEGER), CAST(n_cls + n_sex + deck_code AS INTEGER)] AS active_idx
FROM b JOIN c_cls USING (cls) JOIN c_sex USING (sex) JOIN c_deck USING (deck), n
""")
sql("encode_onehot_dense", _codes("port") + """
SELECT row_id, """ + ", ".join(
    f"CASE WHEN port_code = {i} THEN 1 ELSE 0 END AS port_{i + 1}" for i in range(5)) + """
FROM manifest LEFT JOIN c_port USING (port)
""")
sql("encode_unknown", """
SELECT row_id, CASE WHEN port = 'AUTOMOBILE' THEN 1 ELSE 0 END AS port_1,
       CASE WHEN port = 'BUILDING' THEN 1 ELSE 0 END AS port_2,
       CASE WHEN port = 'FURNITURE' THEN 1 ELSE 0 END AS port_3
FROM manifest
""")
sql("encode_given_categories", """
SELECT row_id, CAST(list_position([1, 2, 3, 4, 5], cls) - 1 AS INTEGER) AS cls_code FROM manifest
""")
_TARGET = f"""
b0 AS (SELECT *, {_SURNAME} AS family, sibs + parch + 1 AS family_size FROM manifest),
b AS (SELECT *, count(*) OVER (PARTITION BY ticket) AS ticket_freq FROM b0),
tr AS (SELECT * FROM b WHERE split = 'train'),
te AS (SELECT * FROM b WHERE split = 'test'),
fr AS (SELECT family, median(CAST(label AS DOUBLE)) AS r FROM tr WHERE family IN (SELECT family FROM te)
       GROUP BY family HAVING median(CAST(family_size AS DOUBLE)) > 1),
tk AS (SELECT ticket, median(CAST(label AS DOUBLE)) AS r FROM tr WHERE ticket IN (SELECT ticket FROM te)
       GROUP BY ticket HAVING median(CAST(ticket_freq AS DOUBLE)) > 1),
mu AS (SELECT avg(label) AS mu FROM tr),
e AS (SELECT b.row_id, COALESCE(fr.r, mu) AS family_rate, CASE WHEN fr.r IS NOT NULL THEN 1 ELSE 0 END AS family_hit,
             COALESCE(tk.r, mu) AS ticket_rate, CASE WHEN tk.r IS NOT NULL THEN 1 ELSE 0 END AS ticket_hit
      FROM b LEFT JOIN fr USING (family) LEFT JOIN tk USING (ticket), mu)"""
sql("target_rate_encode", _TARGET.strip() + """
SELECT row_id, round(family_rate, 6) AS family_rate, family_hit, round(ticket_rate, 6) AS ticket_rate, ticket_hit
FROM e
""")
sql("target_rate_combine", _TARGET.strip() + """
SELECT row_id, round((ticket_rate + family_rate) / 2, 6) AS survival_rate,
       round((ticket_hit + family_hit) / 2, 6) AS survival_rate_na FROM e
""")
sql("pipeline_num_cat", """
tr AS (SELECT * FROM manifest WHERE split = 'train'),
md AS (SELECT median(age) AS ma, median(fare) AS mf FROM tr),
pm AS (SELECT port AS v FROM tr WHERE port IS NOT NULL GROUP BY port ORDER BY count(*) DESC, port LIMIT 1),
imp AS (SELECT row_id, split, COALESCE(age, ma) AS age, COALESCE(fare, mf) AS fare,
               COALESCE(port, (SELECT v FROM pm)) AS port, sex FROM manifest, md),
st AS (SELECT avg(age) AS mua, stddev_pop(age) AS sda, avg(fare) AS muf, stddev_pop(fare) AS sdf
       FROM imp WHERE split = 'train')
SELECT row_id, round((age - mua) / sda, 6) AS f0, round((fare - muf) / sdf, 6) AS f1,
""" + ",\n".join(f"CAST(port = '{p}' AS DOUBLE) AS f{i + 2}" for i, p in enumerate(
    ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])) + """,
       CAST(sex = 'female' AS DOUBLE) AS f7, CAST(sex = 'male' AS DOUBLE) AS f8
FROM imp, st
""")

# ---- 2.14 roles ------------------------------------------------------------------------------
_ROLES = f"""
r1 AS (SELECT *, sibs + parch + 1 AS fam, COALESCE(age <= 15, false) AS is_child FROM manifest),
r2 AS (SELECT *, max(CASE WHEN is_child THEN sibs ELSE 0 END) OVER (PARTITION BY ticket) AS child_sibs,
              CASE WHEN is_child THEN 'Child' WHEN sex = 'female' THEN 'Woman' ELSE 'Man' END AS role1 FROM r1),
r3 AS (SELECT *, CASE WHEN role1 <> 'Child' AND sibs <> 0 AND sibs = child_sibs THEN 'olderChild' ELSE role1 END
              AS role2 FROM r2),
r4 AS (SELECT *, max(CASE WHEN role2 IN ('Child', 'olderChild') THEN fam ELSE 0 END) OVER (PARTITION BY ticket)
              AS child_family_size FROM r3),
r5 AS (SELECT *, CASE WHEN role2 NOT IN ('Child', 'olderChild') AND fam = child_family_size
                      THEN CASE WHEN role2 = 'Man' THEN 'Father' ELSE 'Mother' END ELSE role2 END AS role FROM r4),
r6 AS (SELECT *, count(*) FILTER (WHERE role IN ('Child', 'olderChild')) OVER w AS num_child,
              count(*) FILTER (WHERE role = 'Child') OVER w AS num_young_child,
              bool_or(role = 'Mother') OVER w AS has_mother, bool_or(role = 'Father') OVER w AS has_father,
              CASE WHEN role IN ('Child', 'olderChild') THEN CASE WHEN fam > child_sibs + 1 THEN 'Yes' ELSE 'No' END
                   ELSE 'Not Applicable' END AS child_w_adult,
              {_NUM} AS ticket_num
       FROM r5 WINDOW w AS (PARTITION BY ticket))"""
sql("role_base", """
SELECT row_id, CASE WHEN age <= 15 THEN 'Child' WHEN sex = 'female' THEN 'Woman' ELSE 'Man' END AS role FROM manifest
""")
sql("role_older_child", _ROLES.strip() + "\nSELECT row_id, child_sibs, role2 AS role FROM r6")
sql("role_parents", _ROLES.strip() + "\nSELECT row_id, child_family_size, role FROM r6")
sql("role_child_with_adult", _ROLES.strip() + "\nSELECT row_id, child_w_adult FROM r6")
sql("role_child_counts", _ROLES.strip() + "\nSELECT row_id, num_child, num_young_child FROM r6")
sql("role_parent_flags", _ROLES.strip() + """
SELECT row_id, has_mother, has_father, has_mother AND has_father AS has_both FROM r6
""")
sql("role_guardian_rate", _ROLES.strip() + """,
g AS (SELECT CASE WHEN has_father AND NOT has_mother THEN 'with Father' WHEN has_father AND has_mother THEN 'with Both'
                  WHEN NOT has_father AND has_mother THEN 'with Mother' ELSE 'without Parents' END AS guardian,
             ticket, avg(label) AS r FROM r6 WHERE age <= 17 GROUP BY ALL)
SELECT guardian, round(avg(r), 6) AS rate FROM g GROUP BY guardian
""")
sql("role_member_outcome", _ROLES.strip() + """,
o AS (SELECT ticket_num, role,
             CASE WHEN label IS NULL THEN 'Unknown' WHEN label = 1 THEN 'Yes' ELSE 'No' END AS st,
             row_number() OVER (PARTITION BY ticket_num, role ORDER BY row_id) AS rn
      FROM r6 WHERE role IN ('Mother', 'Father', 'Child')),
f AS (SELECT ticket_num, max(st) FILTER (WHERE role = 'Mother') AS m, max(st) FILTER (WHERE role = 'Father') AS fa,
             max(st) FILTER (WHERE role = 'Child') AS c FROM o WHERE rn = 1 GROUP BY ticket_num)
SELECT row_id, COALESCE(f.m, 'Not Applicable') AS is_mother_survived,
       COALESCE(f.fa, 'Not Applicable') AS is_father_survived, COALESCE(f.c, 'Not Applicable') AS is_child_survived
FROM r6 LEFT JOIN f USING (ticket_num)
""")

# ---- nearest neighbours (brute force in the oracle) -------------------------------------------
_PREFIX = r"COALESCE(NULLIF(regexp_extract(ticket, '(.*) \d+$', 1), ''), 'M')"


def _knn_sql(base, cols, label, k, weighted, select):
    codes = ",\n".join(
        f"c_{c} AS (SELECT v AS {c}, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS k_{c} "
        f"FROM (SELECT DISTINCT {c} AS v FROM b WHERE {c} IS NOT NULL))" for c in cols)
    xs = ", ".join(f"COALESCE(k_{c} / nullif((SELECT max(k_{c}) FROM c_{c}), 0), 0.0) AS x_{c}" for c in cols)
    joins = " ".join(f"JOIN c_{c} USING ({c})" for c in cols)
    d2 = " + ".join(f"(q.x_{c} - p.x_{c}) * (q.x_{c} - p.x_{c})" for c in cols)
    pcols = ", ".join(f"x_{c}" for c in cols)
    weight = ("CASE WHEN hz = 1 THEN (CASE WHEN d2 = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / sqrt(d2) END"
              if weighted else "1.0")
    return f"""
b AS ({base}),
{codes},
s AS (SELECT b.*, {xs} FROM b {joins}),
pts AS (SELECT {pcols}, {label} AS lab, count(*) AS c FROM s WHERE {{train}} GROUP BY ALL),
q AS (SELECT * FROM s WHERE {{query}}),
pairs AS (SELECT q.row_id, p.lab, p.c, {d2} AS d2 FROM q CROSS JOIN pts p),
r AS (SELECT *, sum(c) OVER (PARTITION BY row_id ORDER BY d2, lab ROWS UNBOUNDED PRECEDING) AS cum FROM pairs),
t AS (SELECT row_id, lab, d2, least(c, {k} - (cum - c)) AS take FROM r WHERE cum - c < {k}),
z AS (SELECT *, max(CASE WHEN d2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY row_id) AS hz FROM t),
v AS (SELECT row_id, lab, sum(take * {weight}) AS v FROM z GROUP BY ALL),
best AS (SELECT row_id, lab FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY v DESC, lab) AS rn
                                   FROM v) WHERE rn = 1)
{select}"""


sql("impute_knn", _knn_sql(
    f"SELECT row_id, cls, port, {_PREFIX} AS tp, {_NUM} AS tn FROM manifest", ["cls", "tp", "tn"], "port", 3, True,
    "SELECT m.row_id, COALESCE(m.port, best.lab) AS port FROM manifest m LEFT JOIN best USING (row_id)"
).replace("{train}", "port IS NOT NULL").replace("{query}", "port IS NULL").strip())
sql("clf_knn", _knn_sql(
    "SELECT row_id, split, label, cls, sibs, parch FROM manifest", ["cls", "sibs", "parch"], "label", 5, False,
    "SELECT row_id, lab AS prediction FROM best"
).replace("{train}", "split = 'train'").replace("{query}", "split = 'test'").strip())

# ---- splits and folds ----------------------------------------------------------------------------
sql("train_test_split", """
SELECT row_id, CASE WHEN CAST(('0x' || substr(md5('7:' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0
                         < 0.2 THEN 'test' ELSE 'train' END AS part
FROM manifest WHERE split = 'train'
""")
sql("kfold_assign", """
SELECT row_id, CAST(ntile(5) OVER (ORDER BY row_id) - 1 AS INTEGER) AS fold,
       CAST(CAST(('0x' || substr(md5('7:' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold_shuffled
FROM manifest WHERE split = 'train'
""")
sql("stratified_kfold", """
SELECT row_id, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY row_id) - 1 AS INTEGER) AS fold
FROM manifest WHERE split = 'train'
""")
