"""Operator semantics on small inline frames, against pandas / numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.functions import binning as B
from tessera.functions import conditional as C
from tessera.operators import impute as I
from tessera.operators import reshape as RS
from tessera.operators import ordering
from tessera.operators.encode import CategoricalEncoder, UnseenValues, unseen_values
from tessera.operators.joins import patch_rows


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": np.arange(500), "x": rng.gamma(2.0, 10.0, 500).round(2)})
    pdf.loc[::37, "x"] = np.nan
    sdf = spark.createDataFrame(pdf.astype({"x": "float64"})).withColumn(
        "x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    return pdf, sdf


def test_qcut_matches_pandas(values):
    pdf, sdf = values
    got = B.cut_quantile(sdf, "x", 7, "b").toPandas().sort_values("id")
    exp = pd.qcut(pdf.x, 7, labels=False)
    assert np.array_equal(got.b.fillna(-1).to_numpy(), exp.fillna(-1).to_numpy())


def test_equal_width_cut_matches_pandas(values):
    pdf, sdf = values
    got = B.cut_equal_width(sdf, "x", 5, "b").toPandas().sort_values("id")
    exp = pd.cut(pdf.x, 5, labels=False)
    assert np.array_equal(got.b.fillna(-1).to_numpy(), exp.fillna(-1).to_numpy())


def test_random_fill_is_bounded_and_repeatable(spark, values):
    pdf, sdf = values
    a = I.fill_random_range(sdf, "x", "id", seed=3).toPandas().sort_values("id")
    b = I.fill_random_range(sdf.repartition(7), "x", "id", seed=3).toPandas().sort_values("id")
    assert a.x.tolist() == b.x.tolist()
    mu, sd = pdf.x.mean(), pdf.x.std()
    filled = a.x[pdf.x.isna().to_numpy()]
    assert filled.between(int(mu - sd), int(mu + sd) - 1).all()


def test_unknown_category_error_and_listing(spark):
    fit = spark.createDataFrame([("a",), ("b",)], "c string")
    other = spark.createDataFrame([("a",), ("z",), ("y",), ("z",), (None,)], "c string")
    with pytest.raises(UnseenValues, match="given categories: c: b"):
        CategoricalEncoder(["c"], encoding="ordinal", categories={"c": ["a"]}).fit(fit)
    model = CategoricalEncoder(["c"], encoding="ordinal").fit(fit)
    with pytest.raises(UnseenValues, match="fitted categories: c: y, z") as caught:
        model.transform(other)
    assert sorted(tuple(r) for r in caught.value.listing.collect()) == [("c", "y"), ("c", "z")]
    assert sorted(tuple(r) for r in unseen_values(other, model.tables).collect()) == [("c", "y"), ("c", "z")]
    ignoring = CategoricalEncoder(["c"], encoding="onehot-dense", handle_unknown="ignore").fit(fit)
    assert sorted(map(tuple, ignoring.transform(other).select("c_1", "c_2").collect())) == [(0, 0)] * 4 + [(1, 0)]


def test_more_unseen_values_than_a_message_spells_out(spark, monkeypatch):
    from tessera.operators import encode
    monkeypatch.setattr(encode, "SHOWN", 3)
    model = CategoricalEncoder(["c"], encoding="ordinal").fit(spark.createDataFrame([("a",)], "c string"))
    many = spark.range(50).selectExpr("concat('v', id) AS c")
    with pytest.raises(UnseenValues, match="c: v0, v1, v10 and more") as caught:
        model.transform(many)
    assert caught.value.listing.count() == 50


def test_two_hundred_thousand_categories(spark):
    """More than any bound, one of them in a third of all rows: codes by a salted join."""
    df = spark.range(300_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', lpad(id, 6, '0')) END AS c",
                                         "CAST(id % 4 AS INT) AS d")
    model = CategoricalEncoder(["c", "d"], "onehot", "ignore").fit(df)
    assert model.sizes == {"c": 200_001, "d": 4} and model.n_features == 200_005
    old = {k: spark.conf.get(k, None) for k in ("spark.tessera.skew.minRows", "spark.tessera.skew.salts")}
    spark.conf.set("spark.tessera.skew.minRows", "1000")
    spark.conf.set("spark.tessera.skew.salts", "8")
    try:
        out = model.transform(df)
        got = {r.id: (r.features.size, r.features.indices.tolist()) for r in out.where("id IN (0, 1, 5, 299999)").collect()}
        # c000001 is the first, c299999 the 200,000th, hot the last of them
        assert got == {0: (200_005, [200_000, 200_001]), 1: (200_005, [0, 200_002]), 5: (200_005, [3, 200_002]),
                       299_999: (200_005, [199_999, 200_004])}
        assert out.count() == 300_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_glued_columns(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, None)], "k int, x string").repartition(3)
    right = spark.createDataFrame([(30.0, 7), (10.0, 9), (20.0, 8)], "y double, o int").repartition(2)
    got = RS.glue_columns(left, right, ["k"], ["o"], drop=["o"])
    assert got.columns == ["k", "x", "y"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", 30.0), (2, None, 20.0), (3, "c", 10.0)]
    # without an order the frames' own: by task and row, for frames without a key
    a = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 2).alias("a"))
    b = spark.range(0, 1000, numPartitions=3).select((F.col("id") * 3).alias("b"))
    assert all(r.a * 3 == r.b * 2 for r in RS.glue_columns(a, b).collect()) and RS.glue_columns(a, b).count() == 1000
    with pytest.raises(ValueError, match="1000 and 999 rows"):
        RS.glue_columns(a, b.limit(999))
    with pytest.raises(ValueError, match="columns"):
        RS.glue_columns(a, b.withColumnRenamed("b", "A"))
    assert RS.glue_columns(a.limit(0), b.limit(0)).count() == 0


def test_cutoffs_of_fractional_ages(spark):
    rows = [(0.42, "female", 1), (3.5, "male", 0), (10.0, "male", 1), (10.2, "female", None), (None, "male", 1), (None, None, 0), (44.0, "female", 0)]
    df = spark.createDataFrame(rows, "age double, sex string, label int")
    got = {(r.cutoff, r.role): r.rate for r in RS.cutoff_sweep(df, [0, 1, 10, 50]).collect()}
    want = {}
    for cut in (0, 1, 10, 50):
        found = {}
        for age, sex, label in rows:
            role = "Child" if age is not None and age <= cut else "Woman" if sex == "female" else "Man"
            found.setdefault(role, []).append(label)
        for role, labels in found.items():
            known = [v for v in labels if v is not None]
            want[cut, role] = round(sum(known) / len(known), 6) if known else None
    assert got == want


@pytest.mark.parametrize("accuracy, small", [(10_000, 40_000), (50, 20), (200, 0)])
def test_selection_between_brackets(spark, monkeypatch, accuracy, small):
    """Groups larger than what is folded whole, one of them with most rows, null keys,
    many ties and few distinct values."""
    monkeypatch.setattr(ordering, "ACCURACY", accuracy)
    monkeypatch.setattr(ordering, "SMALL", small)
    rng = np.random.default_rng(accuracy)
    keys = rng.choice(["hot", "hot", "hot", "b", "c", None], 6_000)
    x = np.where(rng.random(6_000) < 0.3, rng.integers(0, 5, 6_000), rng.normal(0, 50, 6_000).round(3))
    rows = [(None if k is None else str(k), float(v) if i % 17 else None) for i, (k, v) in enumerate(zip(keys, x))] + [("one", 4.5), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = {r.k: tuple(r)[1:] for r in ordering.exact_percentiles(df, "x", probs, ["k"]).collect()}
    assert set(got) == {k for k, v in rows if v is not None}
    for k in got:
        want = np.quantile([v for key, v in rows if key == k and v is not None], probs)
        assert np.allclose(got[k], want, rtol=0, atol=1e-9)
    every = ordering.exact_percentiles(df, "x", probs)
    assert np.allclose(every.first(), np.quantile([v for _, v in rows if v is not None], probs), rtol=0, atol=1e-9)
    plan = ordering.exact_percentiles(df, "x", probs, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert ordering.exact_percentiles(df.limit(0), "x", probs).count() <= 1


def test_value_map_and_collapse(spark):
    df = spark.createDataFrame([(1,), (4,), (9,)], "n int")
    got = df.select(C.value_map("n", {1: "Alone", 4: "Small"}, "Other").alias("g")).collect()
    assert [r.g for r in got] == ["Alone", "Small", "Other"]
    df2 = spark.createDataFrame([("A",), ("E",), ("M",)], "d string")
    got2 = df2.select(C.collapse("d", {"ABC": ["A", "B", "C"], "DE": ["D", "E"]}).alias("d")).collect()
    assert [r.d for r in got2] == ["ABC", "DE", "M"]


def test_complete_grid_fills_missing(spark):
    vals = spark.createDataFrame([(1, "f", 0, 5)], "cls int, sex string, b int, n long")
    grid = RS.complete_grid(vals, {"cls": [1, 2], "sex": ["f", "m"], "b": [0, 1]}, {"n": 0})
    rows = sorted(tuple(r) for r in grid.select("cls", "sex", "b", "n").collect())
    assert len(rows) == 8 and (1, "f", 0, 5) in rows and sum(r[3] for r in rows) == 5


def test_patch_rows(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "id int, age double")
    patches = spark.createDataFrame([(2, 14.5)], "id int, age double")
    got = sorted(tuple(r) for r in patch_rows(df, patches, "id", ["age"], small=True).collect())
    assert got == [(1, 10.0), (2, 14.5), (3, 30.0)]


def _separable(spark, n=400):
    rng = np.random.default_rng(5)
    x1 = rng.normal(0, 1, n)
    x2 = rng.normal(0, 1, n)
    y = (x1 + 0.5 * x2 > 0).astype(float)
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1 + y * 1.5, "x2": x2, "label": y})
    df = spark.createDataFrame(pdf)
    return VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df)


def test_adaboost_learns(spark):
    from tessera.models.trees import AdaBoost
    df = _separable(spark)
    pred = AdaBoost(["x1", "x2"], n_estimators=8).fit(df).transform(df)
    acc = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.85


def test_discriminants_match_numpy(spark):
    from tessera.models.discriminant import DiscriminantAnalysis
    df = _separable(spark)
    pdf = df.select("x1", "x2", "label").toPandas()
    X, y = pdf[["x1", "x2"]].to_numpy(), pdf.label.to_numpy()
    for kind in ["linear", "quadratic"]:
        got = DiscriminantAnalysis(["x1", "x2"], kind=kind, reg=0.0).fit(df).transform(df) \
            .select("prediction").toPandas().prediction.to_numpy()
        scores = []
        pooled = sum(np.cov(X[y == c].T, bias=False) * (np.sum(y == c) - 1) for c in (0, 1)) / (len(y) - 2)
        for c in (0.0, 1.0):
            mu, pi = X[y == c].mean(0), np.mean(y == c)
            cov = pooled if kind == "linear" else np.cov(X[y == c].T)
            inv = np.linalg.inv(cov)
            d = X - mu
            s = -0.5 * np.einsum("ij,jk,ik->i", d, inv, d) + np.log(pi)
            if kind == "quadratic":
                s -= 0.5 * np.linalg.slogdet(cov)[1]
            scores.append(s)
        exp = np.where(scores[1] > scores[0], 1.0, 0.0)
        assert (got == exp).mean() > 0.99


def test_mode_ties_take_smallest_value(spark):
    from tessera.operators.aggregate import mode_table
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("a", "x"), ("a", None), ("b", "z")],
                               "k string, v string")
    got = sorted(tuple(r) for r in mode_table(df, ["k"], "v").collect())
    assert got == [("a", "x", 2), ("b", "z", 1)]


def test_grid_has_every_cell(spark):
    vals = spark.createDataFrame([(1, 1, 7)], "a int, b int, n long")
    got = RS.complete_grid(vals, {"a": list(range(50)), "b": list(range(50))}, {"n": 0}).toPandas()
    assert len(got) == 2500 and got.n.sum() == 7
