"""The library's own models against plain numpy on small tables."""

import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from tessera.models import discriminant as D
from tessera.models import evaluate as EV
from tessera.models import trees
from tessera.models.blocks import Block, blocks, draw, total
from tessera.models.classifiers import KNNClassifier
from tessera.models.linear import HINGE, LOGISTIC, Fourier, LinearClassifier, RBFSVM, Setting, fit_linear
from tessera.models.trees import AdaBoost, Boosted, ExtraTrees
from tessera.operators import knn
from tessera.operators.knn import PartitionTree, fit_neighbours, knn_classify, spread_neighbours

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 240
    x = np.column_stack([rng.normal(0, 1, n), rng.integers(0, 5, n), rng.exponential(20, n)])
    y = (x[:, 0] + 0.4 * x[:, 1] + 0.02 * x[:, 2] + rng.normal(0, 0.8, n) > 1.2).astype(float)
    rows = [(i, *map(float, x[i]), float(y[i]), i % 4) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id bigint, a double, b double, c double, label double, fold int").repartition(6).persist()
    return df, x, y, np.arange(n) % 4


def accuracy(df, model):
    return model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


# ---- linear models ----------------------------------------------------------------------

@pytest.mark.parametrize("loss", [LOGISTIC, HINGE])
def test_all_folds_and_penalties_have_a_gradient_near_zero(table, loss):
    df, x, y, fold = table
    rdd = blocks(df, COLS, "label", "fold")
    settings = [Setting(loss, p, f) for p in (0.01, 1.0, 100.0) for f in (-1, 0, 3)]
    for s, got in zip(settings, fit_linear(rdd, settings)):
        kept = fold != s.held_out
        z, t = x[kept], 2 * y[kept] - 1
        sd = z.std(axis=0)
        score = z @ got.weights + got.intercept
        slope = -1 / (1 + np.exp(t * score)) if loss == LOGISTIC else -2 * np.maximum(0, 1 - t * score)
        # in standardised features the penalty is on weight * deviation
        gradient = (t * slope) @ ((z - z.mean(axis=0)) / sd) + s.penalty * got.weights * sd
        assert np.abs(gradient).max() < 1e-4 and abs((t * slope).sum()) < 1e-4
        assert got.gradient < 1e-8
        alone = fit_linear(blocks(df.filter(F.col("fold") != s.held_out), COLS, "label"), [Setting(loss, s.penalty)])[0]
        assert np.allclose(got.weights, alone.weights, atol=1e-5) and abs(got.intercept - alone.intercept) < 1e-4


def test_a_separable_label_and_a_constant_feature(spark):
    rows = [(float(i), 1.0, float(i > 10)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    for loss in (LOGISTIC, HINGE):
        assert accuracy(df, LinearClassifier(["a", "b"], loss).fit(df)) == 1.0


def test_the_tuned_penalty_is_the_most_accurate_one(table):
    df, x, y, _ = table
    choices = [1e-4, 1.0]
    model = LinearClassifier(COLS, C=choices).fit(df)
    part = (draw(np.array([r[0] for r in df.select(F.xxhash64(*COLS)).collect()]), 11) * 3).astype(int)
    rows = np.array([[r.a, r.b, r.c, r.label] for r in df.collect()])
    right = []
    for c in choices:
        hits = 0
        for j in range(3):
            train = df.sparkSession.createDataFrame(rows[part != j].tolist(), "a double, b double, c double, label double")
            f = LinearClassifier(COLS, C=c).fit(train).fitted
            hits += ((rows[part == j, :3] @ f.weights + f.intercept > 0) == (rows[part == j, 3] > 0)).sum()
        right.append(hits)
    best = LinearClassifier(COLS, C=choices[int(np.argmax(right))]).fit(df).fitted
    assert np.allclose(model.fitted.weights, best.weights, atol=1e-5)


def test_kernel_fits_of_all_folds_equal_single_fits(table):
    df, x, y, fold = table
    models = RBFSVM(COLS, n_components=20).fit_folds(df, "fold", [0, 1], [1.0, 2.0])
    fourier = Fourier(x.mean(axis=0), x.std(axis=0), 20, 1 / 3, 7)
    z = fourier(x)
    for m, (c, f) in zip(models, [(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)]):
        t, kept = 2 * y - 1, fold != f
        slope = -2 * np.maximum(0, 1 - t * (z @ m.fitted.weights + m.fitted.intercept)) * t
        assert np.abs((slope[:, None] * z)[kept].sum(axis=0) + m.fitted.weights / c).max() < 1e-4


def test_sums_over_many_blocks(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("label")).repartition(70)
    assert total(blocks(df, ["a"], "label"), lambda b: [b.x.sum(axis=0), b.y.sum()])[0][0] == 499_500


# ---- closed forms -----------------------------------------------------------------------

def test_moments_without_a_fold(table):
    df, x, y, fold = table
    found = D.class_moments(df, COLS, "label", "fold")
    for f in (None, 2):
        for c, m in D.without(found, f).items():
            z = x[(y == c) & (fold != f if f is not None else True)]
            assert m.n == len(z) and np.allclose(m.mean, z.mean(axis=0))
            assert np.allclose(m.scatter, (z - z.mean(axis=0)).T @ (z - z.mean(axis=0)))
            assert (m.above == (z > x.min(axis=0)).sum(axis=0)).all()


@pytest.mark.parametrize("alpha", [0.1, 10.0, 500.0])
def test_ridge_and_its_error(table, alpha):
    df, x, y, _ = table
    mom = D.without(D.class_moments(df, COLS, "label"), None)
    w, b = D.ridge_weights(mom, alpha)
    t, z = 2 * y - 1, x - x.mean(axis=0)
    want = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (t - t.mean()))
    assert np.allclose(w, want) and np.isclose(b, t.mean() - want @ x.mean(axis=0))
    assert np.isclose(D.squared_error(mom, w, b), ((x @ w + b - t) ** 2).sum())


def test_ridge_of_all_folds_and_its_alpha(table):
    df, x, y, fold = table
    models = D.MomentClassifier(COLS, "ridge", alphas=[0.01, 1e4]).fit_folds(df, "fold", [0, 1, 2, 3])
    for f, m in enumerate(models):
        alone = D.MomentClassifier(COLS, "ridge", alphas=[0.01, 1e4]).fit(df.filter(F.col("fold") != f))
        assert np.allclose(m.terms[1.0][1], alone.terms[1.0][1]) and np.isclose(m.terms[1.0][0], alone.terms[1.0][0])


@pytest.mark.parametrize("kind", ["linear", "quadratic", "gaussian", "bernoulli"])
def test_closed_forms_of_all_folds(table, kind):
    df, x, y, fold = table
    models = D.MomentClassifier(COLS, kind).fit_folds(df, "fold", [0, 1])
    got = {r.row_id: r.prediction for r in models[0].transform(df).collect()}
    kept = fold != 0
    scores = []
    for c in (0.0, 1.0):
        z = x[kept & (y == c)]
        prior, mu = np.log(len(z) / kept.sum()), z.mean(axis=0)
        if kind == "bernoulli":
            p = ((z > x.min(axis=0)).sum(axis=0) + 1) / (len(z) + 2)
            on = x > x.min(axis=0)
            scores.append(prior + (on * np.log(p) + ~on * np.log(1 - p)).sum(axis=1))
            continue
        pooled = sum((x[kept & (y == k)] - x[kept & (y == k)].mean(axis=0)).T @ (x[kept & (y == k)] - x[kept & (y == k)].mean(axis=0))
                     for k in (0.0, 1.0)) / (kept.sum() - 2)
        cov = {"linear": pooled, "quadratic": np.cov(z.T), "gaussian": np.diag(z.var(axis=0))}[kind]
        gap = x - mu
        scores.append(prior - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (gap @ np.linalg.inv(cov) * gap).sum(axis=1))
    want = (scores[1] > scores[0]).astype(float)
    assert [got[i] for i in range(len(x))] == want.tolist()


# ---- neighbours -------------------------------------------------------------------------

def brute_votes(points, label, q, k, weights):
    """Predictions by all distances; copies of a point count each."""
    out = []
    for row in q:
        d = np.zeros(len(points))
        for f in range(points.shape[1]):
            d += (row[f] - points[:, f]) ** 2
        near = np.lexsort((label, d))[:k]
        if weights == "uniform":
            w = np.ones(k)
        else:
            w = (d[near] == 0).astype(float) if (d[near] == 0).any() else 1 / np.sqrt(d[near])
        out.append(min(set(label[near].tolist()), key=lambda c: (-w[label[near] == c].sum(), c)))
    return out


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_neighbours_in_ten_dimensions(spark, weights):
    rng = np.random.default_rng(8)
    n = 1500
    x = np.column_stack([rng.integers(0, 4, (n, 6)) / 3, rng.random((n, 4)).round(2)])
    y = rng.integers(0, 3, n)
    q = np.concatenate([x[:30], np.column_stack([rng.integers(0, 4, (60, 6)) / 3, rng.random((60, 4)) * 3 - 1])])
    names = [f"f{i}" for i in range(10)]
    train = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], ", ".join(f"{f} double" for f in names) + ", y int")
    ask = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "id int, " + ", ".join(f"{f} double" for f in names))
    for k in (1, 5, 21):
        got = {r.id: r.prediction for r in knn_classify(train, ask, names, "y", "id", k, weights).collect()}
        assert [got[i] for i in range(len(q))] == brute_votes(x, y, q, k, weights)
    every = ask.select("id", fit_neighbours(train, names, "y").predict([1, 5], weights).alias("p")).collect()
    assert [r.p.k5 for r in sorted(every)] == brute_votes(x, y, q, 5, weights)


def test_neighbours_of_odd_rows(spark):
    train = spark.createDataFrame([(0.0, "x")] * 5 + [(1.0, "y")] * 2 + [(None, "z"), (0.5, None)], "a double, l string")
    ask = spark.createDataFrame([(1, 0.9), (2, None), (3, 7.0), (3, 7.0)], "id int, a double")
    got = sorted(tuple(r) for r in knn_classify(train, ask, ["a"], "l", "id", 3, "uniform").collect())
    assert got == [(1, "y"), (2, None), (3, "y"), (3, "y")]
    assert [r[1] for r in knn_classify(train.limit(0), ask, ["a"], "l", "id").collect()] == [None] * 4


def test_points_compared_hardly_grow_with_the_points():
    rng = np.random.default_rng(1)
    seen = []
    for n in (2_000, 20_000, 200_000):
        x = np.column_stack([rng.integers(0, 5, n) / 4, rng.integers(0, 2, n), rng.random(n), rng.integers(0, 4, n) / 3, rng.integers(0, 3, n) / 2,
                             rng.random(n), rng.integers(0, 6, (n, 3)) / 5, rng.integers(0, 2, n)])
        tree = PartitionTree(x, np.zeros(n, int), np.ones(n, int))
        tree.nearest(x[:300] + 0.01, 5)
        seen.append(tree.visited / 300)
    assert seen[2] < 4 * seen[0] and seen[2] < 0.02 * 200_000


def test_a_bound_on_the_labelled_points_is_kept(spark):
    train = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).alias("l"))
    assert fit_neighbours(train, ["a"], "l", max_points=10).tree.value.count.sum() == 10


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_neighbours_in_many_cells_equal_one_tree(spark, monkeypatch, weights):
    """Also of queries outside all boxes, with a null, and copies; no point leaves the executors."""
    monkeypatch.setattr(knn, "CELL", 12)
    rng = np.random.default_rng(8)
    rows = [(i, *map(float, v), int(v.sum()) % 3) for i, v in enumerate(np.round(rng.normal(0, 2, (400, 3)), 1))]
    train = spark.createDataFrame(rows + rows[:40], "i int, a double, b double, c double, l int")
    asked = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(np.round(rng.normal(0, 4, (150, 3)), 1))]
                                  + [(150, None, 1.0, 1.0), (151, 90.0, -90.0, 0.0)], "i int, a double, b double, c double")
    fitted = spread_neighbours(train, COLS, "l")
    assert fitted.borders.cells > 20 and fitted.points.agg(F.sum("n")).first()[0] == 440
    ks = [1, 4, 9]
    got = {r.i: tuple(r.s) if r.s else None for r in fitted.search(asked, [F.col(c) for c in COLS], ks, weights, "s").collect()}
    one = fit_neighbours(train, COLS, "l").predict(ks, weights)
    want = {r.i: tuple(r.s) for r in asked.select("i", one.alias("s")).collect()}
    assert got.pop(150) is None and set(want.pop(150)) == {None}
    assert got == want


def test_searches_equal_separate_fits(table):
    df, *_ = table
    spark, ks = df.sparkSession, [1, 4, 9]
    got = EV.search_neighbours(spark, df, COLS, ks, 4).collect()
    for r, k in zip(got, ks):
        each = [accuracy(df.filter(F.col("fold") == f), KNNClassifier(COLS, [k]).fit(df.filter(F.col("fold") != f))) for f in range(4)]
        assert np.isclose(r.mean_accuracy, np.mean(each)) and np.isclose(r.std_accuracy, np.std(each))
    counts = [1, 5, 18]
    got = EV.search_rounds(spark, df, Boosted(COLS, max_depth=2), counts, 4).collect()
    for r, n in zip(got, counts):
        each = [accuracy(df.filter(F.col("fold") == f), Boosted(COLS, n_rounds=n, max_depth=2).fit_folds(df, "fold", [f])[0]) for f in range(4)]
        assert np.isclose(r.mean_accuracy, np.mean(each)) and np.isclose(r.std_accuracy, np.std(each))


# ---- trees ------------------------------------------------------------------------------

def brute_boosted(x, y, rounds, depth, rate, lam, gamma, child, drawn, columns):
    """Scores by plain recursion over all middles between values."""
    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)

        def grow(rows, used, depth_left):
            used_rows = rows & used
            G, H = g[used_rows].sum(), h[used_rows].sum()
            best = (1e-9, None)
            if depth_left:
                for f in np.flatnonzero(columns(r)):
                    values = np.unique(x[:, f])
                    for cut in (values[:-1] + values[1:]) / 2:
                        left = used_rows & (x[:, f] <= cut)
                        gl, hl, n = g[left].sum(), h[left].sum(), left.sum()
                        if n < 1 or used_rows.sum() - n < 1 or hl < child or H - hl < child:
                            continue
                        gain = 0.5 * (gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam)) - gamma
                        if gain > best[0] + 1e-10:
                            best = (gain, (f, cut))
            if best[1] is None:
                add[rows] = -rate * G / (H + lam)
                return
            f, cut = best[1]
            grow(rows & (x[:, f] <= cut), used, depth_left - 1)
            grow(rows & (x[:, f] > cut), used, depth_left - 1)

        add = np.zeros(len(y))
        grow(np.ones(len(y), bool), drawn(r), depth)
        score = score + add
    return score


@pytest.mark.parametrize("options", [{}, {"reg_lambda": 1.0, "gamma": 0.5, "min_child_weight": 2.0},
                                     {"reg_lambda": 1.0, "subsample": 0.8, "colsample": 0.67}])
def test_boosting_like_brute_force(spark, options):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 12, 90), rng.integers(0, 9, 90), rng.integers(0, 4, 90)]).astype(float)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 4, 90)) > 12).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, label double").repartition(3)
    est = Boosted(COLS, n_rounds=20, max_depth=2, learning_rate=0.4, **options)
    model = est.fit(df)
    got = {(r.a, r.b, r.c): r.s[0] for r in df.select("*", model._scored([20]).alias("s")).collect()}
    key = {(r.a, r.b, r.c): r.k for r in df.select("*", F.xxhash64(*COLS).alias("k")).collect()}
    keys = np.array([key[tuple(r)] for r in x])
    share = options.get("subsample", 1.0)
    want = brute_boosted(x, y, 20, 2, 0.4, options.get("reg_lambda", 0.0) or 1e-12, options.get("gamma", 0.0), options.get("min_child_weight", 0.0),
                         lambda r: draw(keys, 7, r) < share, est._columns)
    assert np.allclose([got[tuple(r)] for r in x], want, atol=1e-6)


def test_extra_trees_draw_thresholds_and_grow_again_alike(table):
    df, x, y, _ = table
    est = ExtraTrees(COLS, n_trees=12, max_depth=4, min_leaf=3)
    one, again = est.fit(df), ExtraTrees(COLS, n_trees=12, max_depth=4, min_leaf=3).fit(df.repartition(11))
    assert np.array_equal(one.trees.threshold, again.trees.threshold) and np.array_equal(one.trees.value, again.trees.value)
    assert np.isclose(sum(one.featureImportances), 1.0)
    cuts = one.trees.threshold[np.isfinite(one.trees.threshold)]
    middles = np.concatenate([(np.unique(x[:, f])[:-1] + np.unique(x[:, f])[1:]) / 2 for f in range(3)])
    assert len(np.unique(cuts)) > 20 and not np.isin(cuts, middles).any() and not np.isin(cuts, x).any()
    # values are shares of the rows in a leaf, of which none is too small
    at = one.trees.nodes(x, 4)
    for t in range(12):
        for node in np.unique(at[:, t]):
            inside = at[:, t] == node
            assert inside.sum() >= 3 and np.isclose(one.trees.value[t, node], y[inside].mean())
    folds = ExtraTrees(COLS, n_trees=3, max_depth=4).fit_folds(df, "fold", [0, 1])
    alone = ExtraTrees(COLS, n_trees=3, max_depth=4).fit_folds(df, "fold", [1])[0]
    assert np.array_equal(folds[1].trees.threshold, alone.trees.threshold)


def test_going_down_a_tree_equals_looking_up_each_row():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (500, 3)).astype(float)
    x[rng.random(x.shape) < 0.05] = np.nan
    tree = trees.Trees(6, 4)
    tree.feature, tree.threshold = rng.integers(0, 3, tree.feature.shape), rng.choice([1.5, 4.5, 6.5, np.inf], tree.threshold.shape)
    tree.value = rng.normal(size=tree.value.shape)
    edges = [np.arange(0.5, 9)] * 3
    held = trees._Running.of(Block(x, np.zeros(500), np.full(500, -1, np.int32), np.arange(500)), edges, 1, False)
    bins = np.where(np.isinf(tree.threshold), np.inf, tree.threshold - 0.5)
    got, total = tree.nodes(x, 4), np.zeros(500)
    for t in range(6):
        node = np.zeros(500, int)
        for _ in range(4):
            node = 2 * node + 1 + (x[np.arange(500), tree.feature[t, node]] > tree.threshold[t, node])
        assert np.array_equal(got[:, t], node)
        assert np.array_equal(trees._descend(held.route, tree.feature[t], bins[t], 4) + 15, node)
        total += tree.value[t, node]
    assert np.allclose(trees._added(held.route, (tree.feature, bins, tree.value), 4), total)


def test_what_boosting_keeps_of_a_row_is_small(spark):
    """Bins, label, fold and score, not the values; a block has a bounded number of rows."""
    cols = [f"c{i}" for i in range(10)]
    df = spark.range(20_000).select(*[((F.col("id") * (i + 3)) % 97).cast("double").alias(c) for i, c in enumerate(cols)],
                                    (F.col("id") % 2).cast("double").alias("label")).coalesce(1)
    got = blocks(df, cols, "label", kept=False).collect()
    assert max(len(b.y) for b in got) <= 10_000 and sum(len(b.y) for b in got) == 20_000
    held = trees._Running.of(got[0], [np.arange(64.0)] * 10, 1, False)
    assert len(pickle.dumps(held)) < 25 * len(got[0].y)


def test_large_sums_come_to_the_driver_from_few_tasks(spark, monkeypatch):
    rdd = spark.sparkContext.parallelize(range(24), 12)
    seen = []
    real = RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: seen.append(self.getNumPartitions()) or real(self))
    assert total(rdd, lambda i: [np.full(10, float(i))], size=1 << 19)[0].tolist() == [276.0] * 10
    assert total(rdd, lambda i: [np.full(10, float(i))], size=10)[0].tolist() == [276.0] * 10
    assert seen == [2, 12]


def brute_adaboost(x, y, rounds, rate):
    w, out = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        w = w / w.sum()
        best = (-1.0, None)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                gain = 0.0
                for side in (x[:, f] <= cut, x[:, f] > cut):
                    one, all_ = w[side & (y == 1)].sum(), w[side].sum()
                    gain += (one ** 2 + (all_ - one) ** 2) / all_
                if gain > best[0] + 1e-12:
                    best = (gain, (f, cut))
        f, cut = best[1]
        left = x[:, f] <= cut
        vote = np.where(left, w[left & (y == 1)].sum() > w[left & (y == 0)].sum(), w[~left & (y == 1)].sum() > w[~left & (y == 0)].sum())
        miss = vote != (y == 1)
        error = w[miss].sum()
        if error >= 0.5:
            break
        alpha = rate * np.log((1 - error) / error)
        out.append(np.where(vote, alpha, -alpha))
        w = w * np.exp(alpha * miss)
    return np.sum(out, axis=0)


def test_adaboost_like_brute_force(spark, table):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 15, 120), rng.integers(0, 10, 120), rng.integers(0, 3, 120)]).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + rng.normal(0, 5, 120) > 16).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "i int, a double, b double, c double, label double")
    model = AdaBoost(COLS, n_estimators=40, learning_rate=0.7).fit(df.repartition(5))
    got = {r.i: r.v for r in df.select("i", model.votes().alias("v")).collect()}
    assert np.allclose([got[i] for i in range(120)], brute_adaboost(x, y, 40, 0.7), atol=1e-8)


def test_adaboost_of_575_rounds_is_one_expression(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 40, (200, 2)).astype(float)
    y = ((x[:, 0] - 20) ** 2 + (x[:, 1] - 20) ** 2 + rng.normal(0, 60, 200) > 250).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, label double").coalesce(2).persist()
    model = AdaBoost(["a", "b"], n_estimators=575, learning_rate=0.95).fit(df)
    assert len(model.stumps) == 575
    assert accuracy(df, model) > 0.9
    plan = model.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("aggregate(") <= 2 and "Python" not in plan
