"""The shared neighbour search of all folds against separate fits and plain counting."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.models import evaluate as EV
from tessera.models.classifiers import KNNClassifier
from tessera.operators import knn_folds
from tessera.operators.knn_folds import fold_accuracies

COLS = ["a", "b", "c"]


def brute(rows, folds, ks):
    """(fold, k) -> accuracy on the other rows and on its own."""
    x, y, fold = np.array([r[:3] for r in rows]), np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    out = {}
    for f in folds:
        held = fold == f
        lo, span = x[~held].min(axis=0), np.ptp(x[~held], axis=0)
        z = (x - lo) / np.where(span > 0, span, 1.0)
        for k in ks:
            hit = []
            for i in range(len(z)):
                near = sorted((sum(float(v) * float(v) for v in z[j] - z[i]), y[j]) for j in np.flatnonzero(~held))[:k]
                votes = Counter(label for _, label in near)
                hit.append(min(votes, key=lambda label: (-votes[label], label)) == y[i])
            hit = np.array(hit)
            out[f, k] = hit[~held].mean(), hit[held].mean()
    return out


def sample(kind, n=150):
    rng = np.random.default_rng(3)
    if kind == "clusters":  # a fold is a place of its own, so the nearest rows are all left out
        fold = np.arange(n) % 3
        x = rng.normal(0, 0.3, (n, 3)) + 10.0 * fold[:, None]
    elif kind == "ties":
        fold, x = rng.integers(0, 3, n), rng.integers(0, 3, (n, 3)).astype(float)
    else:
        fold, x = np.arange(n) * 3 // n, np.round(rng.normal(0, 2, (n, 3)), 1)
    rows = [(*map(float, v), float(c), int(f)) for v, c, f in zip(x, rng.integers(0, 3, n), fold)]
    return rows + rows[:20]


@pytest.mark.parametrize("kind", ["plain", "ties", "clusters"])
def test_all_folds_equal_counting(spark, monkeypatch, kind):
    monkeypatch.setattr(knn_folds, "LEAST", 20)
    monkeypatch.setattr(knn_folds, "MOST", 20)
    rows = sample(kind)
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0, 1.0, 0), (1.0, 1.0, 1.0, None, 0)], "a double, b double, c double, label double, fold int")
    folds, ks = [0, 1, 2], [1, 4, 9]
    want = brute(rows, folds, ks)
    got = fold_accuracies(df, COLS, "label", "fold", folds, ks, True)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
    held = fold_accuracies(df, COLS, "label", "fold", folds, ks, False)
    assert all(v[0] is None and np.isclose(v[1], want[k][1]) for k, v in held.items())


def test_cross_validation_fits_no_neighbours_of_a_fold_alone(spark, monkeypatch):
    """One search of all folds, with the scores of separate fits."""
    rows = sample("plain")
    df = spark.createDataFrame(rows, "a double, b double, c double, label double, fold int").cache()
    want = []
    for f in range(3):
        model = KNNClassifier(COLS, [5]).fit(df.filter(F.col("fold") != f))
        scored = model.transform(df).groupBy(F.col("fold") == f).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).collect()
        want.append(tuple(v for _, v in sorted(map(tuple, scored))))

    def refused(self, df):
        raise AssertionError("fitted for one fold")

    monkeypatch.setattr(KNNClassifier, "_fit", refused)
    monkeypatch.setattr(EV, "make", lambda name: KNNClassifier(COLS, [5]))
    got = EV.cross_validate(spark, df, ["knn"], k=3).orderBy("fold").collect()
    assert np.allclose([(r.train_accuracy, r.test_accuracy) for r in got], want)


def test_a_fold_without_other_rows_raises(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 0)], "a double, b double, c double, label double, fold int")
    with pytest.raises(ValueError):
        fold_accuracies(df, COLS, "label", "fold", [0], [1], True)
