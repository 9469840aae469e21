"""Ensembles of all folds are grown and scored together."""


import numpy as np
from pyspark.sql import functions as F

from tessera.models import evaluate as EV
from tessera.models import stacking as ST
from tessera.models import trees
from tessera.models.features import FEATURES
from tessera.models.trees import AdaBoost, Boosted, _Cells

MADE = {"ada": lambda: AdaBoost(FEATURES, n_estimators=12), "gbt": lambda: Boosted(FEATURES, n_rounds=6, max_depth=2)}


def rows(spark, n=300):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 1, (n, len(FEATURES))), 1)
    return spark.createDataFrame(
        [(i % 290 if i % 7 else None, *map(float, v), float(v[0] + v[1] > 0) if i % 4 else None, int(i % 3) if i % 4 or i % 8 else None) for i, v in enumerate(x)],
        ["row_id long", *[f"{c} double" for c in FEATURES], "label double", "fold int"][0] + ", " + ", ".join(f"{c} double" for c in FEATURES)
        + ", label double, fold int").coalesce(3).persist()


def test_a_row_of_real_bins_has_each_features_in_place():
    edges = [np.arange(k) + 0.5 for k in (1, 63, 4)]
    cells = _Cells(edges)
    got = cells.wide(np.arange(float(cells.total)))
    assert cells.total == 71 and got.shape == (3, 64)
    assert got[0, :2].tolist() == [0, 1] and got[1].tolist() == list(range(2, 66)) and got[2, :5].tolist() == list(range(66, 71))
    assert not got[0, 2:].any() and not got[2, 5:].any()


def test_few_rows_are_one_task_and_give_the_same_trees(spark, monkeypatch):
    data, seen = rows(spark).filter("label is not null").repartition(6).persist(), []
    monkeypatch.setattr(trees.Boosted, "_grown", lambda self, df, rdd, folds, old=trees.Boosted._grown: seen.append(rdd.getNumPartitions()) or old(self, df, rdd, folds))
    one = MADE["gbt"]().fit_folds(data, "fold", [0, 1])
    monkeypatch.setattr(trees, "TASK_ROWS", 1)
    six = MADE["gbt"]().fit_folds(data, "fold", [0, 1])
    assert seen == [1, 6]
    for a, b in zip(one, six):
        assert np.array_equal(a.trees.feature, b.trees.feature) and np.allclose(a.trees.value, b.trees.value)


def test_scores_of_all_folds_equal_those_of_each_model(spark, monkeypatch):
    data = rows(spark).filter("label is not null and fold is not null")
    for made in MADE.values():
        models = made().fit_folds(data, "fold", [0, 1, 2])
        together = EV._scores(models, data, [0, 1, 2], "fold")
        for f, model in enumerate(models):
            held = model.transform(data).groupBy(F.col("fold") == f).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).collect()
            assert np.allclose(together[f], [v for _, v in sorted(map(tuple, held))])


def test_out_of_fold_values_are_those_of_a_branch_for_each_model(spark, monkeypatch):
    """Repeated keys are averaged, unlabelled rows need no fold; and models
    that score all folds together are not asked fold by fold."""
    data = rows(spark)
    for module in (ST,):
        monkeypatch.setattr(module, "make", lambda name: MADE[name]())
    train = data.filter("label is not null")
    want = {}
    for name, made in MADE.items():
        for f, model in enumerate(made().fit_folds(train, "fold", [0, 1, 2])):
            for r in model.transform(data.filter(f"label is null or fold = {f}")).select("row_id", "prediction").collect():
                want.setdefault((r.row_id, name), []).append(r.prediction)

    def refused(self, df):
        raise AssertionError("scored fold by fold")

    for made in MADE.values():
        monkeypatch.setattr(type(made()).fit_folds(made(), train, "fold", [0])[0].__class__, "_transform", refused)
    oof, _ = ST.stack_oof(spark, data, list(MADE), k=3)
    got = {(r.row_id, r.model): r.value for r in oof.collect()}
    assert got.keys() == want.keys() and all(np.isclose(got[k], np.mean(v)) for k, v in want.items())
