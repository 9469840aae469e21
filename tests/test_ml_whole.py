"""The fitted queries work over every row of the manifest; classifiers find the
limit of a label that fares determine."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.models.classifiers import make
from tessera.models.features import FEATURES, ml_frame
from tessera.plans import q_ml
from tessera.plans.q_ml import STACK_BASE
from tessera.session import cut_lineage
from tessera.sources.manifest import manifest

from conftest import SMALL

QUERIES = entry.queries()
#: Queries with a prediction per unlabelled row that SQL does not state.
PER_ROW = ["clf_logistic", "clf_ridge", "clf_tree", "clf_linear_svm", "clf_rbf_svm", "clf_random_forest",
           "clf_extra_trees", "clf_bagging", "clf_gbt", "clf_adaboost", "clf_boosted_meta", "prediction_export", "stack_meta"]
#: Rows between these fares are left out of the separable table.
LOW_FARE, HIGH_FARE = 200_000, 320_000


@pytest.fixture(scope="module")
def rows(spark):
    """row_id -> split, of all rows."""
    return {r.row_id: r.split for r in manifest(spark, SMALL).select("row_id", "split").collect()}


@pytest.mark.parametrize("name", PER_ROW)
def test_every_unlabelled_row_has_one_prediction(spark, rows, name):
    found = QUERIES[name](spark, SMALL)
    got = found.collect()
    assert sorted(r.row_id for r in got) == sorted(k for k, split in rows.items() if split == "test")
    for c in set(found.columns) - {"row_id"}:
        assert {int(r[c]) for r in got} <= {0, 1}


def test_stack_oof_has_every_row_and_model_once(spark, rows):
    got = QUERIES["stack_oof"](spark, SMALL).collect()
    assert sorted((r.row_id, r.model) for r in got) == sorted((k, m) for k in rows for m in STACK_BASE)


@pytest.fixture(scope="module")
def separable(spark):
    """Rows outside a band of fares; whether the fare is above it is the label."""
    m = manifest(spark, SMALL).filter((F.col("fare") <= LOW_FARE) | (F.col("fare") >= HIGH_FARE))
    m = (m.withColumn("label", (F.col("fare") >= HIGH_FARE).cast("int"))
         .withColumn("fare", F.floor(F.col("fare") / 20_000) * 20_000.0))
    return cut_lineage(ml_frame(m))


#: A single extra tree draws a few features and random thresholds; Bernoulli sees no fare.
FINDS = {**{m: 1.0 for m in q_ml.LEADERBOARD}, "rbf_svm": 0.9, "knn": 0.95, "extra_tree": 0.7, "bernoulli_nb": 0.4}


@pytest.mark.parametrize("model", q_ml.LEADERBOARD)
def test_classifiers_find_a_limit_outside_which_all_rows_lie(separable, model):
    fitted = make(model).fit(separable.filter("split = 'train'"))
    right = fitted.transform(separable.filter("split = 'test'")).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")))
    assert right.first()[0] >= FINDS[model]


def test_leaderboard_has_all_models_and_full_scores(spark):
    got = QUERIES["model_leaderboard"](spark, SMALL).collect()
    assert sorted(r.model for r in got) == sorted(q_ml.LEADERBOARD)
    assert [r.test_mean for r in got] == sorted((r.test_mean for r in got), reverse=True)
    assert all(abs(r.test_3std - 3 * r.test_std) < 1e-9 and 0 < r.train_mean <= 1 and r.params is not None for r in got)


def test_cross_validation_gives_the_spread(spark):
    got = QUERIES["cross_val_accuracy"](spark, SMALL).collect()
    assert sorted(r.model for r in got) == sorted(q_ml.CV_MODELS + q_ml.CV_ENSEMBLES)
    assert all(r.n_folds == 10 and 0 < r.std_accuracy < 0.5 and 0 < r.mean_accuracy < 1 for r in got)


def test_importances_are_a_table_of_feature_and_model(spark, monkeypatch):
    got = QUERIES["feature_importance"](spark, SMALL)
    models = [m for m in STACK_BASE if m != "linear_svm"]
    assert got.columns == ["feature", *models]
    rows = got.collect()
    assert sorted(r.feature for r in rows) == sorted(FEATURES)
    assert all(abs(sum(r[m] for r in rows) - 1) < 1e-6 for m in models)


def test_grid_search_has_the_three_grids(spark, monkeypatch):
    monkeypatch.setattr(q_ml, "ROUNDS", [5, 20, 40])
    got = QUERIES["grid_search"](spark, SMALL).collect()
    names = {"knn": [f"n_neighbors={k}" for k in q_ml.NEIGHBOURS], "rbf_svm": [f"C={c}" for c in q_ml.SVM_C],
             "gbt": ["n_estimators=5", "n_estimators=20", "n_estimators=40"]}
    for grid, params in names.items():
        mine = [r for r in got if r.grid == grid]
        assert [r.params for r in mine] == params and sum(r.best for r in mine) == 1
        assert max(mine, key=lambda r: r.mean_accuracy).mean_accuracy == next(r for r in mine if r.best).mean_accuracy
        assert all(0 < r.std_accuracy < 0.5 for r in mine)
