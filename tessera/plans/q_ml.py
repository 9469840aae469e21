"""Model evaluation queries.

The fitted queries learn the manifest's own label and fit, score and export over
every row of it; a null fare is filled like any other feature.  SQL states the
models in closed form (``o_ml``); the others are tested against brute force, and
on a label that fares determine (tests/test_ml_*.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.models import evaluate as EV
from tessera.models import stacking as ST
from tessera.models.classifiers import make
from tessera.models.features import FEATURES, ml_frame
from tessera.models.trees import Boosted
from tessera.plans.catalog import query
from tessera.session import cut_lineage, keep, scratch_folder
from tessera.sources import files
from tessera.sources.manifest import manifest


def R(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _frame(spark, sf):
    """Feature rows of the whole manifest."""
    # iterative fits plan and read the frame many times: materialise it once in
    # the checkpoint folder, so every fit starts from a plain scan
    return cut_lineage(ml_frame(manifest(spark, sf)))


def _labelled(spark, sf, k=5, how="contiguous"):
    """Labelled rows with a fold column: 'contiguous' (KFold without
    shuffling) or 'stratified' (integer cv on a classifier)."""
    data = _frame(spark, sf).filter(F.col("label").isNotNull())
    if how == "stratified":
        return EV.stratified_folds(data, k, "row_id", "label")
    return EV.contiguous_folds(data, k, "row_id")


# ---- splits and folds (SQL-checkable) -----------------------------------------------------

@query("train_test_split")
def q_train_test_split(spark, sf):
    m = manifest(spark, sf).filter(F.col("split") == "train")
    return m.select("row_id", EV.holdout_split(m, "row_id", 0.2, 7).alias("part"))


@query("kfold_assign")
def q_kfold_assign(spark, sf):
    m = manifest(spark, sf).filter(F.col("split") == "train").select("row_id")
    folded = EV.contiguous_folds(m, 5, "row_id", "fold")
    return folded.select("row_id", "fold", EV.shuffled_folds("row_id", 5, 7).alias("fold_shuffled"))


@query("stratified_kfold")
def q_stratified_kfold(spark, sf):
    m = manifest(spark, sf).filter(F.col("split") == "train").select("row_id", "label")
    return EV.stratified_folds(m, 5, "row_id", "label", "fold").select("row_id", "label", "fold")


# ---- fitted models ---------------------------------------------------------------------------

@query("accuracy")
def q_accuracy(spark, sf):
    data = _frame(spark, sf).filter(F.col("label").isNotNull()).withColumn(
        "part", EV.holdout_split(None, "row_id", 0.2, 7))
    model = make("gaussian_nb").fit(data.filter(F.col("part") == "train"))
    test = model.transform(data.filter(F.col("part") == "test"))
    return test.agg(F.lit("gaussian_nb").alias("model"), R(EV.accuracy(test)).alias("accuracy"),
                    F.count(F.lit(1)).alias("n_test"))


#: Both rounds of the comparison: single models, then ensembles.
CV_MODELS = ["logistic", "lda", "knn", "tree", "gaussian_nb", "rbf_svm"]
CV_ENSEMBLES = ["adaboost", "gbt", "random_forest", "extra_trees"]


@query("cross_val_accuracy")
def q_cross_val_accuracy(spark, sf):
    scores = EV.cross_validate(spark, _labelled(spark, sf, 10), CV_MODELS + CV_ENSEMBLES, k=10)
    return scores.groupBy("model").agg(R(F.avg("test_accuracy")).alias("mean_accuracy"),
                                       R(F.stddev_pop("test_accuracy")).alias("std_accuracy"),
                                       F.count(F.lit(1)).alias("n_folds"))


LEADERBOARD = ["logistic", "logistic_cv", "ridge", "lda", "qda", "knn", "tree", "extra_tree", "gaussian_nb", "bernoulli_nb",
               "linear_svm", "rbf_svm", "random_forest", "tuned_forest", "extra_trees", "bagging", "gbt", "adaboost",
               "boosted_meta"]


@query("model_leaderboard")
def q_model_leaderboard(spark, sf):
    """Fit times are measured, so they are left out of the compared columns."""
    scores = EV.cross_validate(spark, _labelled(spark, sf, 5, "stratified"), LEADERBOARD, k=5)
    return EV.summarize(scores).drop("fit_seconds")


#: The grids: neighbours, C of the kernel SVM, boosting rounds.
NEIGHBOURS, SVM_C, ROUNDS = [1, 3, 5, 7, 9, 15, 19, 21], [1, 1.3, 1.5, 1.7], [10, 50, 100, 150, 200, 250, 300]


@query("grid_search")
def q_grid_search(spark, sf):
    data = keep(_labelled(spark, sf, 10))
    found = [EV.search_neighbours(spark, data, FEATURES, NEIGHBOURS, 10).withColumn("grid", F.lit("knn")),
             EV.search_svm(spark, data, FEATURES, SVM_C, 10).withColumn("grid", F.lit("rbf_svm")),
             EV.search_rounds(spark, data, Boosted(FEATURES, max_depth=3, learning_rate=0.1), ROUNDS, 10)
             .withColumn("grid", F.lit("gbt"))]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _clf_query(name, models):
    """Predictions of the unlabelled rows: ``prediction`` of the first model, and a
    column named after each further one."""
    @query(name)
    def q(spark, sf):
        data = _frame(spark, sf)
        train, out = data.filter(F.col("label").isNotNull()), data.filter(F.col("label").isNull())
        for m in models:
            scored = make(m).fit(train).transform(out)
            out = scored.withColumn(f"__{m}", F.col("prediction").cast("int")).drop(
                "prediction", "rawPrediction", "probability")
        return out.select("row_id", F.col(f"__{models[0]}").alias("prediction"), *[F.col(f"__{m}").alias(m) for m in models[1:]])
    return q


for _q, *_m in [("clf_logistic", "logistic_cv", "logistic"), ("clf_ridge", "ridge"), ("clf_lda_qda", "qda", "lda"),
                ("clf_tree", "tree"), ("clf_nb", "gaussian_nb", "bernoulli_nb"), ("clf_linear_svm", "linear_svm"),
                ("clf_rbf_svm", "rbf_svm"), ("clf_random_forest", "random_forest"),
                ("clf_extra_trees", "extra_trees", "extra_tree"), ("clf_bagging", "bagging"), ("clf_gbt", "gbt"),
                ("clf_adaboost", "adaboost"), ("clf_boosted_meta", "boosted_meta")]:
    _clf_query(_q, _m)


@query("prediction_export")
def q_prediction_export(spark, sf):
    data = _frame(spark, sf)
    model = make("gbt").fit(data.filter(F.col("label").isNotNull()))
    scored = model.transform(data.filter(F.col("label").isNull()))
    path = scratch_folder(spark, "predictions")
    out = files.export_predictions(scored, "row_id", "prediction", path)
    return files.read_csv_typed(spark, path, out.schema)


STACK_BASE = ["random_forest", "extra_trees", "adaboost", "gbt", "linear_svm"]


def _stack(spark, sf):
    data = _frame(spark, sf).withColumn("fold", EV.shuffled_folds("row_id", 5, 0))
    return data, ST.stack_oof(spark, data, STACK_BASE, k=5)


@query("stack_oof")
def q_stack_oof(spark, sf):
    _, (oof, _) = _stack(spark, sf)
    return oof.select("row_id", "model", R("value").alias("value"))


@query("stack_meta")
def q_stack_meta(spark, sf):
    data, (oof, _) = _stack(spark, sf)
    return ST.stack_meta(oof, data.select("row_id", "label"), STACK_BASE)


@query("feature_importance")
def q_feature_importance(spark, sf):
    tree_models = [m for m in STACK_BASE if m != "linear_svm"]
    data = _frame(spark, sf).withColumn("fold", EV.shuffled_folds("row_id", 5, 0))
    return ST.importance_table(ST.fold_importances(spark, data, tree_models, k=5), tree_models)
