"""Classifier factories: Spark ML estimators (or the library's own) keyed
by name, all reading ``features`` / ``label`` and writing ``prediction``.

The library's own have ``fit_folds``: the models of all folds of a
cross-validation from shared readings of the rows (moments, Newton steps, tree
levels); neighbours have ``score_folds``, which searches once for all folds.  ``rbf_svm`` is random Fourier features + linear SVM, an approximation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.models.discriminant import MomentClassifier
from tessera.models.features import FEATURES
from tessera.models.linear import HINGE, LinearClassifier, RBFSVM
from tessera.models.trees import AdaBoost, Boosted, ExtraTrees
from tessera.operators.knn import spread_neighbours
from tessera.operators.knn_folds import fold_accuracies


class KNNClassifierModel(Model):
    def __init__(self, fitted, cols, lo, span, ks, weights, prediction_col):
        super().__init__()
        self.fitted, self.cols, self.lo, self.span = fitted, list(cols), lo, span
        self.ks, self.weights, self.prediction_col = list(ks), weights, prediction_col

    def _scaled(self):
        return [(F.col(c) - self.lo[c]) / self.span[c] for c in self.cols]

    def every_k(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with a struct of the predictions of each of ``ks``, from one search."""
        return self.fitted.search(df, self._scaled(), self.ks, self.weights, name)

    def _transform(self, df: DataFrame) -> DataFrame:
        found = self.fitted.search(df, self._scaled(), self.ks[:1], self.weights, "__nearest")
        return found.withColumn(self.prediction_col, F.col("__nearest")[f"k{self.ks[0]}"].cast("double")).drop("__nearest")


class KNNClassifier(Estimator):
    """k nearest neighbours (exact, ``operators.knn``) on feature columns that are
    min-max scaled by the labelled rows (others may lie outside [0, 1]).  ``ks``:
    the first is the model's; ``every_k`` gives all."""

    def __init__(self, cols=FEATURES, ks: Sequence[int] = (5,), weights: str = "uniform", label_col: str = "label",
                 prediction_col: str = "prediction"):
        super().__init__()
        self.cols, self.ks, self.weights, self.label_col = list(cols), list(ks), weights, label_col
        self.prediction_col = prediction_col

    def _fit(self, df: DataFrame) -> KNNClassifierModel:
        data = df.filter(F.col(self.label_col).isNotNull())
        st = data.agg(*[F.min(c).alias(f"lo_{c}") for c in self.cols],
                      *[F.max(c).alias(f"hi_{c}") for c in self.cols]).first()
        if st[0] is None:
            raise ValueError("there are no labelled rows")
        lo = {c: float(st[f"lo_{c}"]) for c in self.cols}
        span = {c: (float(st[f"hi_{c}"]) - lo[c]) or 1.0 for c in self.cols}
        model = KNNClassifierModel(None, self.cols, lo, span, self.ks, self.weights, self.prediction_col)
        scaled = data.select(*[x.alias(c) for c, x in zip(self.cols, model._scaled())], F.col(self.label_col).alias("label"))
        model.fitted = spread_neighbours(scaled, self.cols, "label")
        return model

    def score_folds(self, df: DataFrame, fold_col: str, folds: Sequence[int], train: bool = True) -> dict[tuple[int, int], tuple]:
        """(fold, k) -> accuracy on the other folds' rows (if ``train``) and on its own
        of the model fitted without it, for each of ``ks``; one search for all folds."""
        return fold_accuracies(df, self.cols, self.label_col, fold_col, folds, self.ks, train)


#: Penalties of the tuned logistic regression (ten from 1e-4 to 1e4).
LOGISTIC_C = [10.0 ** (-4 + 8 * i / 9) for i in range(10)]

FACTORIES = {
    "logistic": lambda: LinearClassifier(FEATURES, C=1.0),
    "logistic_cv": lambda: LinearClassifier(FEATURES, C=LOGISTIC_C),
    "ridge": lambda: MomentClassifier(FEATURES, "ridge"),
    "lda": lambda: MomentClassifier(FEATURES, "linear"),
    "qda": lambda: MomentClassifier(FEATURES, "quadratic"),
    "knn": lambda: KNNClassifier(),
    "tree": lambda: DecisionTreeClassifier(maxDepth=5, seed=7),
    "extra_tree": lambda: ExtraTrees(FEATURES, n_trees=1, max_depth=8, min_leaf=1),
    "gaussian_nb": lambda: MomentClassifier(FEATURES, "gaussian"),
    "bernoulli_nb": lambda: MomentClassifier(FEATURES, "bernoulli"),
    "linear_svm": lambda: LinearClassifier(FEATURES, HINGE, C=1.0),
    "rbf_svm": lambda: RBFSVM(FEATURES, C=1.0, n_components=100),
    "random_forest": lambda: RandomForestClassifier(numTrees=50, maxDepth=5, minInstancesPerNode=2, seed=7),
    "tuned_forest": lambda: RandomForestClassifier(numTrees=100, maxDepth=7, minInstancesPerNode=6,
                                                   featureSubsetStrategy="sqrt", impurity="gini", seed=7),
    "extra_trees": lambda: ExtraTrees(FEATURES, n_trees=50, max_depth=5, min_leaf=3),
    "bagging": lambda: RandomForestClassifier(numTrees=10, maxDepth=8, featureSubsetStrategy="all",
                                              bootstrap=True, seed=7),
    "gbt": lambda: Boosted(FEATURES, n_rounds=50, max_depth=3, learning_rate=0.1),
    "adaboost": lambda: AdaBoost(FEATURES, n_estimators=50, learning_rate=0.95),
    "boosted_meta": lambda: Boosted(FEATURES, n_rounds=20, max_depth=4, learning_rate=0.95, reg_lambda=1.0, gamma=1.0,
                                    min_child_weight=2.0, subsample=0.8, colsample=0.8),
}


def make(name: str, cols: Sequence[str] | None = None):
    """The estimator called ``name``; the library's own read ``cols`` if given."""
    made = FACTORIES[name]()
    if cols is not None and hasattr(made, "cols"):
        made.cols = list(cols)
    return made
