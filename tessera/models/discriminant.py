"""Classifiers in closed form from class moments: linear and quadratic discriminant
analysis, Gaussian and Bernoulli naive Bayes, and ridge.

Fitting needs counts, means and scatter matrices per class (and, for
cross-validation, per fold): sums of d x d products over blocks of rows, independent
of the row count.  Moments are additive, so one pass over the rows serves all folds,
all penalties and all of these models: a fold is left out by adding up the other
folds' moments, and even a held-out fold's squared error follows from its moments.
The small solves run on the driver; decision functions are plain column expressions
(linear or quadratic), so scoring stays in codegen.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.models.blocks import Block, blocks, total


@dataclasses.dataclass
class Moments:
    """Rows, means, centred products; rows above the least value of each feature."""
    n: float
    mean: np.ndarray
    scatter: np.ndarray
    above: np.ndarray


def merged(parts: Sequence[Moments]) -> Moments:
    n = sum(p.n for p in parts)
    mean = sum(p.n * p.mean for p in parts) / n
    scatter = sum(p.scatter + p.n * np.outer(p.mean - mean, p.mean - mean) for p in parts)
    return Moments(n, mean, scatter, sum(p.above for p in parts))


def class_moments(df: DataFrame, cols: Sequence[str], label: str, fold: str | Column | None = None) -> dict[tuple, Moments]:
    """(fold, class) -> moments of the labelled rows.  The rows are read into blocks
    once; products are summed about the means, so large means lose nothing."""
    rdd = blocks(df, cols, label, fold)
    try:
        found = total(rdd, lambda b: [np.array([float(len(b.y))]), b.x.sum(axis=0)])
        if found is None:
            return {}
        middle = found[1] / found[0]
        least = total(rdd, lambda b: [b.x.min(axis=0)], np.minimum)[0]

        def of_block(block: Block):
            out = {}
            for f, y in sorted(set(zip(block.fold.tolist(), block.y.tolist()))):
                x = block.x[(block.fold == f) & (block.y == y)]
                z = x - middle
                out[f, y] = (float(len(z)), z.sum(axis=0), z.T @ z, (x > least).sum(axis=0).astype(float))
            return [out]

        def either(a: dict, b: dict) -> dict:
            return {k: tuple(u + v for u, v in zip(a[k], b[k])) if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}

        out = {}
        for k, (n, s, products, above) in total(rdd, of_block, either)[0].items():
            out[k] = Moments(n, middle + s / n, products - np.outer(s, s) / n, above)
        return out
    finally:
        rdd.unpersist()


def without(moments: dict[tuple, Moments], fold: int | None) -> dict[float, Moments]:
    """Each class's moments without a fold (None: with all)."""
    classes = sorted({y for _, y in moments})
    parts = {y: [m for (f, c), m in moments.items() if c == y and (fold is None or f != fold)] for y in classes}
    return {y: merged(p) for y, p in parts.items() if p}


def largest(scores: dict[float, Column]) -> Column:
    """The class with the largest score, ties to the smallest class."""
    best = None
    for c in sorted(scores, reverse=True):
        cond = F.lit(True)
        for o in scores:
            if o != c:
                cond = cond & ((scores[c] > scores[o]) if o < c else (scores[c] >= scores[o]))
        best = F.when(cond, F.lit(float(c))) if best is None else best.when(cond, F.lit(float(c)))
    return best


class ScoreModel(Model):
    """``scores``: class -> (constant, linear, quadratic terms or None) over the
    columns (``above``: over whether they exceed these values)."""

    def __init__(self, cols, terms, prediction_col, above=None):
        super().__init__()
        self.cols, self.terms, self.prediction_col, self.above = list(cols), terms, prediction_col, above

    def _score(self, x: list[Column], c: float) -> Column:
        const, lin, quad = self.terms[c]
        e = F.lit(float(const))
        for i, w in enumerate(lin):
            e = e + F.lit(float(w)) * x[i]
        if quad is not None:
            for i in range(len(x)):
                for j in range(i, len(x)):
                    q = quad[i, j] if i == j else quad[i, j] + quad[j, i]
                    if q != 0:
                        e = e + F.lit(float(q)) * x[i] * x[j]
        return e

    def _transform(self, df: DataFrame) -> DataFrame:
        x = [F.col(k) for k in self.cols]
        if self.above is not None:
            x = [(c > F.lit(float(v))).cast("double") for c, v in zip(x, self.above)]
        return df.withColumn(self.prediction_col, largest({c: self._score(x, c) for c in self.terms}))


def linear_terms(mom: dict[float, Moments], reg: float) -> dict:
    total, d = sum(m.n for m in mom.values()), len(next(iter(mom.values())).mean)
    pooled = sum(m.scatter for m in mom.values()) / max(total - len(mom), 1) + reg * np.eye(d)
    inv = np.linalg.pinv(pooled)
    return {c: (-0.5 * m.mean @ inv @ m.mean + np.log(m.n / total), inv @ m.mean, None) for c, m in mom.items()}


def quadratic_terms(mom: dict[float, Moments], reg: float) -> dict:
    total, out = sum(m.n for m in mom.values()), {}
    for c, m in mom.items():
        cov = m.scatter / max(m.n - 1, 1) + reg * np.eye(len(m.mean))
        inv = np.linalg.pinv(cov)
        # -0.5 (x-mu)' inv (x-mu) = -0.5 x'inv x + mu'inv x - 0.5 mu'inv mu
        out[c] = (-0.5 * np.linalg.slogdet(cov)[1] - 0.5 * m.mean @ inv @ m.mean + np.log(m.n / total), inv @ m.mean, -0.5 * inv)
    return out


def gaussian_terms(mom: dict[float, Moments], smoothing: float = 1e-9) -> dict:
    """Independent normal features; variances are raised by ``smoothing`` times
    the largest variance of a feature over all rows."""
    every = merged(list(mom.values()))
    extra = smoothing * float(np.diag(every.scatter).max()) / every.n
    out = {}
    for c, m in mom.items():
        var = np.maximum(np.diag(m.scatter) / m.n + extra, 1e-300)
        const = np.log(m.n / every.n) - 0.5 * np.log(2 * np.pi * var).sum() - 0.5 * (m.mean ** 2 / var).sum()
        out[c] = (const, m.mean / var, np.diag(-0.5 / var))
    return out


def bernoulli_terms(mom: dict[float, Moments], smoothing: float = 1.0) -> dict:
    """Features as 'above the least value or not', counts raised by ``smoothing``."""
    total, out = sum(m.n for m in mom.values()), {}
    for c, m in mom.items():
        p = (m.above + smoothing) / (m.n + 2 * smoothing)
        out[c] = (np.log(m.n / total) + np.log(1 - p).sum(), np.log(p) - np.log(1 - p), None)
    return out


def ridge_weights(mom: dict[float, Moments], alpha: float) -> tuple[np.ndarray, float]:
    """Least squares of -1 / 1 with penalty ``alpha`` on the weights: (weights,
    intercept)."""
    every = merged(list(mom.values()))
    target = {c: 2 * c - 1 for c in mom}
    middle = sum(m.n * target[c] for c, m in mom.items()) / every.n
    cross = sum(m.n * (target[c] - middle) * (m.mean - every.mean) for c, m in mom.items())
    w = np.linalg.solve(every.scatter + alpha * np.eye(len(cross)) + 1e-12 * np.trace(every.scatter) * np.eye(len(cross)), cross)
    return w, middle - w @ every.mean


def squared_error(mom: dict[float, Moments], w: np.ndarray, b: float) -> float:
    """Sum of squared errors of the linear fit over the rows behind ``mom``."""
    return sum(m.n * (2 * c - 1 - b - w @ m.mean) ** 2 + w @ m.scatter @ w for c, m in mom.items())


def best_alpha(moments: dict[tuple, Moments], alphas: Sequence[float]) -> float:
    """The penalty with the least held-out squared error over the folds."""
    folds = sorted({f for f, _ in moments})
    if len(folds) < 2:
        return alphas[0]
    error = []
    for a in alphas:
        found = 0.0
        for f in folds:
            w, b = ridge_weights(without(moments, f), a)
            found += squared_error({c: m for (g, c), m in moments.items() if g == f}, w, b)
        error.append(found)
    return alphas[int(np.argmin(error))]


def ridge_terms(moments: dict[tuple, Moments], alphas: Sequence[float]) -> dict:
    mom = without(moments, None)
    w, b = ridge_weights(mom, best_alpha(moments, alphas) if len(alphas) > 1 else alphas[0])
    return {0.0: (0.0, np.zeros_like(w), None), 1.0: (b, w, None)}


class MomentClassifier(Estimator):
    """One of these models over ``cols``.  ``inner`` folds (by a hash of the features)
    serve those that choose a penalty."""

    def __init__(self, cols: Sequence[str], kind: str, label_col: str = "label", prediction_col: str = "prediction",
                 reg: float = 1e-6, alphas: Sequence[float] = (0.1, 1.0, 10.0), inner: int = 3):
        super().__init__()
        self.cols, self.kind, self.label_col, self.prediction_col = list(cols), kind, label_col, prediction_col
        self.reg, self.alphas, self.inner = reg, list(alphas), inner

    def _model(self, moments: dict[tuple, Moments], least: np.ndarray | None) -> ScoreModel:
        """The model of all rows behind ``moments`` (by inner fold and class)."""
        mom = without(moments, None)
        kinds: dict[str, Callable[[], dict]] = {
            "linear": lambda: linear_terms(mom, self.reg), "quadratic": lambda: quadratic_terms(mom, self.reg),
            "gaussian": lambda: gaussian_terms(mom), "bernoulli": lambda: bernoulli_terms(mom),
            "ridge": lambda: ridge_terms(moments, self.alphas)}
        return ScoreModel(self.cols, kinds[self.kind](), self.prediction_col, least if self.kind == "bernoulli" else None)

    def _fit(self, df: DataFrame) -> ScoreModel:
        return self.fit_folds(df, None, [-1])[0]

    def fit_folds(self, df: DataFrame, fold_col: str | None, folds: Sequence[int]) -> list[ScoreModel]:
        """A model for each of ``folds``, without its rows, from one pass over all."""
        part = F.pmod(F.xxhash64(*self.cols), F.lit(self.inner))
        outer = F.col(fold_col) if fold_col else F.lit(-1)
        # fold and inner fold as one number: (fold + 1) * inner + part
        both = (outer.cast("int") + 1) * self.inner + part
        found = class_moments(df, self.cols, self.label_col, both if self.kind == "ridge" else (outer.cast("int") + 1) * self.inner)
        if not found:
            raise ValueError("there are no labelled rows")
        least = None
        if self.kind == "bernoulli":
            row = df.where(F.col(self.label_col).isNotNull()).agg(*[F.min(c).alias(f"l{i}") for i, c in enumerate(self.cols)]).first()
            least = np.array([row[f"l{i}"] for i in range(len(self.cols))], float)
        out = []
        for f in folds:
            kept = {(k, y): m for (k, y), m in found.items() if f < 0 or k // self.inner - 1 != f}
            inner: dict[tuple, list[Moments]] = {}
            for (k, y), m in kept.items():
                inner.setdefault((k % self.inner, y), []).append(m)
            out.append(self._model({k: merged(v) for k, v in inner.items()}, least))
        return out


def DiscriminantAnalysis(cols: Sequence[str], label_col: str = "label", kind: str = "linear",
                         prediction_col: str = "prediction", reg: float = 1e-6) -> MomentClassifier:
    """``kind='linear'`` (pooled covariance) or ``'quadratic'`` (per class)."""
    return MomentClassifier(cols, kind, label_col, prediction_col, reg)
