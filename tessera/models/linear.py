"""Many linear classifiers fitted together.

Logistic regression and the linear SVM with squared hinge loss, for any number of
settings (a penalty, a fold held out) at once: every Newton iteration is one
reading of the rows, in which each block multiplies its features with the weights
of all settings and gives the sums of loss, gradient and curvature.  Rows of a
setting's held-out fold do not count for it.  Objective of a setting:

    sum of losses + penalty / 2 * sum of squared weights (without the intercept)

with ``penalty = 1 / C``.  Features are standardised by the rows that a setting is
fitted on.  The kernel SVM is the same fit over random Fourier features (Rahimi &
Recht 2007), computed per block: an approximation of the exact kernel machine.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.models.blocks import Block, blocks, draw, total

LOGISTIC, HINGE = "logistic", "squared_hinge"


@dataclasses.dataclass
class Setting:
    loss: str
    penalty: float
    held_out: int = -1  # fold


@dataclasses.dataclass
class Fitted:
    weights: np.ndarray
    intercept: float
    gradient: float  # largest component of the objective's gradient per row


def _losses(kind: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature by the margin y * score, a column per setting."""
    logistic = kind == LOGISTIC
    value, slope, bend = (np.empty(margin.shape) for _ in range(3))
    z = margin[:, logistic]
    p = 1.0 / (1.0 + np.exp(np.clip(z, -500, 500)))
    value[:, logistic], slope[:, logistic], bend[:, logistic] = np.logaddexp(0.0, -z), -p, p * (1 - p)
    short = np.maximum(0.0, 1.0 - margin[:, ~logistic])
    value[:, ~logistic], slope[:, ~logistic], bend[:, ~logistic] = short ** 2, -2 * short, 2.0 * (short > 0)
    return value, slope, bend


def _moments(rdd: RDD, folds: Sequence[int], mapped) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means and deviations of the features without each of ``folds``."""
    def plain(block: Block):
        x = mapped(block.x)
        return [np.array([float(len(x))]), x.sum(axis=0)]

    n, s = total(rdd, plain)
    middle = s / n

    def about(block: Block):
        x = mapped(block.x) - middle
        kept = np.stack([block.fold != f for f in folds]).astype(float)
        return [kept.sum(axis=1), kept @ x, kept @ (x * x)]

    n, s, ss = total(rdd, about)
    mean = s / n[:, None]
    sd = np.sqrt(np.maximum(ss / n[:, None] - mean ** 2, 0.0))
    return n, middle + mean, np.where(sd > 0, sd, 1.0)


def fit_linear(rdd: RDD, settings: Sequence[Setting], standardise: bool = True,
               mapped: Callable[[np.ndarray], np.ndarray] | None = None, tolerance: float = 1e-8,
               iterations: int = 60) -> list[Fitted]:
    """A fit for each setting over the blocks' rows (labels 0 and 1)."""
    mapped = mapped or (lambda x: x)
    kind = np.array([s.loss for s in settings])
    held = np.array([s.held_out for s in settings])
    if rdd.isEmpty():
        raise ValueError("there are no labelled rows")
    folds = sorted(set(held.tolist()))
    # fold -1 marks rows without a fold: a setting that holds it out holds out none
    n, mean, sd = _moments(rdd, [f if f >= 0 else -2 for f in folds], mapped)
    place = [folds.index(f) for f in held.tolist()]
    n, mean, sd = n[place], mean[place], sd[place]
    d = mean.shape[1]
    middle, spread = (mean.mean(axis=0), sd.mean(axis=0)) if standardise else (np.zeros(d), np.ones(d))
    # weights are those of commonly scaled features; each setting's own scale is in its penalty
    ridge = np.zeros((len(settings), d + 1))
    ridge[:, :d] = np.array([s.penalty for s in settings])[:, None] * ((sd / spread) ** 2 if standardise else 1.0)

    def sums(w: np.ndarray, active: np.ndarray):
        def of_block(block: Block):
            x = np.column_stack([(mapped(block.x) - middle) / spread, np.ones(len(block.y))])
            sign = (2 * block.y - 1)[:, None]
            counts = (block.fold[:, None] != held[active]) | (held[active] < 0)
            value, slope, bend = _losses(kind[active], sign * (x @ w[active].T))
            curve = np.stack([(x * (bend[:, m] * counts[:, m])[:, None]).T @ x for m in range(active.size)])
            return [(value * counts).sum(axis=0), (slope * sign * counts).T @ x, curve]
        return total(rdd, of_block, size=active.size * (d + 1) ** 2)

    m = len(settings)
    w, step = np.zeros((m, d + 1)), np.zeros((m, d + 1))
    last, shrink, gradient = np.full(m, np.inf), np.ones(m), np.full(m, np.inf)
    active = np.arange(m)
    for _ in range(iterations):
        trial = w.copy()
        trial[active] += shrink[active, None] * step[active]
        loss, slope, curve = sums(trial, active)
        value = loss + 0.5 * (ridge[active] * trial[active] ** 2).sum(axis=1)
        better = value <= last[active] + 1e-12 * np.abs(value)
        for j, k in enumerate(active.tolist()):
            if not better[j] and shrink[k] > 1e-6:
                shrink[k] /= 2
                continue
            w[k], last[k], shrink[k] = trial[k], value[j], 1.0
            g = slope[j] + ridge[k] * w[k]
            gradient[k] = np.abs(g).max() / n[k]
            step[k] = -np.linalg.lstsq(curve[j] + np.diag(ridge[k] + 1e-12), g, rcond=None)[0]
        active = active[gradient[active] > tolerance]
        if not active.size:
            break
    out = []
    for k in range(m):
        weights = w[k, :d] / spread
        out.append(Fitted(weights, float(w[k, d] - weights @ middle), float(gradient[k])))
    return out


class LinearClassifierModel(Model):
    def __init__(self, cols: Sequence[str], fitted: Fitted, prediction_col: str):
        super().__init__()
        self.cols, self.fitted, self.prediction_col = list(cols), fitted, prediction_col

    def _transform(self, df: DataFrame) -> DataFrame:
        score = F.lit(self.fitted.intercept)
        for c, w in zip(self.cols, self.fitted.weights.tolist()):
            score = score + F.lit(w) * F.col(c)
        return df.withColumn(self.prediction_col, (score > 0).cast("double"))


class LinearClassifier(Estimator):
    """Logistic regression or linear SVM.  With several ``C`` the one with the best
    accuracy over ``inner`` folds (by a hash of the row) is taken; all of them and
    all folds are fitted in the same scans."""

    def __init__(self, cols: Sequence[str], loss: str = LOGISTIC, C: float | Sequence[float] = 1.0, inner: int = 3,
                 label_col: str = "label", prediction_col: str = "prediction"):
        super().__init__()
        self.cols, self.loss, self.C, self.inner = list(cols), loss, C, inner
        self.label_col, self.prediction_col = label_col, prediction_col

    def _model(self, fitted: Fitted) -> LinearClassifierModel:
        return LinearClassifierModel(self.cols, fitted, self.prediction_col)

    def _fit(self, df: DataFrame) -> LinearClassifierModel:
        return self.fit_folds(df, None, [-1])[0]

    def fit_folds(self, df: DataFrame, fold_col: str | None, folds: Sequence[int]) -> list[LinearClassifierModel]:
        """A model for each of ``folds``, fitted without its rows."""
        rdd = blocks(df, self.cols, self.label_col, fold_col)
        try:
            if isinstance(self.C, (int, float)):
                return [self._model(f) for f in fit_linear(rdd, [Setting(self.loss, 1 / self.C, f) for f in folds])]
            best = _best_penalties(rdd, self.loss, list(self.C), folds, self.inner)
            return [self._model(f) for f in fit_linear(rdd, [Setting(self.loss, 1 / c, f) for c, f in zip(best, folds)])]
        finally:
            rdd.unpersist()


def _best_penalties(rdd: RDD, loss: str, choices: list[float], folds: Sequence[int], inner: int) -> list[float]:
    """For each outer fold the C whose fits without each inner fold are right most
    often on that inner fold (of the rows outside the outer one)."""
    out = []
    for f in folds:
        rows = rdd if f < 0 else rdd.map(lambda b, f=f: Block(b.x[b.fold != f], b.y[b.fold != f], b.fold[b.fold != f], b.key[b.fold != f]))
        parts = rows.map(lambda b: Block(b.x, b.y, (draw(b.key, 11) * inner).astype(np.int32), b.key))
        settings = [Setting(loss, 1 / c, j) for c in choices for j in range(inner)]
        fitted = fit_linear(parts, settings, tolerance=1e-5)

        def hits(block: Block):
            score = np.stack([block.x @ m.weights + m.intercept for m in fitted], axis=1) > 0
            mine = block.fold[:, None] == np.array([s.held_out for s in settings])
            return [((score == (block.y > 0)[:, None]) & mine).sum(axis=0).astype(float)]

        got = total(parts, hits)[0].reshape(len(choices), inner).sum(axis=1)
        out.append(choices[int(got.argmax())])
    return out


class Fourier:
    """z(x) = sqrt(2 / D) cos(W (x - mean) / deviation + b), W and b drawn from a seed."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, components: int, gamma: float, seed: int):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0.0, np.sqrt(2 * gamma), size=(mean.size, components)) / sd[:, None]
        self.b = rng.uniform(0, 2 * np.pi, size=components) - mean @ self.w
        self.scale = float(np.sqrt(2.0 / components))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.scale * np.cos(x @ self.w + self.b)


class RBFSVMModel(Model):
    def __init__(self, cols: Sequence[str], fourier: Fourier, fitted: Fitted, prediction_col: str):
        super().__init__()
        self.cols, self.fourier, self.fitted, self.prediction_col = list(cols), fourier, fitted, prediction_col

    def _transform(self, df: DataFrame) -> DataFrame:
        fourier, weights, intercept, d = self.fourier, self.fitted.weights, self.fitted.intercept, len(self.cols)

        @F.arrow_udf(T.DoubleType())
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                yield pa.array(fourier(x) @ weights + intercept)

        x = F.array(*[F.col(c).cast("double") for c in self.cols])
        return df.withColumn(self.prediction_col, (score(x) > 0).cast("double"))


class RBFSVM(Estimator):
    def __init__(self, cols: Sequence[str], label_col: str = "label", C: float = 1.0, gamma: float | None = None,
                 n_components: int = 100, seed: int = 7, prediction_col: str = "prediction"):
        super().__init__()
        self.cols, self.label_col, self.C, self.gamma = list(cols), label_col, C, gamma
        self.n_components, self.seed, self.prediction_col = n_components, seed, prediction_col

    def _fit(self, df: DataFrame) -> RBFSVMModel:
        return self.fit_folds(df, None, [-1])[0]

    def fit_folds(self, df: DataFrame, fold_col: str | None, folds: Sequence[int],
                  choices: Sequence[float] | None = None) -> list[RBFSVMModel]:
        """A model for each of ``folds`` (for each of ``choices`` of C, if given, and
        then each fold).  Inputs are standardised by all labelled rows."""
        rdd = blocks(df, self.cols, self.label_col, fold_col)
        try:
            if rdd.isEmpty():
                raise ValueError("there are no labelled rows")
            _, mean, sd = _moments(rdd, [-2], lambda x: x)
            gamma = self.gamma or 1.0 / len(self.cols)   # 'scale' on standardised inputs
            fourier = Fourier(mean[0], sd[0], self.n_components, gamma, self.seed)
            settings = [Setting(HINGE, 1 / c, f) for c in (choices or [self.C]) for f in folds]
            return [RBFSVMModel(self.cols, fourier, f, self.prediction_col)
                    for f in fit_linear(rdd, settings, standardise=False, mapped=fourier)]
        finally:
            rdd.unpersist()
