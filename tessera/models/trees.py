"""Tree ensembles grown level by level from aggregates.

All trees that can grow at the same time do: one reading of the rows per level
gives the statistics of every open node of every tree and every fold, and the
driver, which holds only those sums, chooses the splits.  A fold's ensemble is
fitted on the rows outside it, so cross-validation reads no more often than one fit.

* ``ExtraTrees``: a random threshold per (node, drawn feature) within the node's
  box, the best of them taken by Gini impurity.  Draws depend on seed, tree and
  node alone, and counts are exact, so a lost block gives the same trees again.
* ``Boosted``: second-order boosting.  Gradients and curvatures are summed per
  (node, feature, bin); gain and leaf values have the penalties ``reg_lambda``,
  ``gamma`` and ``min_child_weight``; rows and columns are drawn by hash.
  ``staged`` gives the scores after any of its rounds in one pass.
* ``AdaBoost`` (SAMME, Zhu et al. 2009): all stumps of a round from one weighted
  histogram, which also holds the chosen stump's error; the votes are one literal
  array that is folded over per row.

Trees are complete binary trees in arrays; a node that is not split has an infinite
threshold, so its rows go left to a copy of it.
"""

from __future__ import annotations

import math
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.models.blocks import Block, blocks, draw, total

#: Candidate thresholds of a feature.
BINS = 64
#: Rounds after which the rows' running scores are brought up to date.
REFRESH = 8
#: Rows of a task at least, where there are so many.
TASK_ROWS = 1 << 15


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Candidate thresholds: middles between neighbouring values if a feature has
    at most ``bins`` of them, else approximate quantiles."""
    probs = [i / bins for i in range(1, bins)]
    x = [F.col(c).cast("double") for c in features]
    row = df.agg(*[F.percentile_approx(c, probs, 10_000).alias(f"q{i}") for i, c in enumerate(x)],
                 *[F.min(c).alias(f"l{i}") for i, c in enumerate(x)], *[F.max(c).alias(f"h{i}") for i, c in enumerate(x)],
                 *[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)]).first()
    few = [i for i in range(len(features)) if (row[f"n{i}"] or 0) <= bins]
    exact = df.agg(*[F.array_sort(F.collect_set(x[i])).alias(f"v{i}") for i in few]).first() if few else {}
    out = []
    for i in range(len(features)):
        values = np.array(exact[f"v{i}"] if i in few else sorted({row[f"l{i}"], row[f"h{i}"], *(row[f"q{i}"] or [])}), float)
        out.append((values[:-1] + values[1:]) / 2 if i in few else values[:-1])
    return out


def _codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value, a row per feature.  ``x <= edges[b]`` is ``code <= b``."""
    out = np.zeros((len(edges), len(x)), np.uint8 if max(map(len, edges)) < 255 else np.int32)
    for f, e in enumerate(edges):
        out[f] = np.searchsorted(e, x[:, f], side="left")
    return out


def _descend(columns: np.ndarray, feature: np.ndarray, limit: np.ndarray, levels: int) -> np.ndarray:
    """The place within its level that each row comes to after ``levels`` splits of
    one tree.  ``columns``: a row of values (or bins) per feature; a node with an
    infinite limit is not split.  A few vector comparisons per node are much cheaper
    than looking up each row's own feature and limit."""
    n, kind = columns.shape[1], float if columns.dtype.kind == "f" else int
    node = np.zeros(n, np.uint8 if levels < 8 else np.int32)
    which, limits = feature.tolist(), limit.tolist()
    for level in range(levels):
        first, right = 2 ** level - 1, None
        for j in range(2 ** level):
            if limits[first + j] < math.inf:
                goes = columns[which[first + j]] > kind(limits[first + j])
                if level:
                    goes &= node == j
                right = goes if right is None else np.logical_or(right, goes, out=right)
        node <<= 1
        if right is not None:
            node |= right
    return node


class Trees:
    """Trees of equal depth: feature and threshold of inner nodes, values of all
    nodes.  A row goes left at ``x <= threshold``."""

    def __init__(self, many: int, depth: int):
        self.depth = depth
        self.feature = np.zeros((many, 2 ** depth - 1), np.int64)
        self.threshold = np.full((many, 2 ** depth - 1), np.inf)
        self.value = np.zeros((many, 2 ** (depth + 1) - 1))

    def nodes(self, x: np.ndarray, levels: int, trees: np.ndarray | None = None) -> np.ndarray:
        """The node that each row reaches in each tree after ``levels`` splits."""
        which = np.arange(len(self.feature)) if trees is None else trees
        columns = np.ascontiguousarray(x.T)
        out = np.zeros((len(x), which.size), np.int64)
        for j, t in enumerate(which.tolist()):
            out[:, j] = _descend(columns, self.feature[t], self.threshold[t], levels)
        return out + 2 ** levels - 1

    def running(self, columns: np.ndarray) -> Iterator[np.ndarray]:
        """The sum of the values of the first 1, 2, ... trees for each row (one array,
        added to); ``columns``: a row of values per feature."""
        total, leaves = np.zeros(columns.shape[1]), 2 ** self.depth - 1
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            total += value[leaves:].take(_descend(columns, feature, threshold, self.depth))
            yield total


class TreesModel(Model):
    """``kind``: 'sum' (the sign of start + sum of values decides) or 'mean' (the
    mean share of class 1, 0.5 going to class 0)."""

    def __init__(self, cols, trees: Trees, prediction_col: str, kind: str, start: float, importances: np.ndarray):
        super().__init__()
        self.cols, self.trees, self.prediction_col, self.kind = list(cols), trees, prediction_col, kind
        self.start, self._importances = start, importances

    @property
    def featureImportances(self):
        return Vectors.dense(self._importances)

    def _scored(self, counts: Sequence[int]) -> Column:
        trees, d, start, ends, wanted = self.trees, len(self.cols), self.start, np.array(counts), set(counts)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                flat = np.full((len(x), ends.size), start)
                for done, run in enumerate(trees.running(np.ascontiguousarray(x.T)), 1):
                    if done in wanted:
                        flat[:, ends == done] = start + run[:, None]
                yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * ends.size, pa.int32()), pa.array(flat.ravel()))

        return score(F.array(*[F.col(c).cast("double") for c in self.cols]))

    def predicted(self, columns: np.ndarray) -> np.ndarray:
        """The predictions of rows; ``columns``: a row of values per feature."""
        run, many = np.zeros(columns.shape[1]), len(self.trees.feature)
        for run in self.trees.running(columns):
            pass
        return (self.start + run > (0.0 if self.kind == "sum" else 0.5 * many)).astype(float)

    def staged(self, df: DataFrame, counts: Sequence[int], name: str = "staged") -> DataFrame:
        """``df`` with the predictions after each of ``counts`` trees (an array)."""
        return df.withColumn(name, F.transform(self._scored(counts), lambda s: (s > 0).cast("double")))

    def _transform(self, df: DataFrame) -> DataFrame:
        many = len(self.trees.feature)
        cut = 0.0 if self.kind == "sum" else 0.5 * many
        return df.withColumn(self.prediction_col, (self._scored([many])[0] > cut).cast("double"))


def _by_row(models: Sequence[Model]) -> tuple[int, Column, list[Callable]]:
    d = len(models[0].cols)
    return d, F.array(*[F.col(c).cast("double") for c in models[0].cols]), [_Predictor(m) for m in models]


class _Predictor:
    """What tasks need of a model with ``predicted``."""

    def __init__(self, model: Model):
        self.kind = type(model)
        self.held = {n: getattr(model, n) for n in ("trees", "kind", "start", "stumps") if hasattr(model, n)}

    def __call__(self, columns: np.ndarray) -> np.ndarray:
        return self.kind.predicted(types.SimpleNamespace(**self.held), columns)


def every_prediction(models: Sequence[Model]) -> Column:
    """The predictions of several models with ``predicted`` of the same columns, as an
    array, from one reading of the rows."""
    d, x, predictors = _by_row(models)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = np.ascontiguousarray(batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).T)
            got = np.stack([p(columns) for p in predictors], axis=1)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * len(predictors), pa.int32()), pa.array(got.ravel()))

    return predict(x)


def asked_predictions(models: Sequence[Model], asked: Column) -> Column:
    """The prediction of the model at the place ``asked``, or, at -1, the sum of the
    predictions of all."""
    d, x, predictors = _by_row(models)

    @F.arrow_udf(T.DoubleType())
    def predict(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, place in batches:
            columns, place = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).T, place.to_numpy()
            out = np.zeros(len(place))
            for i, p in enumerate(predictors):
                rows = np.flatnonzero((place == i) | (place == -1))
                out[rows] += p(np.ascontiguousarray(columns[:, rows]))
            yield pa.array(out)

    return predict(x, asked)


def _normal(importances: np.ndarray) -> np.ndarray:
    whole = importances.sum()
    return importances / whole if whole > 0 else importances


class _Forest(Estimator):
    cols: list[str]
    label_col: str
    #: Whether each level reads the blocks (else they are read once, to make others).
    rereads = True

    def _fit(self, df: DataFrame):
        return self.fit_folds(df, None, [-1])[0]

    def fit_folds(self, df: DataFrame, fold_col: str | None, folds: Sequence[int]) -> list[Model]:
        """A model for each of ``folds``, fitted without its rows."""
        labelled = df.where(F.col(self.label_col).isNotNull())
        rows = labelled.count()
        if not rows:
            raise ValueError("there are no labelled rows")
        rdd = blocks(df, self.cols, self.label_col, fold_col, kept=self.rereads)
        try:
            # a task of a few rows takes longer to start than to run, in each of hundreds of jobs
            tasks = min(rdd.getNumPartitions(), -(-rows // TASK_ROWS))
            return self._grown(labelled, rdd.coalesce(tasks) if tasks < rdd.getNumPartitions() else rdd, list(folds))
        finally:
            if self.rereads:
                rdd.unpersist()

    def _grown(self, df: DataFrame, rdd: RDD, folds: list[int]) -> list[Model]:
        raise NotImplementedError


class ExtraTrees(_Forest):
    """Extremely randomised trees.  ``max_features``: features drawn per node
    (None: the root of their number; one tree usually draws so, too)."""

    def __init__(self, cols: Sequence[str], n_trees: int = 50, max_depth: int = 5, min_leaf: int = 3, max_features: int | None = None,
                 seed: int = 7, label_col: str = "label", prediction_col: str = "prediction"):
        super().__init__()
        self.cols, self.n_trees, self.max_depth, self.min_leaf = list(cols), n_trees, max_depth, min_leaf
        self.max_features, self.seed, self.label_col, self.prediction_col = max_features, seed, label_col, prediction_col

    def _drawn(self, tree: int, node: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of a node with room between their bounds and a threshold each."""
        rng = np.random.default_rng([self.seed, tree, node])
        order, share = rng.permutation(len(self.cols)), rng.random(len(self.cols))
        k = self.max_features or max(1, int(math.sqrt(len(self.cols))))
        order = order[high[order] > low[order]][:k]
        return order, low[order] + share[order] * (high[order] - low[order])

    def _grown(self, df: DataFrame, rdd: RDD, folds: list[int]) -> list[Model]:
        d = len(self.cols)
        least, most = (np.array(v) for v in zip(*df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("x"))
                                                                                 for i, c in enumerate(self.cols)])).alias("s"))
                                                .groupBy("s.i").agg(F.min("s.x").alias("a"), F.max("s.x").alias("b"))
                                                .orderBy("i").select("a", "b").collect()))
        held = np.repeat(folds, self.n_trees)
        many = held.size
        trees = Trees(many, self.max_depth)
        low, high = (np.broadcast_to(v, (many, 1, d)).copy() for v in (least, most))
        importances = np.zeros((many, d))
        width = self.max_features or max(1, int(math.sqrt(d)))
        for level in range(self.max_depth + 1):
            nodes, first = 2 ** level, 2 ** level - 1
            feature = np.full((many, nodes, width), -1, np.int64)
            limit = np.full((many, nodes, width), np.inf)
            if level < self.max_depth:
                for t in range(many):
                    for j in range(nodes):
                        # the same tree of every fold draws alike
                        f, cut = self._drawn(t % self.n_trees, first + j, low[t, j], high[t, j])
                        feature[t, j, :f.size], limit[t, j, :f.size] = f, cut

            def of_block(block: Block, level=level, nodes=nodes, first=first, feature=feature, limit=limit):
                every = np.zeros((many, nodes, 2))
                left = np.zeros((many, nodes, width, 2))
                for fold in folds:
                    counted = block.fold != fold if fold >= 0 else slice(None)
                    columns, label = np.ascontiguousarray(block.x[counted].T), block.y[counted].astype(np.int64)
                    for t in np.flatnonzero(held == fold).tolist():
                        place = _descend(columns, trees.feature[t], trees.threshold[t], level)
                        at = place * np.int64(2) + label
                        every[t] += np.bincount(at, minlength=2 * nodes).reshape(nodes, 2)
                        for j in range(width if level < self.max_depth else 0):
                            goes = np.zeros(at.size, bool)
                            for k in np.flatnonzero(feature[t, :, j] >= 0).tolist():
                                under = columns[feature[t, k, j]] <= limit[t, k, j]
                                goes |= under & (place == k) if level else under
                            left[t, :, j] += np.bincount(at[goes], minlength=2 * nodes).reshape(nodes, 2)
                return [every, left]

            every, left = total(rdd, of_block)
            n = every.sum(axis=2)
            with np.errstate(invalid="ignore", divide="ignore"):
                share = np.where(n > 0, every[:, :, 1] / n, 0.0)
            at = slice(first, first + nodes)
            trees.value[:, at] = np.where(n > 0, share, trees.value[:, (first - 1) // 2:(first - 1) // 2 + max(1, nodes // 2)].repeat(2, axis=1)[:, :nodes]
                                          if level else 0.0)
            if level == self.max_depth:
                break

            def impurity(counts):  # rows times Gini impurity
                size = counts.sum(axis=-1)
                return np.where(size > 0, size - (counts ** 2).sum(axis=-1) / np.maximum(size, 1), 0.0)

            right = every[:, :, None, :] - left
            gain = impurity(every)[:, :, None] - impurity(left) - impurity(right)
            fine = (feature >= 0) & (left.sum(-1) >= self.min_leaf) & (right.sum(-1) >= self.min_leaf)
            gain = np.where(fine, gain, -1.0)
            best = gain.argmax(axis=2)
            next_low, next_high = np.repeat(low, 2, axis=1), np.repeat(high, 2, axis=1)
            for t, j in zip(*np.nonzero(np.take_along_axis(gain, best[:, :, None], 2)[:, :, 0] > 0)):
                k = best[t, j]
                f, cut = feature[t, j, k], limit[t, j, k]
                trees.feature[t, first + j], trees.threshold[t, first + j] = f, cut
                importances[t, f] += gain[t, j, k]
                next_high[t, 2 * j, f], next_low[t, 2 * j + 1, f] = cut, cut
            low, high = next_low, next_high
        out = []
        for i in range(len(folds)):
            mine = slice(i * self.n_trees, (i + 1) * self.n_trees)
            part = Trees(self.n_trees, self.max_depth)
            part.feature, part.threshold, part.value = trees.feature[mine], trees.threshold[mine], trees.value[mine]
            each = np.array([_normal(v) for v in importances[mine]])
            out.append(TreesModel(self.cols, part, self.prediction_col, "mean", 0.0, _normal(each.sum(axis=0))))
        return out


class _Cells:
    """The bins of all features in one row: what a task sends has no room for bins that
    a feature does not have."""

    def __init__(self, edges: list[np.ndarray]):
        self.sizes = [len(e) + 1 for e in edges]
        self.total, self.width = sum(self.sizes), max(self.sizes)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).tolist()

    def wide(self, sums: np.ndarray) -> np.ndarray:
        """(..., feature, bin), with zeros after a feature's last bin."""
        out = np.zeros((*sums.shape[:-1], len(self.sizes), self.width))
        for f, (first, size) in enumerate(zip(self.first, self.sizes)):
            out[..., f, :size] = sums[..., first:first + size]
        return out


class _Running:
    """Rows as bins (a row per feature), with the running score of each fold's
    ensemble (a row per fold).  ``route``: bins for going down a tree, where a
    missing value goes left."""

    def __init__(self, codes: np.ndarray, route: np.ndarray | None, y: np.ndarray, fold: np.ndarray, key: np.ndarray, score: np.ndarray):
        self.codes, self.route, self.y, self.fold, self.key, self.score = codes, route, y, fold, key, score

    @classmethod
    def of(cls, block: Block, edges: list[np.ndarray], folds: int, key: bool) -> _Running:
        codes, missing = _codes(block.x, edges), np.isnan(block.x).T
        return cls(codes, np.where(missing, 0, codes).astype(codes.dtype) if missing.any() else None, block.y.astype(np.uint8), block.fold,
                   block.key if key else block.key[:0], np.zeros((folds, len(block.y))))

    def scored(self, score: np.ndarray) -> _Running:
        return _Running(self.codes, self.route, self.y, self.fold, self.key, score)

    def outside(self, fold: int) -> np.ndarray | None:
        """Which rows count for a fold's ensemble (None: all)."""
        counted = self.fold != fold
        return None if fold < 0 or counted.all() else counted


def _added(route: np.ndarray, recent: tuple, depth: int) -> np.ndarray:
    """The sum of the values (of all nodes or of leaves) of some trees over bins."""
    out = np.zeros(route.shape[1])
    for feature, limit, value in zip(*recent):
        out += value[-2 ** depth:].take(_descend(route, feature, limit, depth))
    return out


def _slim(feature: np.ndarray, limit: np.ndarray, value: np.ndarray) -> tuple:
    """Trees over bins as small arrays: every later job carries them."""
    return feature.astype(np.int32), limit.astype(np.float32), value[:, value.shape[1] // 2:].copy()


class Boosted(_Forest):
    """Boosting of log loss with gradients and curvatures (see module text).
    ``reg_lambda=0, gamma=0`` is plain Newton boosting."""

    rereads = False

    def __init__(self, cols: Sequence[str], n_rounds: int = 100, max_depth: int = 3, learning_rate: float = 0.1,
                 reg_lambda: float = 0.0, gamma: float = 0.0, min_child_weight: float = 0.0, min_leaf: int = 1,
                 subsample: float = 1.0, colsample: float = 1.0, bins: int = BINS, seed: int = 7,
                 label_col: str = "label", prediction_col: str = "prediction"):
        super().__init__()
        self.cols, self.n_rounds, self.max_depth, self.learning_rate = list(cols), n_rounds, max_depth, learning_rate
        self.reg_lambda, self.gamma, self.min_child_weight, self.min_leaf = reg_lambda, gamma, min_child_weight, min_leaf
        self.subsample, self.colsample, self.bins, self.seed = subsample, colsample, bins, seed
        self.label_col, self.prediction_col = label_col, prediction_col

    def _columns(self, round_no: int) -> np.ndarray:
        """Whether each feature is drawn for a round."""
        d = len(self.cols)
        if self.colsample >= 1:
            return np.ones(d, bool)
        keep = np.zeros(d, bool)
        keep[np.random.default_rng([self.seed, round_no]).permutation(d)[:max(1, round(self.colsample * d))]] = True
        return keep

    def _grown(self, df: DataFrame, rdd: RDD, folds: list[int]) -> list[Model]:
        edges = bin_edges(df, self.cols, self.bins)
        cells = _Cells(edges)
        d, m, width = len(self.cols), len(folds), cells.width
        drawing = self.subsample < 1
        running = rdd.map(lambda b: _Running.of(b, edges, m, drawing)).persist(StorageLevel.MEMORY_AND_DISK)
        past = None  # the rows before the scores were last brought up to date

        def sizes(block: _Running):
            kept = [block.y[block.fold != f] if f >= 0 else block.y for f in folds]
            return [np.array([float(y.size) for y in kept]), np.array([float(y.sum()) for y in kept])]

        n, ones = total(running, sizes)
        share = np.clip(ones / n, 1e-6, 1 - 1e-6)
        start = np.log(share / (1 - share))
        grown = [Trees(self.n_rounds, self.max_depth) for _ in folds]
        # the trees' limits as bins
        bins = [g.threshold.copy() for g in grown]
        importances = np.zeros((m, d))
        # which cells of (feature, bin) end a bin at a real threshold
        real = np.array([[b < len(edges[f]) for b in range(width)] for f in range(d)])
        edge_of = np.array([list(e) + [np.inf] * (width - len(e)) for e in edges])
        shown = 0  # rounds whose trees the running scores hold
        for r in range(self.n_rounds):
            columns = self._columns(r)
            if r - shown >= REFRESH:
                past, running = running, _refreshed(running, [_slim(g.feature[shown:r], b[shown:r], g.value[shown:r]) for g, b in zip(grown, bins)], self.max_depth)
                shown = r
            for level in range(self.max_depth):
                nodes, first = 2 ** level, 2 ** level - 1
                # the trees since the scores were brought up to date, and the one that grows
                recent = [_slim(g.feature[shown:r], b[shown:r], g.value[shown:r]) for g, b in zip(grown, bins)]
                grows = [(g.feature[r], b[r]) for g, b in zip(grown, bins)]

                def of_block(block: _Running, level=level, nodes=nodes, recent=recent, grows=grows, r=r):
                    out = np.zeros((3, m, nodes, cells.total))
                    drawn = draw(block.key, self.seed, r) < self.subsample if drawing else None
                    route = block.codes if block.route is None else block.route
                    for i in range(m):
                        counted = block.outside(folds[i])
                        if counted is not None and not counted.any():
                            continue
                        score = start[i] + block.score[i]
                        if len(recent[i][0]):
                            score += _added(route, recent[i], self.max_depth)
                        p = 1.0 / (1.0 + np.exp(-score))
                        # gradient, curvature and count; rows that do not count weigh nothing
                        weights = p - block.y, p * (1 - p), np.ones(p.size)
                        for w in weights:
                            for which in (counted, drawn):
                                if which is not None:
                                    w *= which
                        at_node = _descend(route, *grows[i], level).astype(np.int64)
                        for code, at, size in zip(block.codes, cells.first, cells.sizes):
                            place = at_node * size + code if level else code.astype(np.int64)
                            for w, sums in zip(weights, out):
                                sums[i, :, at:at + size] = np.bincount(place, w, nodes * size).reshape(nodes, size)
                    return [out]

                sums = cells.wide(total(running, of_block, size=3 * m * nodes * cells.total)[0])
                if past is not None:  # the new scores are kept now
                    past.unpersist()
                    past = None
                whole = sums[:, :, :, 0].sum(axis=-1)  # gradient, curvature, rows of each node
                if not level:
                    for g, v in zip(grown, self._values(whole)):
                        g.value[r, 0] = v[0]
                gain, best = self._gains(sums, whole, columns, real)
                left = sums.cumsum(axis=-1).reshape(3, m, nodes, -1)
                # a split gives its children's sums; without one all rows go to the left copy
                cut = np.take_along_axis(left, best[None, :, :, None], 3)[..., 0]
                cut = np.where(gain > 0, cut, whole)
                value = self._values(np.stack([cut, whole - cut], axis=-1).reshape(3, m, -1))
                under = 2 * first + 1
                for i in range(m):
                    split = gain[i] > 0
                    f, b = best[i] // width, best[i] % width
                    grown[i].feature[r, first:first + nodes][split] = f[split]
                    grown[i].threshold[r, first:first + nodes][split] = edge_of[f, b][split]
                    bins[i][r, first:first + nodes][split] = b[split]
                    np.add.at(importances[i], f[split], gain[i][split])
                    both = split.repeat(2)
                    above = grown[i].value[r, first:first + nodes].repeat(2)
                    grown[i].value[r, under:under + 2 * nodes] = np.where(both, value[i], above)
                if not (gain > 0).any():  # nothing splits: the values of this level hold below, too
                    for g in grown:
                        for deeper in range(level + 2, self.max_depth + 1):
                            at = 2 ** deeper - 1
                            g.value[r, at:at + 2 ** deeper] = g.value[r, at // 2:at // 2 + 2 ** (deeper - 1)].repeat(2)
                    break
        running.unpersist()
        return [TreesModel(self.cols, g, self.prediction_col, "sum", float(s), _normal(v)) for g, s, v in zip(grown, start, importances)]

    def _values(self, whole: np.ndarray) -> np.ndarray:
        """What nodes with these sums add to a score."""
        return -whole[0] / np.maximum(whole[1] + self.reg_lambda, 1e-12) * self.learning_rate

    def _gains(self, sums: np.ndarray, whole: np.ndarray, columns: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best split of each node: its gain and (feature, bin) as one number."""
        left = sums.cumsum(axis=-1)
        right = whole[:, :, :, None, None] - left

        def worth(s):
            return s[0] ** 2 / np.maximum(s[1] + self.reg_lambda, 1e-12)

        gain = 0.5 * (worth(left) + worth(right) - worth(whole)[:, :, None, None]) - self.gamma
        least = max(self.min_child_weight, 1e-12)
        fine = (left[1] >= least) & (right[1] >= least) & (left[2] >= self.min_leaf) & (right[2] >= self.min_leaf)
        gain = np.where(fine & real & columns[:, None], gain, 0.0)
        # differences of rounding are no gain
        gain[gain < 1e-9] = 0.0
        flat = gain.reshape(*gain.shape[:2], -1)
        best = flat.argmax(axis=2)
        return np.take_along_axis(flat, best[:, :, None], 2)[:, :, 0], best


def _refreshed(running: RDD, recent: list[tuple], depth: int) -> RDD:
    """The blocks with the recent trees added to the scores, kept when they are read."""
    def add(block: _Running) -> _Running:
        route = block.codes if block.route is None else block.route
        return block.scored(block.score + np.stack([_added(route, trees, depth) for trees in recent]))

    return running.map(add).persist(StorageLevel.MEMORY_AND_DISK)


class AdaBoostModel(Model):
    """``stumps``: (feature, threshold, vote left, vote right), votes being for
    class 1 if positive."""

    def __init__(self, cols, stumps, prediction_col, importances):
        super().__init__()
        self.cols, self.stumps, self.prediction_col, self._importances = list(cols), stumps, prediction_col, importances

    @property
    def featureImportances(self):
        return Vectors.dense(self._importances)

    def votes(self) -> Column:
        """The sum of all votes: one literal array, folded over for each row."""
        listed = F.from_json(F.lit("[" + ",".join(
            f'{{"f":{f},"t":{t!r},"l":{a!r},"r":{b!r}}}' for f, t, a, b in self.stumps) + "]"), "array<struct<f:int,t:double,l:double,r:double>>")
        x = F.array(*[F.col(c).cast("double") for c in self.cols])
        return F.aggregate(listed, F.lit(0.0), lambda total, s: total + F.when(
            F.element_at(x, s["f"] + 1) <= s["t"], s["l"]).otherwise(s["r"]))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.prediction_col, (self.votes() > 0).cast("double"))

    def predicted(self, columns: np.ndarray) -> np.ndarray:
        """The predictions of rows; ``columns``: a row of values per feature.  What is
        not below a limit, a missing value too, goes right."""
        out = np.zeros(columns.shape[1])
        for f, limit, left, right in self.stumps:  # in the order of ``votes``
            out += np.where(columns[f] <= limit, left, right)
        return (out > 0).astype(float)


class AdaBoost(_Forest):
    """SAMME over decision stumps (two classes)."""

    rereads = False

    def __init__(self, cols: Sequence[str], n_estimators: int = 50, learning_rate: float = 1.0, bins: int = BINS,
                 label_col: str = "label", prediction_col: str = "prediction"):
        super().__init__()
        self.cols, self.n_estimators, self.learning_rate, self.bins = list(cols), n_estimators, learning_rate, bins
        self.label_col, self.prediction_col = label_col, prediction_col

    def _grown(self, df: DataFrame, rdd: RDD, folds: list[int]) -> list[Model]:
        edges = bin_edges(df, self.cols, self.bins)
        cells = _Cells(edges)
        d, m, width = len(self.cols), len(folds), cells.width
        # the running score is the logarithm of a row's weight
        running = rdd.map(lambda b: _Running.of(b, edges, m, False)).persist(StorageLevel.MEMORY_AND_DISK)
        past = None  # the rows before the scores were last brought up to date
        stumps: list[list[tuple]] = [[] for _ in folds]
        bins: list[list[float]] = [[] for _ in folds]  # the stumps' limits as bins
        grow = np.ones(m, bool)
        importances = np.zeros((m, d))
        shown = 0
        real = np.array([[b < len(edges[f]) for b in range(width)] for f in range(d)])
        for r in range(self.n_estimators):
            recent = [[(s[0], b, *s[2:]) for s, b in zip(s[shown:], b[shown:])] for s, b in zip(stumps, bins)]
            if r - shown >= REFRESH:
                def add(block: _Running, done=recent) -> _Running:
                    return block.scored(block.score + np.stack([_missed(block.codes, block.y, s) for s in done]))

                past, running, shown, recent = running, running.map(add).persist(StorageLevel.MEMORY_AND_DISK), r, [[] for _ in folds]

            def of_block(block: _Running, recent=recent):
                out = np.zeros((m, 2, cells.total))
                # by feature: the cell of a row by its label and bin
                places = [block.y * np.int64(size) + code for code, size in zip(block.codes, cells.sizes)]
                for i in range(m):
                    counted = block.outside(folds[i])
                    weight = np.exp(block.score[i] + _missed(block.codes, block.y, recent[i]))
                    if counted is not None:
                        weight *= counted
                    for place, at, size in zip(places, cells.first, cells.sizes):
                        out[i, :, at:at + size] = np.bincount(place, weight, 2 * size).reshape(2, size)
                return [out]

            sums = cells.wide(total(running, of_block, size=2 * m * cells.total)[0])
            if past is not None:  # the new scores are kept now
                past.unpersist()
                past = None
            for i in np.flatnonzero(grow).tolist():
                grow[i] = self._round(sums[i] / sums[i, :, 0].sum(), edges, real, stumps[i], bins[i], importances[i])
            if not grow.any():
                break
        running.unpersist()
        return [AdaBoostModel(self.cols, s, self.prediction_col, _normal(v)) for s, v in zip(stumps, importances)]

    def _round(self, counts: np.ndarray, edges, real, stumps: list, bins: list, importance: np.ndarray) -> bool:
        """Adds the stump of least Gini impurity (``counts``: class, feature, bin);
        whether another round may follow."""
        left = counts.cumsum(axis=-1)
        whole = counts[:, 0].sum(axis=-1)
        right = whole[:, None, None] - left

        def impurity(s):
            size = np.maximum(s.sum(axis=0), 1e-300)
            return size - (s ** 2).sum(axis=0) / size

        # weights of rounding errors are no side
        fine = real & (left.sum(axis=0) > 1e-12) & (right.sum(axis=0) > 1e-12)
        gain = np.where(fine, impurity(whole[:, None, None]) - impurity(left) - impurity(right), -1.0)
        f, b = divmod(int(gain.argmax()), gain.shape[1])
        if gain[f, b] <= 0:  # nothing splits: a vote for the larger class
            sides, error, cut, b = (int(whole[1] > whole[0]),) * 2, float(whole.min()), math.inf, math.inf
            gained = 0.0
        else:
            sides = (int(left[1, f, b] > left[0, f, b]), int(right[1, f, b] > right[0, f, b]))
            error = float(left[1 - sides[0], f, b] + right[1 - sides[1], f, b])
            cut, gained = float(edges[f][b]), float(gain[f, b])
        last = error <= 1e-15 or error >= 0.5
        if error >= 0.5 and stumps:
            return False
        alpha = 1.0 if last else self.learning_rate * math.log((1 - error) / error)
        cut = min(cut, 1.7e308)
        stumps.append((f, cut, alpha if sides[0] else -alpha, alpha if sides[1] else -alpha))
        bins.append(b)
        importance[f] += alpha * gained
        return not last


def _missed(codes: np.ndarray, y: np.ndarray, stumps: list[tuple]) -> np.ndarray:
    """The sum of votes of the stumps (feature, bin, votes) that a row's label contradicts."""
    out = np.zeros(y.size)
    for f, b, *votes in stumps:
        # by side and label: right of the limit, label 1
        lost = np.array([abs(v) if (v > 0) != label else 0.0 for v in votes for label in (False, True)])
        out += lost[2 * (codes[f] > b) + y]
    return out
