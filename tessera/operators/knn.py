"""Exact k-nearest-neighbour classification with a partition tree.

Labelled points are folded to distinct (features, label) with a multiplicity and
split at the median of their widest dimension until a cell has at most ``LEAF``
points, so cells hold equally many points whatever their density; every node has
the bounding box of its points.  The tree is broadcast: its size is bounded by
``max_points`` labelled points, a documented parameter (beyond it the points with
the smallest hashes are taken).

Queries stay where they are.  Those of an Arrow batch are folded to distinct
points and searched together: each looks into its own cell, which bounds the
distance of its k-th neighbour, then goes down the tree to the cells whose box is
within that bound and visits them nearest box first, until the next box is
farther than the k-th neighbour found (equal distances are still visited).  No
pair of a query and a point beyond such cells is ever formed.

``spread_neighbours`` does the same for any number of labelled points without a tree
that the driver or a worker must hold: points are dealt to cells of space whose
borders come from a sample, and a cell's tree is built by the task that searches it.
A query is searched in its own cell first, then in all cells whose box is within the
distance of the k-th neighbour found there, and the neighbours are merged.

Order among equal distances: label ascending.  Vote: ``'distance'`` weights
1/d, and if some neighbours are at distance 0 only they count (scikit-learn);
``'uniform'`` counts.  Vote ties go to the smallest label.
"""

from __future__ import annotations

import functools
import operator
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.session import keep

#: Most points of a cell, most labelled points of a tree, queries searched together.
LEAF, MAX_POINTS, QUERIES = 32, 1_000_000, 512
#: Of ``spread_neighbours``: points of a cell, and of the sample that places borders.
CELL, SAMPLE = 4096, 50_000


class PartitionTree:
    """Distinct points (rows of ``x``) with label codes and multiplicities."""

    def __init__(self, x: np.ndarray, label: np.ndarray, count: np.ndarray, leaf: int = LEAF):
        self.d = x.shape[1]
        order = np.arange(len(x))
        self.low, self.high, child, cells = [], [], [], []
        waiting = [(0, len(x))] if len(x) else []
        for start, end in waiting:  # grows while it is read: nodes in level order
            mine = x[order[start:end]]
            low, high = mine.min(axis=0), mine.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            if end - start <= leaf:
                child.append((-1, len(cells)))
                cells.append((start, end))
                continue
            half = (end - start) // 2
            wide = int(np.argmax(high - low))
            order[start:end] = order[start:end][np.argpartition(mine[:, wide], half)]
            child.append((len(waiting), -1))
            waiting += [(start, start + half), (start + half, end)]
        self.low, self.high = np.array(self.low).reshape(-1, self.d), np.array(self.high).reshape(-1, self.d)
        self.child, self.cell = np.array(child, np.int64).reshape(-1, 2).T
        # cells of equal width: missing points are infinitely far
        self.points = np.full((len(cells), leaf, self.d), np.inf)
        self.label = np.zeros((len(cells), leaf), np.int64)
        self.count = np.zeros((len(cells), leaf), np.int64)
        for k, (start, end) in enumerate(cells):
            mine = order[start:end]
            self.points[k, :end - start] = x[mine]
            self.label[k, :end - start] = label[mine]
            self.count[k, :end - start] = count[mine]
        self.visited = 0  # points compared, for measuring

    def _box(self, q: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Squared distance of each query to the box of its node."""
        out = np.zeros(len(q))
        for f in range(self.d):
            gap = np.maximum(np.maximum(self.low[node, f] - q[:, f], q[:, f] - self.high[node, f]), 0.0)
            out += gap * gap
        return out

    def _home(self, q: np.ndarray) -> np.ndarray:
        """The cell that each query comes to by the nearer child's box."""
        node = np.zeros(len(q), np.int64)
        while True:
            inner = np.flatnonzero(self.child[node] >= 0)
            if not inner.size:
                return node
            left = self.child[node[inner]]
            node[inner] = left + (self._box(q[inner], left + 1) < self._box(q[inner], left))

    def _visit(self, q: np.ndarray, rows: np.ndarray, node: np.ndarray, k: int, best, bound: np.ndarray) -> None:
        """Merges the points of a cell each into the best of ``rows``."""
        cell = self.cell[node]
        square = np.zeros(self.label[cell].shape)
        for f in range(self.d):
            gap = q[rows, f][:, None] - self.points[cell, :, f]
            square += gap * gap
        self.visited += int((self.count[cell] > 0).sum())
        square = np.concatenate([best[0][rows], square], axis=1)
        label = np.concatenate([best[1][rows], self.label[cell]], axis=1)
        count = np.concatenate([best[2][rows], self.count[cell]], axis=1)
        order = np.lexsort((label, square), axis=1)[:, :k]
        best[0][rows], best[1][rows], best[2][rows] = (np.take_along_axis(a, order, axis=1) for a in (square, label, count))
        # the distance within which there are k points, copies counted
        enough = best[2][rows].cumsum(axis=1) >= k
        at = np.where(enough.any(axis=1), enough.argmax(axis=1), k - 1)
        bound[rows] = best[0][rows, at]

    def nearest(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distances, label codes and multiplicities of the ``k`` nearest
        distinct points of each query, in (distance, label) order; fewer points
        leave infinite distances with multiplicity 0."""
        best = (np.full((len(q), k), np.inf), np.zeros((len(q), k), np.int64), np.zeros((len(q), k), np.int64))
        if not len(self.points) or not len(q):
            return best
        bound = np.full(len(q), np.inf)
        home = self._home(q)
        self._visit(q, np.arange(len(q)), home, k, best, bound)
        rows, node = np.arange(len(q)), np.zeros(len(q), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while rows.size:
            box = self._box(q[rows], node)
            near = box <= bound[rows]
            rows, node, box = rows[near], node[near], box[near]
            leaf = self.child[node] < 0
            other = leaf & (node != home[rows])
            found.append((rows[other], node[other], box[other]))
            rows, node = np.repeat(rows[~leaf], 2), np.repeat(self.child[node[~leaf]], 2)
            node[1::2] += 1
        rows, node, box = (np.concatenate(a) for a in zip(*found))
        order = np.lexsort((box, rows))
        rows, node, box = rows[order], node[order], box[order]
        first = np.searchsorted(rows, np.arange(len(q)))
        turn = np.arange(rows.size) - first[rows]
        by_turn = np.argsort(turn, kind="stable")
        ends = np.cumsum(np.bincount(turn)) if rows.size else []
        start = 0
        for end in ends:
            at = by_turn[start:end]
            at = at[box[at] <= bound[rows[at]]]
            if not at.size:  # boxes only get farther
                break
            self._visit(q, rows[at], node[at], k, best, bound)
            start = end
        return best

    @staticmethod
    def votes(near, k: int, weights: str, n_labels: int) -> np.ndarray:
        """The label code that the ``k`` nearest of each query choose."""
        square, label, count = near
        take = np.clip(k - (count.cumsum(axis=1) - count), 0, count)
        if weights == "distance":
            zero = ((square == 0) & (take > 0)).any(axis=1)
            with np.errstate(divide="ignore"):
                weight = np.where(zero[:, None], (square == 0).astype(float), 1.0 / np.sqrt(square))
            weight = np.where(take > 0, weight, 0.0) * take
        else:
            weight = take.astype(float)
        total = np.zeros((len(square), n_labels))
        for j in range(square.shape[1]):
            total[np.arange(len(square)), label[:, j]] += weight[:, j]
        return total.argmax(axis=1)


class Neighbours:
    """A fitted tree; ``predict`` gives columns for any rows."""

    def __init__(self, tree, labels: list, label_type: T.DataType, features: Sequence[str]):
        self.tree, self.labels, self.label_type, self.features = tree, labels, label_type, list(features)

    def predict(self, ks: Sequence[int], weights: str = "uniform", features: Sequence[Column] | None = None) -> Column:
        """A struct with a field ``k<k>`` for each of ``ks``: the label that the
        k nearest choose; null where a feature is null.  One search of the largest
        k serves all."""
        schema = T.StructType([T.StructField(f"k{k}", self.label_type) for k in ks])
        fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]
        tree, labels, most, d = self.tree, pa.array(self.labels, fields[0].type), max(ks), len(self.features)

        @F.arrow_udf(schema)
        def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            searched = tree.value
            for batch in batches:
                x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                known = ~np.isnan(x).any(axis=1) & (len(labels) > 0)
                points, back = np.unique(x[known], axis=0, return_inverse=True)
                chosen = np.zeros((len(points), len(ks)), np.int64)
                for at in range(0, len(points), QUERIES):
                    near = searched.nearest(points[at:at + QUERIES], most)
                    for j, k in enumerate(ks):
                        chosen[at:at + QUERIES, j] = searched.votes(near, k, weights, len(labels))
                code = np.zeros((len(x), len(ks)), np.int64)
                code[known] = chosen[back.ravel()]
                yield pa.StructArray.from_arrays(
                    [labels.take(pa.array(code[:, j], mask=~known)) for j in range(len(ks))], fields=fields)

        columns = features or [F.col(f) for f in self.features]
        return look_up(F.array(*[c.cast("double") for c in columns]))


def fit_neighbours(train: DataFrame, features: Sequence[str], label: str, max_points: int = MAX_POINTS) -> Neighbours:
    """The partition tree of the labelled rows without a null feature."""
    features = list(features)
    known = F.col(label).isNotNull()
    for f in features:
        known = known & F.col(f).isNotNull()
    points = (train.where(known).groupBy(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                                         F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")))
    spread = F.xxhash64(*[f"x{i}" for i in range(len(features))], "label")
    got = points.orderBy(spread, *points.columns).limit(max_points).toPandas()
    labels = sorted(got["label"].unique().tolist())
    code = {v: i for i, v in enumerate(labels)}
    tree = PartitionTree(got[[f"x{i}" for i in range(len(features))]].to_numpy(float),
                         got["label"].map(code).to_numpy(np.int64), got["n"].to_numpy(np.int64))
    return Neighbours(train.sparkSession.sparkContext.broadcast(tree), labels, train.schema[label].dataType, features)


def knn_classify(train: DataFrame, query: DataFrame, features: Sequence[str], label: str,
                 qid: str, k: int = 3, weights: str = "distance",
                 out: str = "prediction", max_points: int = MAX_POINTS) -> DataFrame:
    """(qid, out) for every query row."""
    fitted = fit_neighbours(train, features, label, max_points)
    return query.select(qid, fitted.predict([k], weights)[f"k{k}"].alias(out))


class Borders:
    """Cells of space by median splits of a sample along its widest dimension."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dim, self.cut, self.child, self.cells = [], [], [], 0
        least = max(1, len(sample) // max(1, cells))
        waiting = [sample]
        for mine in waiting:  # grows while it is read
            wide = int(np.argmax(np.ptp(mine, axis=0))) if len(mine) > 1 else 0
            values = np.sort(mine[:, wide])
            inner = values[values < values[-1]] if len(values) else values
            if len(mine) < 2 * least or not inner.size:
                self.dim.append(0)
                self.cut.append(0.0)
                self.child.append(-1 - self.cells)
                self.cells += 1
                continue
            cut = min(values[(len(values) - 1) // 2], inner[-1])
            self.dim.append(wide)
            self.cut.append(cut)
            self.child.append(len(waiting))
            waiting += [mine[mine[:, wide] <= cut], mine[mine[:, wide] > cut]]
        self.dim, self.cut, self.child = np.array(self.dim), np.array(self.cut), np.array(self.child)

    def cell(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(self.child[node] >= 0)).size:
            at = node[inner]
            node[inner] = self.child[at] + (x[inner, self.dim[at]] > self.cut[at])
        return -1 - self.child[node]


def _matrix(x: pa.Array, d: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


_NEAR = "array<struct<square:double,code:bigint,n:bigint>>"


class SpreadNeighbours:
    """Points with their cells, the cells' borders and boxes; ``search`` adds a
    column to any rows."""

    def __init__(self, points: DataFrame, borders: Borders, low: np.ndarray, high: np.ndarray, labels: list, label_type: T.DataType):
        self.points, self.borders, self.low, self.high = points, borders, low, high
        self.labels, self.label_type, self.d = labels, label_type, low.shape[1]

    def _searched(self, asked: DataFrame, most: int) -> DataFrame:
        """``asked`` (cell, x) with the nearest points of that cell and the distance
        within which there are ``most`` of them."""
        d = self.d

        def of_cell(asked: pa.Table, points: pa.Table) -> pa.Table:
            held = PartitionTree(_matrix(points["x"].combine_chunks(), d) if len(points) else np.zeros((0, d)),
                                 points["code"].to_numpy(), points["n"].to_numpy())
            x = _matrix(asked["x"].combine_chunks(), d) if len(asked) else np.zeros((0, d))
            size, bound, parts = [np.zeros(0, np.int64)], [np.zeros(0)], []
            for at in range(0, len(x), QUERIES):
                square, code, n = held.nearest(x[at:at + QUERIES], most)
                real = n > 0
                enough = n.cumsum(axis=1) >= most
                last = np.take_along_axis(square, enough.argmax(axis=1)[:, None], 1)[:, 0]
                bound.append(np.where(enough.any(axis=1), last, np.inf))
                size.append(real.sum(axis=1))
                parts.append((square[real], code[real], n[real]))
            flat = [np.concatenate(a) for a in zip(*parts)] if parts else [np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)]
            ends = np.concatenate([[0], np.cumsum(np.concatenate(size))]).astype(np.int32)
            near = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(a) for a in flat], ["square", "code", "n"]))
            return pa.table({"cell": asked["cell"], "x": asked["x"], "near": near, "bound": np.concatenate(bound)})

        return asked.groupBy("cell").cogroup(self.points.groupBy("cell")).applyInArrow(
            of_cell, f"cell bigint, x array<double>, near {_NEAR}, bound double")

    def _cells(self, x: Column) -> Column:
        borders, d = self.borders, self.d

        @F.arrow_udf(T.LongType())
        def cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                yield pa.array(borders.cell(_matrix(batch, d)))

        return cell(x)

    def _others(self, found: DataFrame) -> Column:
        """The cells, but a query's own, whose box is within its bound."""
        low, high, d = self.low, self.high, self.d

        @F.arrow_udf(T.ArrayType(T.LongType()))
        def others(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for x, home, bound in batches:
                x, home, bound = _matrix(x, d), home.to_numpy(), bound.to_numpy()
                size, cells = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
                for at in range(0, len(x), QUERIES):
                    mine = slice(at, at + QUERIES)
                    square = np.zeros((len(x[mine]), len(low)))
                    for f in range(d):
                        gap = np.maximum(np.maximum(low[:, f] - x[mine, f, None], x[mine, f, None] - high[:, f]), 0.0)
                        square += gap * gap
                    # a cell without points has an infinite box
                    within = (square <= bound[mine, None]) & np.isfinite(low[:, 0])
                    within[np.arange(len(within)), home[mine]] = False
                    size.append(within.sum(axis=1))
                    cells.append(np.nonzero(within)[1])
                yield pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(size)).astype(np.int32)), pa.array(np.concatenate(cells)))

        return others("x", "cell", "bound")

    def search(self, df: DataFrame, features: Sequence[Column], ks: Sequence[int], weights: str, name: str) -> DataFrame:
        """``df`` with a struct ``name`` with a field ``k<k>`` for each of ``ks``: the
        label that the k nearest choose; null where a feature is null."""
        schema = T.StructType([T.StructField(f"k{k}", self.label_type) for k in ks])
        fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]
        if not self.labels:
            return df.withColumn(name, F.lit(None).cast(schema))
        labels, most, stem = pa.array(self.labels, fields[0].type), max(ks), f"__{uuid.uuid4().hex[:8]}_"
        x = [c.cast("double").alias(f"{stem}{i}") for i, c in enumerate(features)]
        names = [f"{stem}{i}" for i in range(self.d)]
        known = functools.reduce(operator.and_, [F.col(c).isNotNull() & ~F.isnan(c) for c in names])
        asked = df.select(*x).where(known).distinct().select(F.array(*names).alias("x"))
        home = keep(self._searched(asked.select(self._cells(F.col("x")).alias("cell"), "x"), most))
        beyond = home.select("x", F.explode(self._others(home)).alias("cell"))
        every = home.select("x", "near").unionByName(self._searched(beyond.select("cell", "x"), most).select("x", "near"))
        merged = every.groupBy(*[F.col("x")[i].alias(names[i]) for i in range(self.d)]).agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, most).alias("near"))

        @F.arrow_udf(schema)
        def chosen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                flat, size = batch.flatten(), np.diff(batch.offsets.to_numpy())
                row, place = np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                near = np.full((len(size), most), np.inf), np.zeros((len(size), most), np.int64), np.zeros((len(size), most), np.int64)
                for a, field in zip(near, ("square", "code", "n")):
                    a[row, place] = flat.field(field).to_numpy()
                yield pa.StructArray.from_arrays(
                    [labels.take(pa.array(PartitionTree.votes(near, k, weights, len(labels)))) for k in ks], fields=fields)

        found = merged.select(*names, chosen("near").alias(name))
        # joined with names of their own, so that rows of a frame that has the same columns stay apart
        asks = df.select("*", *x)
        mine = [f"{n}q" for n in names]
        return asks.withColumnsRenamed(dict(zip(names, mine))).join(
            found, [F.col(a) == F.col(b) for a, b in zip(mine, names)], "left").drop(*names, *mine)


def spread_neighbours(train: DataFrame, features: Sequence[str], label: str) -> SpreadNeighbours:
    """All labelled rows without a null feature, folded to distinct points and dealt
    to cells.  The sample (at most about ``SAMPLE`` points, by hash) only places the
    cells' borders; no point is left out."""
    d = len(features)
    x = [f"x{i}" for i in range(d)]
    known = functools.reduce(operator.and_, [F.col(c).isNotNull() for c in [*features, label]])
    points = keep(train.where(known).groupBy(*[F.col(f).cast("double").alias(n) for f, n in zip(features, x)], F.col(label).alias("label"))
                  .agg(F.count(F.lit(1)).alias("n")))
    labels = sorted(r.label for r in points.select("label").distinct().collect())
    many = points.count()
    share = min(1.0, SAMPLE / max(1, many))
    drawn = F.pmod(F.xxhash64(*x, "label"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = points.where(drawn).select(*x).toPandas().to_numpy(float).reshape(-1, d)
    borders = Borders(sample, min(-(-many // CELL), SAMPLE // 8))
    fitted = SpreadNeighbours(points, borders, np.full((borders.cells, d), np.inf), np.full((borders.cells, d), np.inf),
                              labels, train.schema[label].dataType)
    code = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("label")) - 1 if labels else F.lit(0)
    dealt = points.select(F.array(*x).alias("x"), code.cast("bigint").alias("code"), "n")
    fitted.points = keep(dealt.select(fitted._cells(F.col("x")).alias("cell"), "x", "code", "n"))
    for r in fitted.points.groupBy("cell").agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(d) for f, n in ((F.min, "l"), (F.max, "h"))]).collect():
        fitted.low[r["cell"]], fitted.high[r["cell"]] = [r[f"l{i}"] for i in range(d)], [r[f"h{i}"] for i in range(d)]
    return fitted
